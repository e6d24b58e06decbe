"""Language by nearest centroid: TF-IDF vectors of letter n-grams, compared by cosine.

A text becomes lower-case letters with single blanks between words; its runs of one to
three characters are counted in hashed dimensions, damped, weighted by rarity and brought
to length 1. Every language has several centroids, from a spherical k-means over its own
rows, and a text belongs to the language of the nearest one. A text whose nearest
centroid is farther away than that language's limit for texts of its length is rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
ORDERS = (1, 2, 3)
#: Characters and texts that are worked on at a time.
CHUNK, ROWS = 1 << 18, 128
MAX_LANGUAGES = 1000
#: Limits stand for lengths from 2**j to 2**(j + 1) characters, from this j on; shorter texts have none.
SHORTEST, LENGTHS = 2, 40
#: Stretches that a limit is the low quantile of, at least, and stretches of one length drawn per language.
PIECES, DRAWN = 20, 100
QUANTILE = 0.05

_kinds: list[np.ndarray] = []


@dataclass
class LanguageModel:
    """``centroids`` has a row of length 1 per entry of ``languages``; one language has several.

    ``limits`` has a row per centroid and a column per class of lengths.
    """

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    limits: np.ndarray

    @property
    def limit(self) -> float:
        """The lowest limit of any language and length."""
        return float(self.limits.min(initial=1.0)) if self.languages else 0.0

    def nearest(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest centroid of each text, its cosine, and if it is rejected; -1, 0 and yes without letters."""
        where, cosine, rejected = np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        if not self.languages:
            return where, cosine, rejected
        for i in range(0, len(texts), ROWS):
            part = texts[i : i + ROWS]
            x = np.stack([counts(t, len(self.idf)) for t in part])
            scores = normalised(x, self.idf) @ self.centroids.T
            lettered = np.array([has_letter(t) for t in part])
            best, top, column = scores.argmax(1), scores.max(1).clip(0, 1), length_class(x)
            limit = np.where(column < 0, 0.0, self.limits[best, column])
            where[i : i + ROWS] = np.where(lettered, best, -1)
            cosine[i : i + ROWS] = np.where(lettered, top, 0.0)
            rejected[i : i + ROWS] = ~lettered | (top < limit)
        return where, cosine, rejected


def fit(
    df: DataFrame,
    text: str = "text",
    label: str = "lang",
    rows_per_language: int = 500,
    centroids: int = 4,
    dims: int = 1 << 13,
    reject: float = 0.4,
) -> LanguageModel:
    """Learn from at most about ``rows_per_language`` whole texts of each label, drawn by a hash of the text.

    Null labels, and texts that are null or have no letter, teach nothing; a repeated text
    teaches once. ``reject`` scales the limits: a low quantile of the cosines that
    stretches of a length, out of the sample's texts, have to their own language, times
    ``reject``. So few odd texts of a sample move no limit, nor do other languages.
    Without any usable row the model knows no language.
    """
    rows = df.select(F.col(label).alias("lang"), F.col(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_003))
    # Copies of a text are drawn together, and teach once, so they count once.
    hashed = rows.select("lang", F.xxhash64("text").alias("hash"), place.alias("place")).distinct()
    counted = hashed.groupBy("lang").agg(F.count("*").alias("count"), F.min("place").alias("least"))
    counted = counted.limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"{label} has more than {MAX_LANGUAGES} values")
    if not counted:
        return LanguageModel([], np.zeros((0, dims)), np.ones(dims), np.zeros((0, LENGTHS)))
    # The text of lowest hash is drawn at any share, so every language is learned.
    bounds = {r["lang"]: max(1_000_003 * min(1.0, rows_per_language / r["count"]), r["least"] + 0.5) for r in counted}
    bound = F.create_map(*[F.lit(v) for item in bounds.items() for v in item])
    sample = rows.where(place < bound[F.col("lang")]).distinct()
    idf = _idf(sample, dims)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(group["text"])
        x = normalised(np.stack([counts(t, dims) for t in texts]), idf)
        limits = (reject * low_cosines(texts, x, idf, centroids)).astype("<f8").tobytes()
        cells = [c.astype("<f8").tobytes() for c in spherical_kmeans(x, centroids)]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": cells, "limits": limits})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, limits binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    matrix = np.array([np.frombuffer(r["centroid"], "<f8") for r in found]).reshape(len(found), dims)
    limits = np.array([np.frombuffer(r["limits"], "<f8") for r in found]).reshape(len(found), LENGTHS)
    return LanguageModel([r["lang"] for r in found], matrix, idf, limits)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score (cosine of the nearest centroid) and rejected of each row.

    A text that is null or has no letter is ``und`` with score 0, and rejected. So is
    every text if the model knows no language.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows, names = df.select(*keep, F.col(text).alias("__text")), list(keep)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            where, cosine, rejected = known.nearest(batch.column(len(names)).to_pylist())
            languages = [known.languages[w] if w >= 0 else UNKNOWN for w in where]
            out = [pa.array(languages, pa.string()), pa.array(cosine), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *out], names=[*names, "lang_pred", "score", "rejected"]
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(label, ", ".join([*kept, "lang_pred string", "score double", "rejected boolean"]))


def keep_known(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns unchanged, whose text the model does not reject."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            _, _, rejected = known.nearest(batch.column(place).to_pylist())
            yield batch.filter(pa.array(~rejected))

    return df.mapInArrow(keep, df.schema)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def counts(text: str | None, dims: int) -> np.ndarray:
    """How often each hashed run of letters occurs in the whole text."""
    total = np.zeros(dims)
    text = text or ""
    for i in range(0, len(text), CHUNK):
        # The runs at the seam are seen by the chunk that they begin in.
        codes = _letters(" " * (i == 0) + text[i : i + CHUNK + max(ORDERS) - 1])
        for order in ORDERS:
            n = len(codes) - order + 1
            if n > 0:
                h = np.full(n, order, np.uint32)
                for j in range(order):
                    h = (h ^ codes[j : n + j]) * np.uint32(0x01000193)
                    h ^= h >> np.uint32(15)
                total += np.bincount(h & np.uint32(dims - 1), minlength=dims)
    return total


def normalised(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts times rarity, each row of length 1 (or 0 if it is empty)."""
    x = np.log1p(x) * idf
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(length > 0, length, 1.0)


def spherical_kmeans(x: np.ndarray, k: int, passes: int = 10) -> np.ndarray:
    """At most k centroids of length 1; starts are chosen far apart, so the order of rows decides all."""
    centres = [x.sum(0)]
    centres[0] /= np.linalg.norm(centres[0])
    chosen = np.array(centres)
    while len(chosen) < min(k, len(x)):
        chosen = np.vstack([chosen, x[(x @ chosen.T).max(1).argmin()]])
    for _ in range(passes):
        owner = (x @ chosen.T).argmax(1)
        sums = np.array([x[owner == j].sum(0) for j in range(len(chosen)) if (owner == j).any()])
        chosen = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return chosen


def length_class(x: np.ndarray) -> np.ndarray:
    """The column of ``limits`` for texts of these counts; -1 for a text that is too short for any."""
    # Every order counts one run per character, but for the last few.
    length = np.maximum(1.0, (x.sum(1) + sum(ORDERS) - len(ORDERS)) / len(ORDERS))
    return np.clip(np.floor(np.log2(length)).astype(int) - SHORTEST, -1, LENGTHS - 1)


def low_cosines(texts: list[str], x: np.ndarray, idf: np.ndarray, centroids: int) -> np.ndarray:
    """The QUANTILE of the cosines to their own language, for each class of lengths.

    Stretches of a class's least length and whole texts are held against centroids of the
    other half of the texts. A class of few stretches has the value of the one below.
    """
    halves = [spherical_kmeans(x[1 - h :: 2], centroids) for h in (0, 1)] if len(x) > 1 else [x, x]
    rng, each = np.random.default_rng(len(texts)), -(-DRAWN // len(texts))
    found: list[list[float]] = [[] for _ in range(LENGTHS)]
    for i, text in enumerate(texts):
        # Far stretches of a long text are as good as near ones.
        at = int(rng.integers(max(1, len(text) - CHUNK)))
        read = "".join(map(chr, _letters(text[at : at + CHUNK])))
        own = [counts(text, len(idf))]
        for j in range(SHORTEST, len(read).bit_length()):
            n = 1 << j
            own += [counts(read[a : a + n], len(idf)) for a in rng.integers(len(read) - n + 1, size=each)]
            if len(own) > ROWS or n * 2 > len(read):
                own_x, own = np.stack(own), []
                top = (normalised(own_x, idf) @ halves[i % 2].T).max(1)
                for column, cosine in zip(length_class(own_x), top, strict=True):
                    if column >= 0:
                        found[column].append(cosine)
    low = np.zeros(LENGTHS)
    for j, cosines in enumerate(found):
        low[j] = np.quantile(cosines, QUANTILE) if len(cosines) >= PIECES else low[j - 1] if j else 0.0
    return low


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-case text, with one blank for each run of anything but letters and marks."""
    if not _kinds:
        table = np.zeros(0x110000, bool)
        table[:0x32000] = [unicodedata.category(chr(i))[0] in "LM" for i in range(0x32000)]
        _kinds.append(table)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _kinds[0][codes]
    keep = inside.copy()
    keep[0:1] = True
    keep[1:] |= inside[:-1]
    return np.where(inside, codes, 32)[keep].astype(np.uint32)


def _idf(sample: DataFrame, dims: int) -> np.ndarray:
    """Rarity of each dimension among the drawn texts; one row of ``dims`` numbers per task comes back."""

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(dims, np.int64)
        for batch in batches:
            for text in pc.drop_null(batch.column(0)).to_pylist():
                n += 1
                seen += counts(text, dims) > 0
        if n:
            place = np.flatnonzero(seen)
            place, number = np.append(place, -1), np.append(seen[place], n)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(number)], names=["place", "n"])

    rows = sample.select("text").mapInArrow(document_counts, "place long, n long").groupBy("place").sum("n").collect()
    by_place = {r[0]: r[1] for r in rows}
    n = by_place.pop(-1, 0)
    idf = np.full(dims, np.log1p(n))
    for place, number in by_place.items():
        idf[place] = np.log((1 + n) / (1 + number)) + 1.0
    return idf
