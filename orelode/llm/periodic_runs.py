"""Periodic runs of words, found on harmonic grids with longest common extensions.

A run of period q and at least ``times`` periods holds two points of the grid of period q
that are q apart, if the grid's points are (times - 1) * q words apart. So for every q a
few pairs of equal words are looked at, n log n in all, and each is extended to the left and
right as far as the words q apart agree; what is long enough is a run.

Most extensions end within COVER_SIZE words. For documents with longer ones an index of
the suffixes that start in a difference cover is built: only these are sorted (by their
first COVER_SIZE words, then by doubling), with the lengths of their common prefixes in a
sparse table. Any two positions reach a sampled pair within COVER_SIZE words, which are
compared one by one; a minimum over the table gives the rest. An extension so takes
bounded time, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.arrays import row_blocks, utf8

# A difference cover. Every number below COVER_SIZE is a difference of two of these.
COVER_SIZE = 31
COVER = (1, 5, 11, 24, 25, 27)

#: Periods, and pairs of positions, that are looked at at once.
_PERIODS, _PAIRS = 1 << 18, 1 << 20

_SAMPLES = np.array(COVER)
_PLACE = np.full(COVER_SIZE, -1)
_PLACE[_SAMPLES] = np.arange(len(COVER))
#: For each difference, a number of the cover from which the difference leads to another one.
_MEET = np.array([next(a for a in COVER if (a + d) % COVER_SIZE in COVER) for d in range(COVER_SIZE)])


def find_runs(
    df: DataFrame, least: int = 24, times: int = 3, text: str = "text", keep: list[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, n_words, runs (start, length, period) and collapsed of each row.

    Words are what stands between white space (blank, tab to carriage return), compared
    exactly. A run is a stretch of words with smallest period ``period``, of ``least`` words
    and ``times`` periods at least, that no neighbouring word extends; runs are in order of
    start and period. ``collapsed`` has the words that no run holds after its first period,
    with one blank between them.

    A null or empty text has no words and no runs. Repeated rows come out as often as they
    come in; other columns are not read. Work and memory of a task depend on its longest
    text: about n log n steps and 100 bytes a word.
    """
    if least < 1 or times < 2:
        raise ValueError(f"runs have 1 word and 2 periods at least, not {least} and {times}")
    names = list(keep)
    rows = df.select(*names, F.col(text).alias("__text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(len(names)))
            for start, stop in row_blocks(offsets):
                texts = [data[a:b].tobytes() for a, b in zip(offsets[start:stop], offsets[start + 1 : stop + 1], strict=True)]
                kept = [c.slice(start, stop - start) for c in batch.columns[: len(names)]]
                yield pa.RecordBatch.from_arrays([*kept, *_describe(texts, least, times)], names=[*names, "n_words", "runs", "collapsed"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    out = [*kept, "n_words long", "runs array<struct<start: long, length: long, period: long>>", "collapsed string"]
    return rows.mapInArrow(measure, ", ".join(out))


def _describe(texts: list[bytes], least: int, times: int) -> list[pa.Array]:
    words = [t.split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    doc, start, length, period = runs_of(_numbered(words), sizes, least, times)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    struct = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    collapsed = []
    for own, a, b in zip(words, edges, edges[1:], strict=False):
        if a < b:
            # Every run opens a gap after its first period and closes it at its end.
            depth = np.zeros(len(own) + 1, np.int64)
            np.add.at(depth, start[a:b] + period[a:b], 1)
            np.add.at(depth, start[a:b] + length[a:b], -1)
            own = [own[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
        collapsed.append(b" ".join(own))
    runs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), struct)
    return [pa.array(sizes), runs, pa.array(collapsed, pa.binary()).cast(pa.string())]


def _numbered(words: list[list[bytes]]) -> np.ndarray:
    """A number per different word, for the words of all texts one after another."""
    flat = pa.array([w for own in words for w in own], pa.binary())
    return flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int, times: int) -> tuple[np.ndarray, ...]:
    """doc, start, length, period of all runs in documents of ``sizes`` words, in that order."""
    first = np.cumsum(sizes) - sizes
    found = [np.zeros((4, 0), np.int64)]
    index: dict[int, tuple[Extensions, Extensions]] = {}
    for doc, i, q in _grid(sizes, least, times):
        same = words[first[doc] + i] == words[first[doc] + i + q]
        doc, i, q = doc[same], i[same], q[same]
        right = _near(words, first[doc] + i, q, sizes[doc] - i - q, 1)
        left = _near(words, first[doc] + i - 1, q, i, -1)
        far = np.flatnonzero((right == COVER_SIZE) | (left == COVER_SIZE))
        for d, own in _by_document(doc, far):
            if d not in index:
                text = words[first[d] : first[d] + sizes[d]]
                index[d] = (Extensions(text), Extensions(text[::-1]))
            forward, backward = index[d]
            at, period = i[own], q[own]
            right[own] = forward.common(at, at + period)
            left[own] = backward.common(sizes[d] - at - period, sizes[d] - at)
        length = left + q + right
        long = length >= np.maximum(least, times * q)
        found.append(np.stack([doc, i - left, length, q])[:, long])
    doc, start, length, period = np.concatenate(found, axis=1)
    # Of the periods of one stretch the smallest divides the others.
    order = np.lexsort((period, length, start, doc))
    doc, start, length, period = (c[order] for c in (doc, start, length, period))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, start, length, period = (c[new] for c in (doc, start, length, period))
    order = np.lexsort((period, start, doc))
    return tuple(c[order] for c in (doc, start, length, period))


def _grid(sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """doc, position, period of the first of each two grid points."""
    periods = np.where(sizes >= least, sizes // times, 0)
    ends = np.cumsum(periods)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, _PERIODS):
        entry = np.arange(begin, min(begin + _PERIODS, total))
        doc = np.searchsorted(ends, entry, "right")
        q = entry - (ends[doc] - periods[doc]) + 1
        step = np.maximum((times - 1) * q, least - q)
        count = -(-(sizes[doc] - q) // step)
        reached = np.cumsum(count)
        a = 0
        while a < len(entry):
            b = max(a + 1, int(np.searchsorted(reached, (reached[a - 1] if a else 0) + _PAIRS, "right")))
            own = np.repeat(np.arange(a, b), count[a:b])
            turn = np.arange(len(own)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
            yield doc[own], turn * step[own], q[own]
            a = b


def _near(words: np.ndarray, at: np.ndarray, q: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on, at most ``room`` and COVER_SIZE, equal those q further on."""
    out = np.zeros(len(at), np.int64)
    going = np.flatnonzero(room > 0)
    for t in range(COVER_SIZE):
        here = at[going] + way * t
        going = going[words[here] == words[here + q[going]]]
        out[going] += 1
        going = going[room[going] > t + 1]
        if not len(going):
            break
    return out


def _by_document(doc: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(rows):
        return
    rows = rows[np.argsort(doc[rows], kind="stable")]
    edges = np.flatnonzero(np.diff(doc[rows], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(rows)], strict=True):
        yield int(doc[rows[a]]), rows[a:b]


class Extensions:
    """Longest common prefixes of the suffixes of a sequence of numbers, in bounded time each."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        # No number is negative, so nothing equals what follows the end.
        self.words = np.concatenate([words, np.full(COVER_SIZE + 1, -1, np.int64)])
        blocks = np.arange(0, self.n, COVER_SIZE)
        sampled = (blocks[:, None] + _SAMPLES).ravel()
        self.sampled = sampled[sampled < self.n]
        levels = self._ranks()
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        self.table = [self._prefixes(order, levels)]
        width = 1
        while 2 * width <= len(order):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _ranks(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first COVER_SIZE words, and by twice as many each time until all differ."""
        at, m = self.sampled, len(self.sampled)
        bits = max(1, int(self.words.max() + 1).bit_length())
        per = max(1, 62 // bits)
        order = np.arange(m)
        for c in range((COVER_SIZE - 1) // per * per, -1, -per):
            key = np.zeros(m, np.int64)
            for k in range(c, min(c + per, COVER_SIZE)):
                key = (key << bits) | (self.words[at + k] + 1)
            order = order[np.argsort(key[order], kind="stable")]
        differs = np.zeros(m, bool)
        for k in range(COVER_SIZE):
            w = self.words[at[order] + k]
            differs[1:] |= w[1:] != w[:-1]
        rank = np.zeros(m, np.int64)
        rank[order] = np.cumsum(differs)
        levels, step = [rank], len(COVER)
        while m and rank.max() + 1 < m:
            # The same place of the cover, COVER_SIZE words further on for every len(COVER) samples.
            after = np.zeros(m, np.int64)
            after[: max(0, m - step)] = rank[step:] + 1
            rank = np.unique(rank * (m + 1) + after, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        return levels

    def _prefixes(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each sampled suffix, in order, with the one before it."""
        m = len(order)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            step = len(COVER) << k
            rank = np.append(levels[k], [-1])
            inside = (a < m) & (b < m)
            same = inside & (rank[np.minimum(a, m)] == rank[np.minimum(b, m)])
            common[same] += COVER_SIZE << k
            a[same] += step
            b[same] += step
        x, y = self.sampled[order[:-1]] + common, self.sampled[order[1:]] + common
        going = np.flatnonzero((x < self.n) & (y < self.n))
        for _ in range(COVER_SIZE):
            going = going[self.words[x[going]] == self.words[y[going]]]
            common[going] += 1
            x[going] += 1
            y[going] += 1
            if not len(going):
                break
        return np.concatenate([[0], common])[:m]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, for positions i < j, the end included."""
        ahead = (_MEET[(j - i) % COVER_SIZE] - i) % COVER_SIZE
        out = np.zeros(len(i), np.int64)
        going, met = np.arange(len(i)), []
        for t in range(COVER_SIZE):
            here = ahead[going] == t
            met.append(going[here])
            going = going[~here]
            # What runs into the end meets a number that equals none.
            going = going[self.words[np.minimum(i[going] + t, self.n)] == self.words[np.minimum(j[going] + t, self.n)]]
            out[going] += 1
            if not len(going):
                break
        met = np.concatenate(met)
        met = met[j[met] + ahead[met] < self.n]
        a, b = (self.rank[self._sample(p[met] + ahead[met])] for p in (i, j))
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            table = self.table[k]
            out[met[own]] += np.minimum(table[low[own]], table[high[own] - (1 << int(k)) + 1])
        return out

    @staticmethod
    def _sample(at: np.ndarray) -> np.ndarray:
        """The number of a sampled position among all of them."""
        return at // COVER_SIZE * len(COVER) + _PLACE[at % COVER_SIZE]
