"""Benchmark leaks by greedy string tiling.

Words are runs of letters, digits and bytes beyond ASCII, in lower case; what stands
between them does not matter. A document that shares runs of SEED words with an item is
tiled against it: the longest common run of unmarked words is marked in both, then the
longest of what is left, down to SEED words. The share of the item's words that tiles
cover tells a leak, whatever the order of the passages in the document.

Runs of one length are found by their Karp-Rabin hashes, which follow from running sums,
and confirmed word by word. The greatest length for which there is any is found by
halving, since a common run contains common runs of every smaller length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.arrays import Words, powers, shingles, utf8

#: Shortest tile, in words; items with fewer words are not searched for.
SEED = 5
#: Least share of an item's words that must be covered.
COVERAGE = 0.8
#: Bytes of benchmark text that every executor holds at a time; a larger benchmark takes several passes.
PART_BYTES = 32 << 20

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
WORDS = Words(_INSIDE)

TILES = "array<struct<start: long, item_start: long, length: long>>"


class Benchmark:
    """The words and seeds of some items."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = _documents(pa.array([t for _, t in items], pa.string()))
        self.items = [(i, words) for (i, _), words in zip(items, texts, strict=True) if len(words) >= SEED]
        seeds = [np.unique(shingles(w, SEED)) for _, w in self.items]
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        joined = np.concatenate([np.zeros(0, np.uint64), *seeds])
        order = np.argsort(joined, kind="stable")
        self.seeds, self.owner = joined[order], owner[order]

    def leaks(self, words: np.ndarray, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(item id, words of the item, tiles) of the items that a document covers to ``coverage`` or more."""
        if len(words) < SEED or not len(self.seeds):
            return
        mine = shingles(words, SEED)
        lo = np.searchsorted(self.seeds, mine, "left")
        shared = np.flatnonzero(self.seeds[np.minimum(lo, len(self.seeds) - 1)] == mine)
        if not len(shared):
            return
        distinct, inverse = np.unique(mine[shared], return_inverse=True)
        start, stop = (np.searchsorted(self.seeds, distinct, side) for side in ("left", "right"))
        owners = np.concatenate([self.owner[a:b] for a, b in zip(start, stop, strict=True)])
        of_seed = np.repeat(np.arange(len(distinct)), stop - start)
        for item in np.unique(owners):
            item_id, text = self.items[item]
            own = of_seed[owners == item]
            # A tile of n words begins n - SEED + 1 seeds of the item, a fifth of n at least; repeats count.
            if np.isin(shingles(text, SEED), distinct[own]).sum() * SEED < coverage * len(text):
                continue
            tiles = list(self._tile(words, shared[np.isin(inverse, own)], text))
            if sum(n for _, _, n in tiles) >= coverage * len(text):
                yield item_id, len(text), tiles

    @staticmethod
    def _tile(words: np.ndarray, seeds: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Tiles over the stretches of the document that hold seeds of the item."""
        near = np.zeros(len(words) + 1, np.int64)
        np.add.at(near, seeds, 1)
        np.add.at(near, np.minimum(seeds + SEED, len(words)), -1)
        inside = np.cumsum(near)[:-1] > 0
        place = np.flatnonzero(inside)
        # Stretches that are not neighbours are kept apart by one word that is in no item.
        gap = np.flatnonzero(np.diff(place) > 1) + 1
        held = np.insert(words[place], gap, np.uint64(0))
        where = np.insert(place, gap, -1)
        for a, b, n in greedy_tiles(held, text, SEED, gap + np.arange(len(gap))):
            yield int(where[a]), b, n


def greedy_tiles(
    a: np.ndarray, b: np.ndarray, least: int, barred: np.ndarray | None = None
) -> Iterator[tuple[int, int, int]]:
    """(start in a, start in b, length) of tiles, longest first; of equal ones the first in b, then in a.

    ``barred`` are places of ``a`` that no tile may cover.
    """
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    if barred is not None:
        free_a[barred] = False
    sums_a, sums_b = _sums(a), _sums(b)
    longest = min(len(a), len(b))
    while longest >= least:
        length, top = 0, longest
        low = least
        while low <= top:
            middle = (low + top + 1) // 2 if low < top else low
            if len(np.intersect1d(_windows(sums_a, free_a, middle)[1], _windows(sums_b, free_b, middle)[1])):
                length, low = middle, middle + 1
            else:
                top = middle - 1
        if not length:
            return
        at, hashes = _windows(sums_a, free_a, length)
        order = np.argsort(hashes, kind="stable")
        at, hashes = at[order], hashes[order]
        marked = False
        for j, h in zip(*_windows(sums_b, free_b, length), strict=True):
            if not free_b[j : j + length].all():
                continue
            k = int(np.searchsorted(hashes, h))
            while k < len(at) and hashes[k] == h:
                i = at[k]
                if free_a[i : i + length].all() and np.array_equal(a[i : i + length], b[j : j + length]):
                    free_a[i : i + length] = free_b[j : j + length] = False
                    marked = True
                    yield int(i), int(j), length
                    break
                k += 1
        # Without a mark, equal hashes of different words came first.
        longest = length if marked else length - 1


def _sums(words: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(len(words) + 1)[0][: len(words)], out=sums[1:])
    return sums


def _windows(sums: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the stretches of so many free words."""
    count = np.concatenate([[0], np.cumsum(free)])
    at = np.flatnonzero(count[length:] - count[:-length] == length)
    return at, (sums[at + length] - sums[at]) * powers(len(sums))[1][at]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_words (of the item), n_covered, n_tiles, tiles of each leak.

    A row for each pair of a document and an item whose words are covered to ``coverage``
    or more by tiles of SEED words and up; starts in ``tiles`` count words. Null and empty
    texts, and items with fewer than SEED words, have no leaks. Repeated rows of either
    side give repeated leaks. Other columns of the inputs are not read.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def search(items: Benchmark, batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for d, words in zip(batch.column(0).to_pylist(), _documents(batch.column(1)), strict=True):
            for item_id, n, tiles in items.leaks(words, coverage):
                row = {"doc_id": d, "item_id": item_id, "n_words": n, "n_tiles": len(tiles)}
                row["n_covered"] = sum(c for _, _, c in tiles)
                row["tiles"] = [{"start": a, "item_start": b, "length": c} for a, b, c in tiles]
                out.append(row)
        return pa.RecordBatch.from_pylist(out, schema=_LEAK_TYPES)

    schema = f"doc_id long, item_id long, n_words long, n_covered long, n_tiles long, tiles {TILES}"
    found = [rows.mapInArrow(_over(part, search), schema) for part in _parts(benchmark, item, item_text)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, without those in which an item leaks."""
    place = docs.columns.index(text)

    def clean(items: Benchmark, batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = [any(True for _ in items.leaks(words, coverage)) for words in _documents(batch.column(place))]
        return batch.filter(pa.array([not h for h in hit], pa.bool_()))

    for part in _parts(benchmark, item, item_text):
        docs = docs.mapInArrow(_over(part, clean), docs.schema)
    return docs


def _over(shared, each: Callable[[Benchmark, pa.RecordBatch], pa.RecordBatch]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Benchmark(shared.value)
        for batch in batches:
            yield each(items, batch)

    return run


def _documents(column: pa.Array) -> Iterator[np.ndarray]:
    words, first = WORDS.hashes(*utf8(pc.utf8_lower(column)))
    for a, b in zip(first, first[1:], strict=False):
        yield words[a:b]


def _parts(benchmark: DataFrame, item: str, item_text: str) -> list:
    """Broadcasts of the items, each of about PART_BYTES at most, or of one item."""
    items = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = items.where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    n = max(1, -(-size * 5 // (PART_BYTES * 4))) if size > PART_BYTES else 1
    context = benchmark.sparkSession.sparkContext
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [context.broadcast(sorted(map(tuple, items.where(part == i).collect()), key=str)) for i in range(n)]


_LEAK_TYPES = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "item_id", "n_words", "n_covered", "n_tiles")]
    + [("tiles", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "item_start", "length")])))]
)
