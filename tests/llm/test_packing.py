"""Packing: pieces against the library, sequences without gaps, and as few of them as brute force needs."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orelode.llm import island_packing
from orelode.sources.staging import stage

WORDS = public_tokenizers.path("word_bpe_49k.json")


def fewest(lengths: list[int], capacity: int) -> int:
    """The least number of bins, by trying every subset."""
    n = len(lengths)
    sums = [sum(lengths[i] for i in range(n) if m >> i & 1) for m in range(1 << n)]
    least = [0] + [n] * ((1 << n) - 1)
    for m in range(1, 1 << n):
        part = m
        while part:
            if sums[part] <= capacity:
                least[m] = min(least[m], least[m ^ part] + 1)
            part = (part - 1) & m
    return least[-1]


def checked(rows, capacity: int) -> int:
    """The number of sequences, after a look at all offsets."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
        assert sum(n for _, n in parts) <= capacity
    return len(held)


@pytest.mark.parametrize("seed", range(8))
def test_plans_need_no_more_bins_than_brute_force(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(15, 60, 9)
    best = island_packing.evolve(lengths, 100, rng)[0]
    assert np.bincount(best, lengths).max() <= 100
    assert island_packing.fitness(best, lengths, 100)[0] == fewest(lengths.tolist(), 100)


def test_evolution_beats_its_first_plans():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 101, 250)
    order = np.argsort(-lengths, kind="stable")
    first = island_packing.best_fit(lengths, np.full(250, -1), order, 150)
    held = []
    for epoch in range(4):
        held = island_packing.evolve(lengths, 150, np.random.default_rng(epoch), held)
        assert all(np.bincount(p, lengths).max() <= 150 and p.min() == 0 for p in held)
    assert island_packing.fitness(held[0], lengths, 150)[0] < island_packing.fitness(first, lengths, 150)[0]


def test_swaps_keep_every_item_and_the_capacity():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 50, 300)
    plan = island_packing.best_fit(lengths, np.full(300, -1), rng.permutation(300), 64)
    displaced = rng.choice(300, 40, replace=False)
    plan[displaced] = -1
    left = island_packing.swap(plan, lengths, displaced, 64)
    assert sorted(left) == sorted(np.flatnonzero(plan < 0)) and len(left) == 40
    assert np.bincount(plan[plan >= 0], lengths[plan >= 0]).max() <= 64
    assert lengths[left].sum() <= lengths[displaced].sum()


def test_shards_and_levels(spark, monkeypatch):
    monkeypatch.setattr(island_packing, "SHARD_ITEMS", 60)
    lengths = np.random.default_rng(3).integers(1, 1000, 1500)
    # Two fifths are alike and hard to pack.
    lengths[:600] = 600
    items = stage(spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "item long, length long"), "items")
    rows = island_packing.place(items, 1000).join(items, "item").collect()
    assert sorted(r.item for r in rows) == list(range(1500))
    # No two items of more than half the capacity share a sequence.
    assert checked(rows, 1000) <= 1.03 * max((lengths > 500).sum(), lengths.sum() / 1000)


def test_documents(spark, documents):
    values = [None, "", "  ", "short text", "word and more " * 3000, "x" * 9000, *(f"some text {i} " * (i % 90) for i in range(300))]
    rows = [*enumerate(values), (5, "again"), (5, "again"), (None, "no id")]
    packed = island_packing.pack_documents(documents(rows), WORDS, 0, 64)
    out = packed.collect()
    library = [[*e.ids, 0] for e in Tokenizer.from_file(WORDS).encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    wanted = [
        (i, k, k * 64, len(ids[k * 64 : k * 64 + 64]), zlib.crc32(np.array(ids[k * 64 : k * 64 + 64], "<u4").tobytes()))
        for (i, _), ids in zip(rows, library, strict=True)
        for k in range(-(-len(ids) // 64))
    ]
    key = lambda r: (r[0] is None, *r[1:], r[0] or 0)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out], key=key) == sorted(wanted, key=key)
    total = sum(map(len, library))
    assert checked(out, 64) <= 1.02 * total / 64 + 2
    joined = island_packing.sequences(packed).collect()
    assert sum(r.n_tokens for r in joined) == total
    ids_of = defaultdict(list)
    for s in joined:
        begin = 0
        for doc, n in zip(s.doc_ids, s.lengths, strict=True):
            ids_of[doc].append(bytes(s.ids)[4 * begin : 4 * (begin + n)])
            begin += n
    assert sorted(map(len, ids_of[4])) == sorted(4 * w[3] for w in wanted if w[0] == 4)


def test_empty_table(documents):
    assert island_packing.pack_documents(documents([]), WORDS, 0).collect() == []
