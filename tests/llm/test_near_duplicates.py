"""Groups of near duplicates against comparing all pairs of texts."""

from __future__ import annotations

import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from orelode.llm import tensor_minhash
from orelode.llm.components import components


def shingle_set(text: str | None, size: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(rows: list[tuple], size: int, share: int) -> dict:
    sets = [shingle_set(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= share * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label):
        least[x] = min(least.get(x, doc), doc)
    return {doc: (len(s), least[x], doc == least[x]) for (doc, _), s, x in zip(rows, sets, label)}


def corpus() -> list[tuple]:
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [rng.choices(vocabulary, k=n) for n in (4, 30, 80, 200, 200)]
    texts = [None, "", " \n\t", "one", "One", "Two words", "two  WORDS", "é É", "É é"]
    for base in bases:
        for _ in range(40):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(3, 60))) for _ in range(60)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize(("size", "block"), [(2, 2048), (5, 2048), (2, 5)])
def test_groups(documents, monkeypatch, size, block):
    monkeypatch.setattr(tensor_minhash, "BLOCK_MEMBERS", block)
    rows = corpus()
    out = tensor_minhash.near_duplicates(documents(rows), size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == groups(rows, size, 80)


def test_null_ids_and_repeated_rows(documents):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (7, "other words"), (None, "lonely text"), (3, None), (3, "")]
    out = tensor_minhash.near_duplicates(documents(rows), 2).collect()
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in out)
    assert found == [
        ("3", 0, "3", True), ("3", 0, "3", True), ("7", 1, "7", True), ("7", 3, "7", True), ("7", 3, "7", True),
        ("None", 1, "None", True), ("None", 3, "7", False),
    ]


def test_one_of_each_group_stays(documents):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text), (4, text), (2, text + " more"), (9, "something else here"), (9, None), (9, None), (None, "x y z")]
    df = documents(rows)
    out = tensor_minhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(map(str, [rows[2], *rows[3:]]))
    assert tensor_minhash.keep_one(documents([])).collect() == []


def test_probability_of_a_table():
    at = lambda s: (1 - (1 - s**tensor_minhash.WIDTH) ** tensor_minhash.HALVES) ** 2
    assert at(0.8) > 0.9996 and at(0.85) > 0.99997 and at(0.05) < 1e-5


def test_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 100)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_small_tables_take_few_tasks(documents, spark, monkeypatch):
    """However many shuffle partitions there are, tables of numbers do not take a task of each."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    staged, real = [], tensor_minhash.stage

    def watched(df, what):
        staged.append((what, real(df, what)))
        return staged[-1][1]

    monkeypatch.setattr(tensor_minhash, "stage", watched)
    monkeypatch.setattr("orelode.llm.components.stage", watched)
    rows = corpus()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = tensor_minhash.near_duplicates(documents(rows), 2).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == groups(rows, 2, 80)
    files = {what: len(df.inputFiles()) for what, df in staged if what != "texts"}
    assert max(files.values()) <= spark.sparkContext.defaultParallelism, files
    assert sum(what == "compared" for what, _ in staged) <= 2


def test_memory_of_a_batch():
    """Only the words of a block of rows are held, whatever the batch has."""
    column = pa.array([f"t{i} " + "ab cd efg h " * 500 for i in range(4000)] + [None, ""])
    assert sum(len(s) for s in tensor_minhash.sets_of(column.slice(3998), 2)) == 2 * 5
    next(tensor_minhash.sets_of(column.slice(4000), 2))
    tracemalloc.start()
    try:
        sizes = [len(s) for s in tensor_minhash.sets_of(column, 2)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sizes == [5] * 4000 + [0, 0]
    # 24 MB of text; the hashes of all of its words are 64 MB.
    assert peak < 60e6, peak
