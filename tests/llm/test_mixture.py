from __future__ import annotations

import random
import re

import pytest

from orelode.llm import hash_mixture


def levelled(sizes: dict, weights: dict) -> dict:
    """Targets by handing the excess on, round by round."""
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        total = sum(weights[s] for s in free)
        target = {s: 3.0 * sizes[s] if s in capped else left * weights[s] / total for s in sizes}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def rows(n: int, sources: list, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(i, "word " * rng.randint(0, 30), None, rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"] * 8 + ["b", "c", None], ["x"], [f"s{i}" for i in range(9)] + ["s0"] * 20])
def test_targets_and_taken_words(documents, sources):
    data = rows(600, sources, 3)
    out = hash_mixture.mix(documents(data)).collect()
    source_of = {d: s for d, _, _, s in data}
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t, _, _ in data}
    assert {r.doc_id: r["size"] for r in out} == size
    order = sorted(set(sources), key=lambda s: (s is None, s or ""))
    sizes = {s: sum(size[d] for d in size if source_of[d] == s) for s in order}
    target = levelled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for s in order:
        own = [r for r in out if source_of[r.doc_id] == s]
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.copies * r["size"] for r in own) - target[s]) <= 15
        assert max(r.copies for r in own) <= 3 and max(r.copies for r in own) - min(r.copies for r in own) <= 1


def test_reruns_and_other_partitions_agree(documents):
    data = rows(200, ["a", "a", "b", "c"], 5)
    one, two = (
        {r.doc_id: r.copies for r in hash_mixture.mix(documents(d, parts)).collect()} for d, parts in ((data, 2), (data[::-1], 5))
    )
    assert one == two


def test_odd_rows(documents):
    data = [(1, None, None, "a"), (2, "", None, "a"), (None, "x y", None, None), (3, "u v w", None, "b"), (3, "u v w", None, "b")]
    out = hash_mixture.mix(documents(data)).collect()
    assert sorted(r["size"] for r in out) == [0, 0, 2, 3, 3]
    assert {r.source: r.target for r in out}["a"] == 0.0
    assert hash_mixture.mix(documents([])).collect() == []


def test_rows_are_repeated(documents):
    df = documents(rows(300, ["a", "a", "a", "a", "b", "c", None], 8))
    copies = {r.doc_id: r.copies for r in hash_mixture.mix(df).collect()}
    out = hash_mixture.repeat_rows(df)
    assert out.columns == df.columns
    seen: dict = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: c for d, c in copies.items() if c}


ALIKE = [
    [(7, "ten words " * 5, None, "a")] * 100 + [(1000 + i, "w " * 10, None, "b") for i in range(60)],
    [(7, f"text {i} " * 5, None, "a") for i in range(300)] + [(1000 + i, "w " * 10, None, None) for i in range(200)],
    [(None, f"text {i} " * (i % 9), None, "a") for i in range(300)] + [(None, "w " * 10, None, "c")] * 150 + [(1, "w " * 3, None, "d")] * 40,
    [(3, "w " * 10, None, s) for s in ("a", "b", None) for _ in range(1000)],
]


@pytest.mark.parametrize("data", ALIKE)
def test_rows_that_share_ids_come_near_the_target(documents, data):
    df = documents(data)
    most = max(len(t.split()) for _, t, _, _ in data)
    out = hash_mixture.mix(df).collect()
    assert len(out) == len(data)
    taken: dict = {}
    for r in out:
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
    assert all(abs(taken[r.source] - r.target) <= most and 0 <= r.copies <= 3 for r in out)
    repeated: dict = {}
    for r in hash_mixture.repeat_rows(df).collect():
        repeated[r.source] = repeated.get(r.source, 0) + len(r.text.split())
    assert repeated == {s: n for s, n in taken.items() if n}
    again = sorted((r.source or "", r["size"], r.copies) for r in hash_mixture.mix(documents(data[::-1], 7)).collect())
    assert again == sorted((r.source or "", r["size"], r.copies) for r in out)


def test_columns_of_clashing_names(spark):
    names = ["doc_id", "text", "source", "row", "copies", "number", "size", "of", "col", "boundary", "held", "own", "target"]
    df = spark.createDataFrame([(i, "a b", "s", *range(10)) for i in range(20)], names)
    out = hash_mixture.repeat_rows(df)
    assert out.columns == names and out.count() == 20


def test_main_path_has_no_python(documents):
    plan = hash_mixture.mix(documents(rows(50, ["a", "b"], 1)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
