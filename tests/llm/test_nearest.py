from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from orelode.llm import vantage_trees


def expected(rows, queries, k):
    out = set()
    for q, v in queries:
        scored = [(-float(vantage_trees.cosines(np.array([v], float), np.array([w], float))[0]), i) for i, w in rows if i != q]
        out |= {(q, r + 1, i, round(-s, 10)) for r, (s, i) in enumerate(sorted(scored)[:k])}
    return out


def found(spark, rows, queries, **options):
    frames = [spark.createDataFrame(x, "vec_id long, embedding array<float>") for x in (rows, queries)]
    out = vantage_trees.nearest(*frames, **options).collect()
    assert len({(r.query_id, r.rank) for r in out}) == len(out)
    return {(r.query_id, r.rank, r.vec_id, round(r.score, 10)) for r in out}


@pytest.mark.parametrize(("shard", "block"), [(8192, 512), (150, 7)])
def test_factor_one_is_exact(spark, monkeypatch, shard, block):
    monkeypatch.setattr(vantage_trees, "SHARD_ROWS", shard)
    monkeypatch.setattr(vantage_trees, "QUERY_ROWS", block)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(9, 8))
    x = np.round(centres[rng.integers(0, 9, 700)] + rng.normal(size=(700, 8)) / 4, 3)
    x[300:500] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32).astype(float))]
    queries = rows[::50]
    assert found(spark, rows, queries) == expected(rows, queries, 5)


def test_factor_trades_recall_for_leaves():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 6))[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 6)) / 10
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    asked = unit[:50]
    seen = {}
    for factor in (1.0, 2.0):
        best, visits = np.full((50, 5), -np.inf), []

        def visit(here, leaf):
            scores = np.hstack([best[here], asked[here] @ unit[leaf].T])
            best[here] = -np.sort(-scores, axis=1)[:, :5]
            visits.append(len(here))
            worst = best[here, -1]
            return np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(0, 2 - 2 * worst)))

        vantage_trees.Tree(unit).search(asked, factor, visit)
        seen[factor] = (best.copy(), sum(visits))
    exact = -np.sort(-(asked @ unit.T), axis=1)[:, :5]
    assert np.allclose(seen[1.0][0], exact)
    assert np.isclose(seen[2.0][0], exact).mean() >= 0.9
    assert seen[2.0][1] < seen[1.0][1] < 50 * 4000 / vantage_trees.LEAF


def test_what_takes_no_part(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
        (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 1.0]),
    ]
    out = found(spark, rows, [(1, [1.0, 0.0]), (3, None)], k=5)
    assert {(q, r, i) for q, r, i, _ in out} == {(1, 1, 2), (1, 2, 2)}
    assert found(spark, rows, rows[2:3]) == set()
    assert found(spark, rows[2:3], rows[:1]) == set()


@pytest.mark.parametrize("leaf", [2, 5, 64])
def test_equal_vectors_keep_the_smallest_ids(monkeypatch, leaf):
    monkeypatch.setattr(vantage_trees, "LEAF", leaf)
    rng = np.random.default_rng(3)
    for width in (8, 64):
        x = rng.normal(size=(500, width))
        x[:400] = x[0]
        ids = rng.permutation(500)
        rows = pd.DataFrame({"id": ids, "v": list(x), "number": range(500)})
        for at in range(0, 400, 10):
            found = vantage_trees.search_shard(rows, rows.iloc[at : at + 1], 5, 1.0)
            own = sorted(set(ids[:400]) - {ids[at]})[:5]
            assert found.loc[found["own"], "vec_id"].tolist() in ([], [ids[at]])
            found = found[~found["own"]][:5]
            assert found["vec_id"].tolist() == own and np.allclose(found["score"], 1)


@pytest.mark.parametrize(("shard", "block"), [(8192, 512), (20, 3)])
def test_repeated_queries_and_candidates(spark, monkeypatch, shard, block):
    """Ranks of every query row over every row but itself, by trying all."""
    monkeypatch.setattr(vantage_trees, "SHARD_ROWS", shard)
    monkeypatch.setattr(vantage_trees, "QUERY_ROWS", block)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 3)).astype(np.float32).astype(float))]
    rows += [rows[0], rows[0], (0, [1.0, 2.0, 3.0]), (10, [2 * v for v in rows[10][1]]), *[(7, rows[20][1])] * 8, rows[20]]
    asked = [n for n, (i, _) in enumerate(rows) if i % 10 == 0]
    wanted = []
    for n in asked:
        own = np.array(rows[n][1])
        scored = [(-float(vantage_trees.cosines(own[None], np.array(v)[None])[0]), i) for m, (i, v) in enumerate(rows) if m != n]
        wanted += [(rows[n][0], r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:5])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, number string, own int")
    out = vantage_trees.nearest(frame, frame.where("vec_id % 10 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out) == sorted(wanted)
