"""Factorisation by partial normal equations against numpy and the estimator of ``pyspark.ml``."""

from __future__ import annotations

import numpy as np
import pytest

from orelode.operators import als, als_rows
from orelode.sources.staging import stage


@pytest.fixture(scope="module")
def data():
    """Ratings of rank 3 and noise; one user has a third of them, one item another hot share; some pairs twice."""
    rng = np.random.default_rng(1)
    u, v = rng.random((40, 3)), rng.random((900, 3))
    pairs = [(0, i) for i in range(900)] + [(int(a), int(b)) for a, b in zip(rng.integers(1, 40, 1500), rng.integers(0, 900, 1500))]
    pairs += [(a, 5) for a in range(40)] * 5
    return [(a, b, float(u[a] @ v[b] + rng.normal() / 50)) for a, b in pairs]


@pytest.fixture(scope="module")
def ratings(spark, data):
    return stage(spark.createDataFrame(data, "user int, item int, rating double").repartition(6), "ratings")


def solved(data, side, factors, rank, reg):
    out = {}
    for own in {r[side] for r in data}:
        rows = [r for r in data if r[side] == own]
        y = np.array([factors[r[1 - side]] for r in rows])
        out[own] = np.linalg.solve(y.T @ y + reg * len(rows) * np.eye(rank), y.T @ np.array([r[2] for r in rows]))
    return out


def table(df):
    return {r.id: np.array(r.factors) for r in df.collect()}


@pytest.mark.parametrize("share", [1000, 3, 10**9])
@pytest.mark.parametrize("block", [100, 1 << 24])
def test_half_steps_solve_the_equations(ratings, data, monkeypatch, share, block):
    monkeypatch.setattr(als_rows, "HOT_SHARE", share)
    model = als_rows.train(ratings, 3, 1, seed=4)
    items, users = table(model.items), table(model.users)
    expected = solved(data, 0, items, 3, als.LAMBDA)
    assert set(users) == set(expected) and set(items) == {r[1] for r in data}
    assert all(np.allclose(users[u], expected[u]) for u in users)


def test_hot_owners_are_cut(ratings, monkeypatch):
    monkeypatch.setattr(als_rows, "HOT_SHARE", 20)
    hot = {r.id: r.slices for r in als_rows._hot(ratings, "user", ratings.count()).collect()}
    # A third of the ratings is dealt in about a third of all slices.
    assert set(hot) == {0} and 7 <= hot[0] <= 9
    monkeypatch.setattr(als_rows, "HOT_SHARE", 1)
    assert als_rows._hot(ratings, "user", ratings.count()) is None


def test_agrees_with_the_estimator(ratings, data):
    """From the estimator's items the half step gives its users; and both fit alike."""
    distinct = stage(ratings.groupBy("user", "item").avg("rating").withColumnRenamed("avg(rating)", "rating"), "ratings")
    other = als.train(distinct, 3, 6, seed=1)
    items = stage(other.itemFactors.selectExpr("id", "cast(features as array<double>) as factors"), "factors")
    mine = table(als_rows.half_step(distinct, items, "user", "item", 3, als.LAMBDA))
    theirs = {r.id: np.array(r.features) for r in other.userFactors.collect()}
    assert set(mine) == set(theirs) and all(np.allclose(mine[u], theirs[u], atol=2e-3) for u in mine)
    error = lambda df: np.sqrt(np.mean([(r.rating - r.prediction) ** 2 for r in df.join(distinct, ["user", "item"]).collect()]))
    own = als_rows.train(distinct, 3, 6, seed=1)
    assert error(own.predict(distinct)) < 1.1 * error(als.predict(other, distinct)) + 0.01


def test_partitions_and_odd_input(spark, ratings, data):
    other = spark.createDataFrame(data[::-1], "user int, item int, rating double").repartition(3)
    a, b = (table(als_rows.train(df, 2, 2, seed=9).users) for df in (ratings, other))
    assert all(np.allclose(a[u], b[u]) for u in a)
    model = als_rows.train(ratings, 2, 1, seed=9)
    pairs = spark.createDataFrame([(1, 5), (1, 5), (777, 5), (1, 7777), (None, 5)], "user int, item int")
    assert [(r.user, r.item) for r in model.predict(pairs).collect()] == [(1, 5), (1, 5)]
    empty = als_rows.train(ratings.limit(0), 2, 2)
    assert empty.users.count() == empty.items.count() == 0
    with pytest.raises(Exception, match="a rating without"):
        als_rows.train(spark.createDataFrame([(1, None, 1.0)], "user int, item int, rating double"), 2, 1)
    with pytest.raises(ValueError):
        als_rows.train(ratings, 0, 1)
