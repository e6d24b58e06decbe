"""What every operator on features promises, on both sides of the sizes at which plans change."""

from __future__ import annotations

import math

import numpy as np
import pytest

from orelode.functions.vectors import l2_norm, sq_distance
from orelode.operators import als, kmeans, naive_bayes, pca, summary

NARROW, WIDE = 3, 30
BAD = [None, math.nan, math.inf, -math.inf]


def frame(spark, rows, width, array):
    if array:
        return spark.createDataFrame([(list(r),) for r in rows], "v array<double>"), "v"
    names = [f"x{i}" for i in range(width)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)), names


def rows_of(n, width):
    return [tuple(float((7 * i + 3 * j * j + i * j) % 23) for j in range(width)) for i in range(n)]


def actions(width):
    centers = [[0.0] * width, [9.0] * width]
    model = pca.PcaModel(None, [str(i) for i in range(width)], [[1.0 + i] * width for i in range(3)], [1.0, 0.0, 0.0])
    return {
        "summary": lambda df, f: summary.column_summary(df, f),
        "covariance": lambda df, f: pca.covariance(df, f),
        "assign": lambda df, f: kmeans.assign(df, f, centers),
        "assign_many": lambda df, f: kmeans.assign(df, f, centers * 30),
        "step": lambda df, f: kmeans.step(df, f, centers),
        "patterns": lambda df, f: kmeans.patterns(df, f, centers),
        "norm": lambda df, f: df.select(l2_norm(f)),
        "distance": lambda df, f: df.select(sq_distance(f, centers[0])),
        "project": lambda df, f: pca.PcaModel(f, model.attributes, model.loadings, model.explained).project(df),
    }


@pytest.mark.parametrize("bad", BAD)
@pytest.mark.parametrize(("width", "array"), [(NARROW, False), (WIDE, False), (NARROW, True)])
def test_bad_features_raise(spark, width, array, bad):
    rows = rows_of(4, width)
    rows[2] = (*rows[2][:-1], bad)
    df, features = frame(spark, rows, width, array)
    for name, action in actions(width).items():
        with pytest.raises(Exception):
            action(df, features).collect()
            pytest.fail(name)


@pytest.mark.parametrize("odd", [None, [], [1.0], [1.0, 2.0, 3.0, 4.0]])
def test_uneven_arrays_raise(spark, odd):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), (odd,), ([2.0, 2.0, 2.0],)], "v array<double>")
    for name, action in actions(3).items():
        if name != "norm":
            with pytest.raises(Exception):
                action(df, "v").collect()
                pytest.fail(name)


@pytest.mark.parametrize("n", [0, 1, 2, 40])
@pytest.mark.parametrize("width", [8, 9, 16, 17])
def test_summary_and_covariance_at_their_limits(spark, n, width):
    rows = rows_of(n, width)
    df, features = frame(spark, rows, width, False)
    found = {r.attribute: r for r in summary.column_summary(df, features).collect()}
    assert set(found) == set(features) and {r.n for r in found.values()} == {n}
    cov = {(r.attribute_a, r.attribute_b): r.cov for r in pca.covariance(df, features).collect()}
    assert len(cov) == width * (width + 1) // 2
    if n < 2:
        assert set(cov.values()) == {None}
    else:
        expected = np.cov(np.array(rows).T)
        assert all(math.isclose(c, expected[features.index(a), features.index(b)], rel_tol=1e-9, abs_tol=1e-9) for (a, b), c in cov.items())


def test_covariance_of_large_equal_columns_is_exact(spark):
    rows = [(1e9 + i,) * 9 for i in range(10)]
    df, features = frame(spark, rows, 9, False)
    assert {round(r.cov, 6) for r in pca.covariance(df, features).collect()} == {round(55 / 6, 6)}


@pytest.mark.parametrize("components", [1, 5, 30])
def test_projection_is_the_same_in_every_form(spark, components):
    rows = rows_of(20, 19)
    loadings = [[math.sin(c + i) for i in range(19)] for c in range(components)]
    out = []
    for array in (False, True):
        df, features = frame(spark, rows, 19, array)
        model = pca.PcaModel(features, [str(i) for i in range(19)], loadings, [0.0] * components)
        found = model.project(df).select(*[f"pc{c}" for c in range(components)]).collect()
        out.append(sorted(map(tuple, found)))
    plain = []
    for r in rows:
        sums = []
        for w in loadings:
            s = r[0] * w[0]
            for x, y in zip(r[1:], w[1:]):
                s += x * y
            sums.append(s)
        plain.append(tuple(sums))
    assert out[0] == out[1] == sorted(plain)


def test_ties_and_order_of_classes(spark):
    df = spark.createDataFrame([("b", 1.0, 0.0), ("a", 1.0, 0.0)], "label string, x double, y double")
    model = naive_bayes.train(df, "label", ["x", "y"])
    assert {r.prediction for r in model.predict(df).collect()} == {"a"}
    with pytest.raises(Exception, match="infinity in feature x"):
        naive_bayes.class_sums(df.selectExpr("label", "double('NaN') AS x"), "label", ["x"]).collect()


def test_als_blocks_follow_the_ratings(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(als.ALS, "fit", lambda self, df: seen.append(self.getNumUserBlocks()))
    ratings = spark.createDataFrame([(i, i, 1.0) for i in range(50)], "user int, item int, rating double")
    als.train(ratings, 2, 1)
    monkeypatch.setattr(als, "RATINGS_PER_BLOCK", 3)
    als.train(ratings, 2, 1)
    als.train(ratings, 2, 1, blocks=5)
    assert seen == [als.BLOCKS, 17, 5]
