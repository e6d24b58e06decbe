from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import functions as F

from orelode.functions.keyed import keyed_uniform
from orelode.functions.vectors import l2_norm, sq_distance
from orelode.operators import als, naive_bayes, pca, sampling, summary

# Column statistics -------------------------------------------------------------


def test_summary_of_one_row(spark):
    df = spark.createDataFrame([(4.0,)], "x double")
    assert tuple(summary.column_summary(df, ["x"]).first()) == ("x", 1, 4.0, 4.0, 4.0, 0.0)
    arrays = df.select(F.array("x").alias("v"))
    assert tuple(summary.column_summary(arrays, "v").first()) == ("0", 1, 4.0, 4.0, 4.0, 0.0)


def test_summary_of_no_rows(spark):
    df = spark.createDataFrame([], "x double")
    assert tuple(summary.column_summary(df, ["x"]).first()) == ("x", 0, None, None, None, None)


def test_summary_forms_agree(spark):
    d = 18
    df = spark.range(40).selectExpr(*[f"cast((id * {i + 5}) % 23 - 11 AS double) AS c{i}" for i in range(d)])
    names = [f"c{i}" for i in range(d)]
    wide = {r.attribute: r for r in summary.column_summary(df, names).collect()}
    for start in (0, 9):
        for r in summary.column_summary(df, names[start : start + 9]).collect():
            w = wide[r.attribute]
            assert (r.n, r["min"], r["max"]) == (w.n, w["min"], w["max"])
            assert math.isclose(r.variance, w.variance, rel_tol=1e-12)
    with pytest.raises(ValueError, match="median"):
        summary.column_summary(df, names, ("median",))


# Vectors and samples ---------------------------------------------------------------


def test_vector_functions(spark):
    df = spark.createDataFrame([(3.0, -4.0)], "x double, y double").withColumn("v", F.array("x", "y"))
    row = df.select(
        l2_norm(["x", "y"]), l2_norm("v"), sq_distance(["x", "y"], [0.0, 0.0]), sq_distance("v", [1.0, 1.0])
    ).first()
    assert tuple(row) == (5.0, 5.0, 25.0, 29.0)


def test_keyed_uniform_is_uniform_and_repeatable(spark):
    df = spark.range(20000).withColumn("u", keyed_uniform(["id"], 5))
    stats = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.stddev("u")).first()
    assert stats[0] >= 0.0 and stats[1] < 1.0
    assert abs(stats[2] - 0.5) < 0.01 and abs(stats[3] - 12**-0.5) < 0.01
    again = spark.range(20000).repartition(3).withColumn("u", keyed_uniform(["id"], 5))
    assert df.join(again, ["id", "u"]).count() == 20000


def test_split_keeps_every_row_once(spark):
    df = spark.range(1000)
    for share in (0.0, 0.2, 0.9, 1.0):
        train, test = sampling.split_train_test(df, share, ["id"], 3)
        assert train.count() + test.count() == 1000 and train.intersect(test).count() == 0
    with pytest.raises(ValueError):
        sampling.split_train_test(df, 1.5, ["id"], 3)


def test_sample_size(spark):
    assert sampling.take_sample(spark.range(100), 7, ["id"], 1).count() == 7
    assert sampling.take_sample(spark.range(3), 7, ["id"], 1).count() == 3
    half = sampling.sample_by_probability(spark.range(1000), F.lit(0.5), ["id"], 1).count()
    assert 400 < half < 600


# Naive Bayes ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def classes(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 1.0), ("b", 0.0, 5.0)]
    return spark.createDataFrame(rows, "label string, x double, y double")


def test_hand_computed_model(classes):
    model = naive_bayes.train(classes, "label", ["x", "y"])
    assert model.labels == ["a", "b"]
    assert np.allclose(model.pi, [math.log(3 / 5), math.log(2 / 5)])
    assert np.allclose(model.theta, [[math.log(5 / 9), math.log(4 / 9)], [math.log(1 / 7), math.log(6 / 7)]])
    sums = {r.label: (r.n, r.x, r.y) for r in naive_bayes.class_sums(classes, "label", ["x", "y"]).collect()}
    assert sums == {"a": (2, 4.0, 3.0), "b": (1, 0.0, 5.0)}


def test_bad_training_rows_raise(spark, classes):
    negative = classes.withColumn("x", F.col("x") - 1)
    with pytest.raises(ValueError, match="x must not be negative"):
        naive_bayes.train(negative, "label", ["x", "y"])
    with pytest.raises(ValueError, match="no rows"):
        naive_bayes.train(classes.limit(0), "label", ["x", "y"])
    with pytest.raises(ValueError, match="NULL label"):
        naive_bayes.train(classes.withColumn("label", F.lit(None).cast("string")), "label", ["x", "y"])
    with pytest.raises(Exception, match="infinity in feature y"):
        naive_bayes.train(classes.withColumn("y", F.lit(None).cast("double")), "label", ["x", "y"])


def test_agrees_with_ml(spark):
    from pyspark.ml.classification import NaiveBayes

    d = 6
    df = spark.range(500).selectExpr(
        "id", "cast(id % 4 AS double) AS label", *[f"cast((id * id * {i + 2}) % 13 AS double) AS c{i}" for i in range(d)]
    )
    names = [f"c{i}" for i in range(d)]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    fitted = NaiveBayes(smoothing=1.0).fit(vectors)
    model = naive_bayes.train(df, "label", names)
    assert np.allclose(model.pi, fitted.pi.toArray(), rtol=1e-12)
    assert np.allclose(model.theta, fitted.theta.toArray(), rtol=1e-12)
    both = model.predict(fitted.transform(vectors).withColumnRenamed("prediction", "expected"))
    assert both.filter("prediction <> expected").count() == 0


def test_wide_scoring_agrees_with_narrow(spark, monkeypatch):
    df = spark.range(200).selectExpr("id", "id % 3 AS label", *[f"cast((id * {i + 3}) % 7 AS double) AS c{i}" for i in range(5)])
    model = naive_bayes.train(df, "label", [f"c{i}" for i in range(5)])
    narrow = sorted(model.predict(df).select("id", "prediction").collect())
    monkeypatch.setattr("orelode.functions.vectors.NARROW_TERMS", 0)
    assert sorted(model.predict(df).select("id", "prediction").collect()) == narrow


def test_score_ties_go_to_the_smallest_label(spark):
    df = spark.createDataFrame([(2, 1.0), (5, 1.0)], "label int, x double")
    model = naive_bayes.train(df, "label", ["x"])
    found = model.predict(df)
    assert [r.prediction for r in found.collect()] == [2, 2]
    assert dict(found.dtypes)["prediction"] == "int"


def test_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (1.0, 1.0), (3.0, 3.0)], "label double, prediction double")
    assert tuple(naive_bayes.accuracy(df, "label").first()) == (4, 3, 0.75)
    assert tuple(naive_bayes.accuracy(df.limit(0), "label").first()) == (0, 0, None)


# Principal components -----------------------------------------------------------------


@pytest.fixture(scope="module")
def correlated(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 2))
    data = np.column_stack([base @ [2.0, 0.5], base @ [1.0, -1.0], rng.normal(size=200), base[:, 0] + 7.0, base[:, 1]])
    rows = [(i, *map(float, r)) for i, r in enumerate(data)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double")
    return df.repartition(4).persist(), data


def test_components_match_numpy(correlated):
    df, data = correlated
    names = list("abcde")
    values, vectors = np.linalg.eigh(np.cov(data, rowvar=False))
    model = pca.fit(df, names, 3)
    for c in range(3):
        expected = vectors[:, -1 - c]
        assert np.allclose(np.abs(np.dot(model.loadings[c], expected)), 1.0)
        assert max(model.loadings[c], key=abs) > 0
    loadings = np.array(model.loadings)
    assert np.allclose(loadings @ loadings.T, np.eye(3), atol=1e-12)
    assert np.allclose(model.explained, values[::-1][:3] / values.sum())
    projected = np.array([tuple(r) for r in model.project(df).orderBy("id").select("pc0", "pc1", "pc2").collect()])
    assert np.allclose(projected, data @ loadings.T)
    variances = projected.var(axis=0)
    assert list(variances) == sorted(variances, reverse=True)


def test_projection_is_that_of_ml_up_to_sign(correlated):
    df, _ = correlated
    names = list("abcde")
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(df)
    expected = PCA(k=2, inputCol="v", outputCol="p").fit(vectors).transform(vectors).orderBy("id").select("p").collect()
    found = pca.fit(df, names, 2).project(df).orderBy("id").select("pc0", "pc1").collect()
    assert np.allclose(np.abs([list(r.p) for r in expected]), np.abs([list(r) for r in found]))


def test_array_and_column_forms_agree(correlated):
    df, data = correlated
    names = list("abcde")
    arrays = df.select("id", F.array(*names).alias("v"))
    a, b = pca.fit(df, names, 2), pca.fit(arrays, "v", 2)
    assert np.allclose(a.loadings, b.loadings) and b.attributes == list("01234")
    pa = a.project(df).orderBy("id").select("pc0", "pc1").collect()
    pb = b.project(arrays).orderBy("id").select("pc0", "pc1").collect()
    assert np.allclose(pa, pb)
    expected = np.cov(data, rowvar=False)
    for features, frame in ((names, df), ("v", arrays)):
        cells = pca.covariance(frame, features).collect()
        index = {n: i for i, n in enumerate(names)} | {str(i): i for i in range(5)}
        assert len(cells) == 15
        for r in cells:
            assert math.isclose(r.cov, expected[index[r.attribute_a], index[r.attribute_b]], rel_tol=1e-9, abs_tol=1e-12)


def test_constant_attribute(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "v array<double>")
    cells = {(r.attribute_a, r.attribute_b): r.cov for r in pca.covariance(df, "v").collect()}
    assert cells == {("0", "0"): 2.0, ("0", "1"): 0.0, ("1", "1"): 0.0}


def test_too_many_components(correlated):
    df, _ = correlated
    for k in (0, 6):
        with pytest.raises(ValueError):
            pca.fit(df, list("abcde"), k)


# Recommendation -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def rated(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    return spark.createDataFrame(rows, "user int, item int, rating double").repartition(3).persist()


def test_unknown_ids_drop_and_repeats_stay(spark, rated):
    model = als.train(rated, 2, 2, seed=1)
    pairs = spark.createDataFrame([(1, 1), (1, 1), (999, 1), (1, 999)], "user int, item int")
    found = als.predict(model, pairs)
    assert [(r.user, r.item) for r in found.collect()] == [(1, 1), (1, 1)]
    assert found.columns == ["user", "item", "prediction"]
    assert sorted(tuple(r) for r in als.coverage(pairs, rated).collect()) == [(1, 1), (1, 1)]


def test_user_factors_solve_their_normal_equations(rated):
    """The last half-step fixes the items: every user's factors are then a ridge solution."""
    model = als.train(rated, 3, 4, seed=1)
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    by_user: dict[int, list] = {}
    for r in rated.collect():
        by_user.setdefault(r.user, []).append(r)
    for user, rows in by_user.items():
        q = np.array([items[r.item] for r in rows])
        y = np.array([r.rating for r in rows])
        expected = np.linalg.solve(q.T @ q + als.LAMBDA * len(rows) * np.eye(3), q.T @ y)
        assert np.allclose(users[user], expected, rtol=1e-2, atol=1e-2)


def test_fits_better_than_the_mean_and_repeats(rated):
    model = als.train(rated, 4, 8, seed=1)
    both = rated.join(als.predict(model, rated), ["user", "item"])
    mean = rated.agg(F.avg("rating")).first()[0]
    errors = both.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)), F.avg(F.pow(F.col("rating") - mean, 2))).first()
    assert errors[0] < errors[1] / 2
    again = als.factors(als.train(rated, 4, 8, seed=1))
    assert sorted(again.collect()) == sorted(als.factors(model).collect())


def test_top_predictions_are_ordered(rated):
    rows = als.top_predictions(als.predict(als.train(rated, 2, 1, seed=1), rated)).collect()
    assert len(rows) == 100 and rows == sorted(rows)


def test_als_parameters(rated):
    with pytest.raises(ValueError):
        als.train(rated, 0, 1)
    with pytest.raises(ValueError):
        als.train(rated, 1, -1)


@pytest.mark.parametrize("small", [10, 10_000])
def test_large_samples_are_the_small_ones_carried_on(spark, monkeypatch, small):
    monkeypatch.setattr(sampling, "SMALL", small)
    monkeypatch.setattr(sampling, "LEVEL_BITS", 4 if small == 10 else 13)
    df = spark.range(5000).withColumn("__v", F.col("id") * 2).repartition(7)
    for n in (0, 1, 50, 2500, 4999, 5000, 9999):
        mine = {r.id for r in sampling.take_many(df, n, ["id"], 3).collect()}
        assert mine == ({r.id for r in sampling.take_sample(df, n, ["id"], 3).collect()} if n else set())
    alike = spark.range(100).selectExpr("id", "1 as k")
    assert sampling.take_many(alike, 30, ["k"], 3).count() == 30
    assert sampling.take_many(df.limit(0), 5, ["id"], 3).count() == 0
    with pytest.raises(ValueError, match="key"):
        sampling.take_many(df, 5, None, 3)


def test_naive_bayes_of_many_features(spark, monkeypatch):
    rng = np.random.default_rng(5)
    wide = rng.integers(0, 9, (40, 600)).astype(float)
    df = spark.createDataFrame([("ab"[i % 2], x.tolist()) for i, x in enumerate(wide)], "label string, x array<double>")
    names = [f"f{i}" for i in range(600)]
    df = df.select("label", *[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    model = naive_bayes.train(df, "label", names)
    for row, theta in zip((wide[::2], wide[1::2]), model.theta, strict=True):
        assert np.allclose(theta, np.log((row.sum(0) + 1) / (row.sum() + 600)))
    few = df.select("label", *names[:9])
    narrow = naive_bayes.train(few, "label", names[:9])
    monkeypatch.setattr(naive_bayes, "_WIDE_AGGREGATE", 4)
    by_position = naive_bayes.train(few, "label", names[:9])
    assert np.allclose(narrow.theta, by_position.theta) and narrow.pi == by_position.pi
    with pytest.raises(Exception, match="negative"):
        naive_bayes.train(few.withColumn("f0", F.lit(-1.0)), "label", names[:9])
