from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelode.operators import kmeans, kmeans_start
from orelode.operators.kmeans import KMeansModel


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        c = i % 3
        rows.append((i, 10.0 * c + rng.random(), -5.0 * c - rng.random()))
    return spark.createDataFrame(rows, "id int, x double, y double").repartition(5).persist()


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def brute_force(points, centers, max_iter, epsilon=1e-4):
    """Lloyd's iterations in plain numpy, for comparison."""
    points, centers = np.asarray(points), np.asarray(centers, dtype=float)
    for iteration in range(1, max_iter + 1):
        d = ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
        nearest, cost = d.argmin(axis=1), d.min(axis=1).sum()
        new = centers.copy()
        for j in range(len(centers)):
            if (nearest == j).any():
                new[j] = points[nearest == j].mean(axis=0)
        moved = ((new - centers) ** 2).sum(axis=1)
        centers = new
        if (moved <= epsilon**2).all():
            return centers, nearest, cost, iteration, True
    return centers, nearest, cost, iteration, False


def test_deviation_is_the_sample_deviation(spark):
    row = kmeans.patterns(frame(spark, [1, 2, 3]), ["x"], [[2.0]]).first()
    assert (row.n, row.mean, row["min"], row["max"], row.stddev) == (3, 2.0, 1.0, 3.0, 1.0)


def test_negative_maximum(spark):
    assert kmeans.patterns(frame(spark, [-3, -1]), ["x"], [[0.0]]).first()["max"] == -1.0


def test_single_member_has_no_deviation(spark):
    assert kmeans.patterns(frame(spark, [4]), ["x"], [[0.0]]).first().stddev is None


def test_ties_go_to_the_lowest_index(spark):
    for features, df in ((["x"], frame(spark, [1])), ("v", frame(spark, [1]).select(F.array("x").alias("v")))):
        row = kmeans.assign(df, features, [[0.0], [2.0], [0.0]]).first()
        assert (row.cluster, row.sq_distance) == (0, 1.0)


def test_empty_cluster_keeps_its_centre(spark):
    df = frame(spark, [0, 1])
    rows = {r.cluster: r for r in kmeans.step(df, ["x"], [[0.5], [100.0]]).collect()}
    assert (rows[1].center, rows[1].n, rows[0].center, rows[0].moved_sq) == (100.0, 0, 0.5, 0.0)
    run = kmeans.lloyd(df, ["x"], [[0.5], [100.0]])
    found = {r.cluster: r for r in run.patterns(spark).collect()}
    assert run.converged and found[1].n == 0 and found[1]["mean"] is None and found[0].n == 2


def test_duplicates_give_fewer_centres(spark):
    df = frame(spark, [7, 7, 7])
    assert kmeans.train(df, ["x"], 2, init_mode="random", seed=1).model.centers == [[7.0]]
    assert kmeans.train(df, ["x"], 2, seed=1).model.centers == [[7.0]]


@pytest.mark.parametrize("max_iter", [1, 3, 20])
def test_lloyd_equals_brute_force(spark, blobs, max_iter):
    rows = sorted(blobs.collect())
    points = [[r.x, r.y] for r in rows]
    start = [points[0], points[3], points[6]]
    run = kmeans.lloyd(blobs, ["x", "y"], start, max_iter)
    centers, nearest, cost, iterations, converged = brute_force(points, start, max_iter)
    assert np.allclose(run.model.centers, centers, rtol=1e-12)
    assert (run.iterations, run.converged) == (iterations, converged)
    assert math.isclose(run.cost, cost, rel_tol=1e-9)
    table = {(r.cluster, r.attribute): r for r in run.patterns(spark).collect()}
    for j in range(3):
        members = np.asarray(points)[nearest == j]
        for i, a in enumerate("xy"):
            row = table[j, a]
            assert row.n == len(members)
            assert row["mean"] == run.model.centers[j][i]
            assert (row["min"], row["max"]) == (members[:, i].min(), members[:, i].max())
            assert math.isclose(row.stddev, members[:, i].std(ddof=1), rel_tol=1e-9)


def test_cost_never_rises(spark, blobs):
    centers = [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]]
    costs = []
    for _ in range(5):
        run = kmeans.lloyd(blobs, ["x", "y"], centers, 1)
        costs.append(run.cost)
        centers = run.model.centers
    assert costs == sorted(costs, reverse=True)
    assert kmeans.total_cost(blobs, ["x", "y"], centers).first().cost <= costs[-1]


def test_column_and_array_forms_are_bit_equal(spark, blobs):
    rng = random.Random(1)
    # 60 centres x 2 attributes go through the Arrow form even as columns.
    for k in (3, 60):
        centers = [[rng.random() * 20, -rng.random() * 10] for _ in range(k)]
        arrays = blobs.select("id", F.array("x", "y").alias("v"))
        by_column = kmeans.assign(blobs, ["x", "y"], centers).select("id", "cluster", "sq_distance")
        by_array = kmeans.assign(arrays, "v", centers).select("id", "cluster", "sq_distance")
        assert sorted(by_column.collect()) == sorted(by_array.collect())
        assert by_column.columns == ["id", "cluster", "sq_distance"]
    a = kmeans.patterns(blobs, ["x", "y"], centers[:3]).collect()
    b = kmeans.patterns(arrays, "v", centers[:3]).collect()
    key = lambda r: (r.cluster, r.attribute)
    for left, right in zip(sorted(a, key=key), sorted(b, key=key)):
        assert left.n == right.n and math.isclose(left.stddev or 0, right.stddev or 0, rel_tol=1e-9)


def test_many_columns_go_through_the_exploded_form(spark):
    d = 20
    df = spark.range(50).selectExpr("id", *[f"cast((id * {i + 3}) % 17 AS double) AS c{i}" for i in range(d)])
    names = [f"c{i}" for i in range(d)]
    rows = kmeans.patterns(df, names, [[0.0] * d, [9.0] * d]).collect()
    assert sum(r.n for r in rows) == 50 * d
    assert {r.attribute for r in rows} == set(names)


@pytest.mark.parametrize("k", [1, 2, 19, 25])
def test_every_number_of_clusters(spark, blobs, k):
    run = kmeans.train(blobs, ["x", "y"], k, 3, seed=3, key=["id"])
    rows = run.patterns(spark).collect()
    assert 1 <= run.model.k <= k
    assert sum(r.n for r in rows if r.attribute == "x") == 300


def test_training_finds_separate_groups(spark, blobs):
    run = kmeans.train(blobs, ["x", "y"], 3, seed=11, key=["id"])
    sizes = [r.n for r in run.patterns(spark, ["n"]).collect()]
    assert run.converged and sizes == [100] * 6


@pytest.mark.parametrize("mode", ["random", "k-means||"])
def test_keyed_training_ignores_the_partitioning(spark, blobs, mode):
    settings = dict(k=4, max_iter=0, init_mode=mode, seed=2, key=["id"])
    a = kmeans.train(blobs, ["x", "y"], **settings)
    b = kmeans.train(blobs.repartition(7, "y"), ["x", "y"], **settings)
    assert a.model == b.model
    assert kmeans.train(blobs, ["x", "y"], **{**settings, "seed": 3}).model != a.model


def test_without_key(spark, blobs):
    run = kmeans.train(blobs, ["x", "y"], 3, 5, seed=2)
    assert sum(r.n for r in run.patterns(spark).collect()) == 600


def test_no_iterations(spark, blobs):
    run = kmeans.train(blobs, ["x", "y"], 2, 0, initial_model=KMeansModel(["x", "y"], [[0.0, 0.0], [9.0, 9.0]]))
    assert run.model.centers == [[0.0, 0.0], [9.0, 9.0]]
    assert (run.iterations, run.converged, run.cost) == (0, False, 0.0)
    assert {(r.n, r["mean"]) for r in run.patterns(spark).collect()} == {(0, None)}


def test_parameter_ranges(spark, blobs):
    for bad in (dict(k=0), dict(max_iter=-1), dict(init_mode="other"), dict(init_steps=0), dict(epsilon=-1.0)):
        with pytest.raises(ValueError):
            kmeans.train(blobs, ["x", "y"], **bad)
    with pytest.raises(ValueError, match="initial model"):
        kmeans.train(blobs, ["x", "y"], 3, initial_model=KMeansModel(["x", "y"], [[0.0, 0.0]]))
    defaults = kmeans.KMeansParams()
    assert (defaults.k, defaults.max_iter, defaults.init_mode) == (2, 20, "k-means||")
    assert (defaults.init_steps, defaults.epsilon) == (2, 1e-4)
    assert kmeans.KMeansParams().seed != defaults.seed


def test_empty_input_raises(spark, blobs):
    for mode in ("random", "k-means||"):
        with pytest.raises(ValueError, match="no rows"):
            kmeans.train(blobs.limit(0), ["x", "y"], 2, init_mode=mode)


def test_null_feature_raises(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="infinity in feature x"):
        kmeans.patterns(df, ["x"], [[0.0]]).collect()
    for rows in ([([1.0],), ([None],)], [([1.0],), (None,)], [([1.0],), ([1.0, 2.0],), ([],)]):
        arrays = spark.createDataFrame(rows, "v array<double>")
        with pytest.raises(Exception, match="has not 1 attributes"):
            kmeans.assign(arrays, "v", [[0.0]]).collect()


def test_metric_switches(spark, blobs):
    found = kmeans.patterns(blobs, ["x", "y"], [[0.0, 0.0]], ("n", "max"))
    assert found.columns == ["cluster", "attribute", "n", "max"]
    with pytest.raises(ValueError, match="median"):
        kmeans.patterns(blobs, ["x", "y"], [[0.0, 0.0]], ("median",))


def test_rounds_keep_the_smaller_cost(spark, blobs):
    first, second = [[0.0, 0.0]], [[20.0, -10.0]]
    chained = kmeans_start.with_cost(kmeans_start.with_cost(blobs, ["x", "y"], first), ["x", "y"], second)
    whole = kmeans_start.with_cost(blobs, ["x", "y"], first + second)
    assert sorted(chained.collect()) == sorted(whole.select(chained.columns).collect())


def test_a_key_that_rows_share_is_refused(spark):
    df = spark.range(2000).selectExpr("1 AS id", "cast(id AS double) AS x")
    with pytest.raises(ValueError, match="about 1 values"):
        kmeans.train(df, ["x"], 4, 2, seed=1, key=["id"])


def test_a_pass_reads_the_rows_once(spark, tmp_path):
    spark.range(100).selectExpr("cast(id AS double) AS x").write.parquet(str(tmp_path / "x"))
    after = kmeans.step(spark.read.parquet(str(tmp_path / "x")), ["x"], [[0.0], [60.0]])
    assert after.select("cluster", "moved_sq").distinct().count() == 2
    assert after._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_copies_are_one_candidate(spark):
    """A third of the rows are equal. Whether or not their keys differ, they are one candidate."""
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 1e6, cast(id % 100 AS double)) AS x")
    shared_key = df.withColumn("id", F.expr("if(id % 3 = 0, -1, id)"))
    for rows in (df, shared_key):
        for seed in range(3):
            found = kmeans_start.parallel_candidates(rows, ["x"], 2, 2, seed, ["id"])
            assert len(found) == len({tuple(c) for c in found}) < 40
    # With keys that identify a row the copies are drawn as often as their cost asks.
    for seed in range(3):
        run = kmeans.train(df, ["x"], 2, 5, seed=seed, key=["id"])
        assert sorted(r.n for r in run.patterns(spark).collect()) == [1000, 2000]


def test_round_on_rows_without_cost(spark):
    costed = kmeans_start.with_cost(frame(spark, [1, 1]), ["x"], [[1.0]])
    assert kmeans_start.parallel_round(costed, 2, 1, 0).count() == 0


def test_weights_count_every_row_once(spark, blobs):
    candidates = [[0.0, 0.0], [10.0, -5.0], [500.0, 500.0]]
    rows = {r.candidate: r.n for r in kmeans_start.candidate_weights(blobs, ["x", "y"], candidates).collect()}
    assert sum(rows.values()) == 300 and rows[2] == 0


def test_one_pass_is_one_shuffle(spark, blobs):
    plan = kmeans._cells(blobs, ["x", "y"], [[0.0, 0.0], [1.0, 1.0]])._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == 1 and "Join" not in initial and "Python" not in initial


def test_a_stopped_run_goes_on(spark, blobs, tmp_path):
    """Stopped after any pass and resumed, a run is the unbroken one; a finished one is read back."""
    start = [[0.0, 0.0], [1.0, 1.0], [1e6, 1e6]]
    whole = kmeans.lloyd(blobs, ["x", "y"], start, 5, 0.0)
    for stop in (1, 2, 3):
        log = str(tmp_path / f"log-{stop}")
        first = kmeans.lloyd(blobs, ["x", "y"], start, stop, 0.0, log=log)
        assert first.iterations == min(stop, whole.iterations)
        for _ in range(2):
            run = kmeans.lloyd(blobs, ["x", "y"], start, 5, 0.0, log=log)
            assert run.model == whole.model and run.moves == whole.moves and run.cost == whole.cost
            assert (run.iterations, run.converged) == (whole.iterations, whole.converged)
            assert sorted(map(tuple, run.cells)) == sorted(map(tuple, whole.cells))
    with pytest.raises(ValueError, match="another number"):
        kmeans.lloyd(blobs, ["x", "y"], start[:2], 5, 0.0, log=log)
