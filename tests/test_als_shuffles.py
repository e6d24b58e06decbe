"""What the checks of the ALS model shuffle and leave on disk, on tables of their own."""

from __future__ import annotations

import time

import pytest

from __spark_entry__ import oracle_sql, queries
from orelode.operators import als
from orelode.plans.queries import ALS_ITERATIONS
from tests.check_sql import connect, differences

USERS, ITEMS = 30, 24
PAIRS = {(u, i) for u in range(USERS) for i in range(ITEMS) if (u + i) % 4}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """An order per pair, some parts in it twice; an order without items and items without an order."""
    path = str(tmp_path_factory.mktemp("tables"))
    orders = [(k, u) for k, (u, _) in enumerate(sorted(PAIRS))] + [(100_000, 5)]
    items = [(k, i, float((u * 7 + i * 3) % 5 + 1)) for k, (u, i) in enumerate(sorted(PAIRS))]
    items += items[::7] + [(200_000, 3, 1.0)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long"),
        ("lineitem", items, "l_orderkey long, l_partkey long, l_quantity double"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}-parts")
        spark.read.parquet(f"{path}/{name}-parts").toPandas().to_parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture
def shuffled_joins(spark):
    """Joins as on large tables, each shuffle with all its partitions."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("-1", "false")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def rows_shuffled(df) -> list[int]:
    """Rows written by every shuffle of a query that ran."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        below = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        children = node.children()
        for child in below or [children.apply(i) for i in range(children.size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def shuffles(spark) -> set[int]:
    """Ids of the shuffles that have files."""
    ids = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().keysIterator()
    found = set()
    while ids.hasNext():
        found.add(ids.next())
    return found


def check(spark, folder, name):
    """The query's rows are those of its SQL, and no shuffle of it holds a row per pair and number."""
    df = queries()[name](spark, folder)
    assert differences(df, connect(folder), oracle_sql()[name]) == ""
    written = rows_shuffled(df)
    assert written and max(written) <= len(PAIRS)


def test_predictions_are_not_repeated_per_number(spark, folder, shuffled_joins):
    check(spark, folder, "als_predict_dot")


def test_terms_are_not_shuffled(spark, folder, shuffled_joins):
    check(spark, folder, "als_normal_equations")


@pytest.mark.parametrize("name", ["als_predict_dot", "als_normal_equations"])
def test_training_leaves_no_shuffles(spark, folder, name):
    """A training has shuffles of its own and two per iteration; what reads the model needs none of them."""
    before = shuffles(spark)
    df = queries()[name](spark, folder)
    until = time.time() + 20
    while len(left := shuffles(spark) - before) >= ALS_ITERATIONS and time.time() < until:
        time.sleep(0.2)
    assert len(left) < ALS_ITERATIONS and df.count() > 0


def test_every_iteration_cuts_its_lineage(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(als.ALS, "fit", lambda self, df: seen.append((self.getCheckpointInterval(), df.is_cached, self.getIntermediateStorageLevel())))
    ratings = spark.createDataFrame([(i, i, 1.0) for i in range(5)], "user int, item int, rating double")
    als.train(ratings, 2, 1)
    als.train(ratings, 2, 1, keep=False)
    assert seen == [(1, True, "MEMORY_AND_DISK"), (1, False, "MEMORY_ONLY")]
