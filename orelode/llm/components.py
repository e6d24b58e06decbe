"""Connected components by minimum labels, with every pass written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.operators.partitions import gather
from orelode.sources.storage import stage

#: Rows of narrow tables (two or three numbers a row) that are worth a task.
TASK_ROWS = 50_000


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes in staged ``edges`` (a, b).

    Each pass takes the smallest label among the neighbours and then the label of that
    label, so chains shorten by half or more. A node with very many edges costs no task
    more than its share: minima are combined before the shuffle, and tables that are
    joined are read from files, so that the adaptive join can split them.
    """
    rows = 2 * edges.count()

    def written(df: DataFrame, what: str) -> DataFrame:
        return stage(gather(df, rows, TASK_ROWS), what)

    both = written(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct().toDF("node", "other"), "edges"
    )
    labels = written(both.groupBy("node").agg(F.min("other").alias("m")).selectExpr("node", "least(node, m) as component"), "labels")
    while True:
        seen = labels.selectExpr("node as other", "component as m")
        lowest = written(both.join(seen, "other").groupBy("node").agg(F.min("m").alias("m")), "lowest")
        lower = written(labels.join(lowest, "node").selectExpr("node", "component as old", "least(component, m) as component"), "lower")
        ahead = lower.selectExpr("node as component", "component as ahead")
        jumped = lower.join(ahead, "component").selectExpr("node", "old", "ahead as component")
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("old <> component").isEmpty():
            return labels
