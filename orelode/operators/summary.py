"""Column statistics: count, mean, minimum, maximum and sample variance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelode.functions.vectors import Features, feature_array, with_required

METRICS = ("n", "mean", "min", "max", "variance")

# Wider inputs are aggregated by position, see the K-Means passes.
_WIDE_AGGREGATE = 16


def column_summary(df: DataFrame, features: Features, metrics: Sequence[str] = METRICS) -> DataFrame:
    """(attribute, n, mean, min, max, variance), one row per attribute, in one pass.

    Attributes of an array column are named by position. The variance of a single
    row is 0. ``metrics`` chooses the columns of the report. Without rows every named
    attribute is there with n = 0; an array column then has no attributes.
    """
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}; choose from {METRICS}")
    if isinstance(features, str) or len(features) > _WIDE_AGGREGATE:
        values = df.select(F.posexplode(feature_array(features)).alias("pos", "x"))
        table = values.groupBy("pos").agg(*_statistics("x"))
        if isinstance(features, str):
            # One row per attribute: rows of unequal width show as unequal counts.
            uneven = F.raise_error(F.lit(f"rows of {features} differ in width")).cast("bigint")
            most = F.max("n").over(Window.partitionBy())
            table = table.withColumn("n", F.when(F.col("n") == most, F.col("n")).otherwise(uneven))
            return table.select(F.col("pos").cast("string").alias("attribute"), *metrics)
        spark = df.sparkSession
        grid = spark.createDataFrame(list(enumerate(features)), "pos int, attribute string")
        # One row per attribute on either side.
        filled = grid.join(F.broadcast(table), "pos", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
        return filled.select("attribute", *metrics)
    checked, xs = with_required(df.select(*features), features)
    one_row = checked.agg(*[F.struct(*_statistics(x)).alias(x) for x in xs])
    rows = F.array(*[F.struct(F.lit(f).alias("attribute"), F.col(f"{x}.*")) for f, x in zip(features, xs)])
    return one_row.select(F.inline(rows)).select("attribute", *metrics)


def _statistics(x: str) -> list[Column]:
    # var_samp is NULL for one row; without rows the variance stays NULL.
    single = F.when(F.count(x) == 1, F.lit(0.0))
    return [
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.coalesce(F.var_samp(x), single).alias("variance"),
    ]
