"""Principal components of the sample covariance, and projection onto them.

The covariance is summed up on the executors; only an attributes x attributes
matrix reaches the driver. Projection is un-centred, ``X . loadings``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.vectors import Features, dot_sql, feature_array, is_narrow, linear_udf, with_required
from orelode.operators.summary import column_summary

# A pair of attributes per aggregate: up to here one generated aggregation.
_WIDE_COVARIANCE = 8


@dataclass(frozen=True)
class PcaModel:
    """``loadings[c][a]``: weight of attribute ``a`` in component ``c``."""

    features: Features
    attributes: list[str]
    loadings: list[list[float]]
    explained: list[float]

    def components_frame(self, spark: SparkSession) -> DataFrame:
        """(component, attribute, loading)."""
        rows = [
            (c, a, v)
            for c, row in enumerate(self.loadings)
            for a, v in zip(self.attributes, row, strict=True)
        ]
        return spark.createDataFrame(rows, "component int, attribute string, loading double")

    def explained_frame(self, spark: SparkSession) -> DataFrame:
        """(component, explained), each component's share of the total variance."""
        rows = list(enumerate(self.explained))
        return spark.createDataFrame(rows, "component int, explained double")

    def project(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        """Add one column per component. Narrow."""
        if is_narrow(self.features, len(self.loadings)):
            checked, xs = with_required(df, self.features)
            outputs = [f"{dot_sql(xs, row)} AS {prefix}{c}" for c, row in enumerate(self.loadings)]
            return checked.selectExpr("*", *outputs).drop(*xs)
        x = feature_array(self.features, len(self.attributes))
        found = df.withColumn("__x", x).withColumn("__y", linear_udf(self.loadings)("__x"))
        outputs = [F.get("__y", F.lit(c)).alias(f"{prefix}{c}") for c in range(len(self.loadings))]
        return found.select("*", *outputs).drop("__x", "__y")


def covariance(df: DataFrame, features: Features) -> DataFrame:
    """(attribute_a, attribute_b, cov) for every pair with a <= b in column order.

    With one row every cov is NULL; so it is without rows, where an array column has no
    attributes at all.
    """
    if not isinstance(features, str) and len(features) <= _WIDE_COVARIANCE:
        checked, xs = with_required(df.select(*features), features)
        pairs = list(combinations_with_replacement(range(len(features)), 2))
        one_row = checked.agg(*[F.covar_samp(xs[i], xs[j]).alias(f"c{i}_{j}") for i, j in pairs])
        cells = F.array(
            *[
                F.struct(
                    F.lit(features[i]).alias("attribute_a"),
                    F.lit(features[j]).alias("attribute_b"),
                    F.col(f"c{i}_{j}").alias("cov"),
                )
                for i, j in pairs
            ]
        )
        return one_row.select(F.inline(cells))
    return _wide_covariance(df, features)


def _wide_covariance(df: DataFrame, features: Features) -> DataFrame:
    """Sums of products of deviations from the means, as in the narrow form; two passes."""
    spark = df.sparkSession
    means = column_summary(df, features, ("n", "mean")).collect()
    n = max((r.n for r in means), default=0)
    if isinstance(features, str):
        means.sort(key=lambda r: int(r.attribute))
    names = [r.attribute for r in means] if isinstance(features, str) else list(features)
    schema = "attribute_a string, attribute_b string, cov double"
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    if n < 2:
        return spark.createDataFrame([(names[i], names[j], None) for i, j in pairs], schema)
    by_name = {r.attribute: r["mean"] for r in means}
    center = np.array([by_name[a] for a in names])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(center), len(center)))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(center)) - center
            total += x.T @ x
        i, j = np.triu_indices(len(center))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])

    rows = df.select(feature_array(features, len(center)).alias("x"))
    # A row per pair of attributes and task.
    sums = rows.mapInArrow(products, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    label = F.array(*[F.lit(a) for a in names])
    return sums.select(
        F.get(label, F.col("i")).alias("attribute_a"),
        F.get(label, F.col("j")).alias("attribute_b"),
        (F.col("s") / F.lit(float(n - 1))).alias("cov"),
    )


def fit(df: DataFrame, features: Features, k: int) -> PcaModel:
    """The first ``k`` components, by falling variance.

    The sign of a component is free; here its largest loading by size is positive.
    """
    if k < 1:
        raise ValueError(f"number of components must be positive but got {k}")
    if not isinstance(features, str) and k > len(features):
        raise ValueError(f"{k} components asked of {len(features)} attributes")
    model = PCA(k=k, inputCol="x", outputCol="y").fit(_vectors(df, features))
    matrix = model.pc.toArray()
    loadings = []
    for c in range(k):
        row = [float(v) for v in matrix[:, c]]
        largest = max(row, key=abs)
        loadings.append([-v for v in row] if largest < 0 else row)
    explained = [float(v) for v in model.explainedVariance]
    return PcaModel(features, _attributes(features, matrix.shape[0]), loadings, explained)


def _vectors(df: DataFrame, features: Features) -> DataFrame:
    return df.select(array_to_vector(feature_array(features)).alias("x"))


def _attributes(features: Features, width: int) -> list[str]:
    return [str(i) for i in range(width)] if isinstance(features, str) else list(features)
