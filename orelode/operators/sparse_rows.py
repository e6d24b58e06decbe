"""Column statistics and K-Means for rows that are sparse vectors, such as hashed terms.

Entries are aggregated as they are stored; what is not stored counts as 0 and is added by
formula: with m of n values stored, mean and squared deviations of the stored ones give those of
all (``_completed``). So 2**20 attributes never become dense rows. The model of K-Means is dense
(clusters x attributes doubles): the driver holds it, and every Python worker a copy by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.sparse import nearest_sparse_udf
from orelode.operators.sampling import take_sample

METRICS = ("n", "mean", "min", "max", "variance")
PATTERN_METRICS = ("n", "mean", "min", "max", "stddev")

#: Bytes of a model's centres, which every worker holds.
MODEL_BYTES = 512 << 20


@dataclass(frozen=True)
class SparseKMeansModel:
    """Centres, clusters x attributes, and the column of vectors they were computed from."""

    features: str
    centers: np.ndarray

    def assign(self, df: DataFrame, cluster: str = "cluster", distance: str = "sq_distance") -> DataFrame:
        return assign(df, self.features, self.centers, cluster, distance)

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        """(cluster, attribute, center), the numbers that are not 0."""
        j, pos = np.nonzero(self.centers)
        rows = list(zip(j.tolist(), pos.tolist(), self.centers[j, pos].tolist(), strict=True))
        return spark.createDataFrame(rows, "cluster int, attribute int, center double")


@dataclass(frozen=True)
class SparseKMeansRun:
    """A trained model and the history of its last pass."""

    model: SparseKMeansModel
    iterations: int
    converged: bool
    cost: float
    moves: list[float]


def column_summary(df: DataFrame, features: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """(attribute, n, mean, min, max, variance) of every attribute, stored or not, by position.

    As for dense columns, the variance of a single row is 0. Without rows there are no
    attributes. A null vector, or vectors of different sizes, raise.
    """
    rows = df.select(_checked(features).alias("__v"))
    sizes = rows.agg(F.count("*").alias("n"), F.min("__v.size").alias("least"), F.max("__v.size").alias("most")).first()
    if sizes.least != sizes.most:
        raise ValueError(f"vectors of {features} have from {sizes.least} to {sizes.most} attributes")
    stored = _entries(rows.select(F.lit(0).alias("of"), "__v")).groupBy("pos").agg(*_totals())
    # A row per attribute on either side.
    every = df.sparkSession.range(sizes.most or 0).select(F.col("id").cast("int").alias("pos"))
    found = every.join(stored, "pos", "left").withColumn("n", F.lit(sizes.n))
    mean, squares, low, high = _completed()
    variance = F.when(F.col("n") > 1, squares / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias("variance")
    return found.select(F.col("pos").alias("attribute"), "n", mean, low, high, variance).select("attribute", *metrics)


def assign(
    df: DataFrame, features: str, centers: np.ndarray, cluster: str = "cluster", distance: str = "sq_distance"
) -> DataFrame:
    """Add the closest centre's index and its squared distance; ties go to the lowest index."""
    centers = np.asarray(centers, np.float64)
    if centers.nbytes > MODEL_BYTES:
        raise ValueError(f"{centers.shape[0]} centres of {centers.shape[1]} attributes exceed {MODEL_BYTES} bytes")
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(centers.T))
    nearest = nearest_sparse_udf(shared, (centers * centers).sum(1))
    found = df.withColumn("__near", nearest(_checked(features)))
    return found.withColumn(distance, F.col("__near.d")).withColumn(cluster, F.col("__near.j")).drop("__near")


def patterns(df: DataFrame, features: str, centers: np.ndarray, metrics: Sequence[str] = PATTERN_METRICS) -> DataFrame:
    """(cluster, attribute, n, mean, min, max, stddev) of the attributes that some row of the cluster stores.

    The rows of a cluster that store nothing count; an attribute that none stores is 0 in all of them.
    """
    assigned = assign(df.select(F.col(features).alias("__v")), "__v", centers, "of", "__cost").select("of", "__v")
    cells = _entries(assigned, count_rows=True).groupBy("of", "pos").agg(*_totals())
    sizes = cells.where("pos = -1").select("of", F.col("m").alias("n"))
    # One row per cluster.
    found = cells.where("pos >= 0").join(F.broadcast(sizes), "of")
    mean, squares, low, high = _completed()
    deviation = F.when(F.col("n") > 1, F.sqrt(squares / (F.col("n") - 1))).alias("stddev")
    out = found.select(F.col("of").alias("cluster"), F.col("pos").alias("attribute"), "n", mean, low, high, deviation)
    return out.select("cluster", "attribute", *metrics)


def lloyd(df: DataFrame, features: str, centers: np.ndarray, max_iter: int = 20, epsilon: float = 1e-4) -> SparseKMeansRun:
    """Iterate from the given centres until every one moves at most ``epsilon``; a cluster without rows keeps its centre.

    One job per pass, whose totals (a row per cluster and stored attribute) come back.
    """
    current = np.array(centers, np.float64)
    iterations, converged, cost, moves = 0, False, 0.0, [0.0] * len(current)
    while iterations < max_iter and not converged:
        assigned = assign(df.select(F.col(features).alias("__v")), "__v", current, "of", "__cost")
        cells = _entries(assigned, count_rows=True, cost="__cost").groupBy("of", "pos").agg(F.count("x").alias("m"), F.sum("x").alias("s"))
        # Clusters x attributes at the most, as the model has.
        found = cells.toArrow()
        of, pos, m, s = (found.column(c).to_numpy() for c in ("of", "pos", "m", "s"))
        whole = pos < 0
        rows = np.zeros(len(current))
        rows[of[whole]] = m[whole]
        after = np.where(rows[:, None] > 0, 0.0, current)
        after[of[~whole], pos[~whole]] = s[~whole] / rows[of[~whole]]
        moves = ((after - current) ** 2).sum(1).tolist()
        cost = float(s[whole].sum())
        converged = all(x <= epsilon * epsilon for x in moves)
        current, iterations = after, iterations + 1
    return SparseKMeansRun(SparseKMeansModel(features, current), iterations, converged, cost, moves)


def train(
    df: DataFrame, features: str, k: int, max_iter: int = 20, epsilon: float = 1e-4, seed: int = 0, key: Sequence[str | Column] | None = None
) -> SparseKMeansRun:
    """Start at ``k`` random rows, equal ones once, and iterate."""
    return lloyd(df, features, rows_as_centers(take_sample(df, k, key, seed), features), max_iter, epsilon)


def rows_as_centers(rows: DataFrame, features: str) -> np.ndarray:
    """The distinct vectors of a few rows, dense."""
    # The caller's few rows, one per cluster to be.
    vectors = sorted({(r.v.size_, tuple(r.v.i), tuple(r.v.x)) for r in rows.select(_named(features)).collect()})
    if not vectors:
        raise ValueError("no rows to choose start centres from")
    centers = np.zeros((len(vectors), vectors[0][0]))
    for center, (_, index, value) in zip(centers, vectors, strict=True):
        center[list(index)] = value
    return centers


def _named(features: str) -> Column:
    v = _checked(features)
    return F.struct(v["size"].alias("size_"), v["indices"].alias("i"), v["values"].alias("x")).alias("v")


def _checked(features: str) -> Column:
    column = F.col(features)
    return F.coalesce(column, F.raise_error(F.lit(f"NULL vector in {features}")).cast("struct<size: int, indices: array<int>, values: array<double>>"))


def _entries(rows: DataFrame, count_rows: bool = False, cost: str | None = None) -> DataFrame:
    """of, pos, x of every stored number; with ``count_rows`` a row of pos -1 (and the cost) for each vector."""
    stored = F.arrays_zip(F.col("__v.indices").alias("pos"), F.col("__v.values").alias("x"))
    if count_rows:
        whole = F.struct(F.lit(-1).alias("pos"), (F.col(cost) if cost else F.lit(0.0)).alias("x"))
        stored = F.concat(stored, F.array(whole))
    return rows.select("of", F.inline(stored).alias("pos", "x"))


def _totals() -> list[Column]:
    return [
        F.count("x").alias("m"), F.avg("x").alias("avg"), F.var_pop("x").alias("var"), F.min("x").alias("low"), F.max("x").alias("high")
    ]


def _completed() -> tuple[Column, ...]:
    """mean, sum of squared deviations, min and max of n values of which m are stored and the others 0."""
    n, m = F.col("n"), F.coalesce("m", F.lit(0))
    avg, var = F.coalesce("avg", F.lit(0.0)), F.coalesce("var", F.lit(0.0))
    low, high = F.coalesce("low", F.lit(0.0)), F.coalesce("high", F.lit(0.0))
    return (
        (avg * m / n).alias("mean"),
        var * m + avg * avg * m * (n - m) / n,
        F.when(m < n, F.least(low, F.lit(0.0))).otherwise(low).alias("min"),
        F.when(m < n, F.greatest(high, F.lit(0.0))).otherwise(high).alias("max"),
    )
