"""K-Means whose clusters come with a pattern: count, mean, minimum, maximum and
standard deviation of every attribute.

One pass over the data is a narrow assignment followed by one ``groupBy`` on the
cluster number. Spark combines it per task first, so however many rows a cluster
holds, each task sends one row per cluster. Only centres and patterns (clusters x
attributes numbers) reach the driver. The centres go into the next plan as
literals, so every pass starts from the same input and the lineage stays short.

A pattern describes the rows assigned in the last pass that ran, the pass that
produced the final centres; hence ``mean == center`` for every cluster with rows.
The cost of a run is that pass's cost too, measured before the centres moved.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelode.functions.vectors import (
    Features,
    best_of_sql,
    feature_array,
    first_best_sql,
    is_narrow,
    nearest_udf,
    sq_distance_sql,
    with_required,
)

RANDOM = "random"
PARALLEL = "k-means||"

PATTERN_METRICS = ("n", "mean", "min", "max", "stddev")

# Beyond this many attributes one aggregate row gets too wide for generated code
# (64 attributes: 7.1 s against 1.5 s exploded, 200,000 rows).
_WIDE_AGGREGATE = 16

_CELL = "cluster int, pos int, n bigint, mean double, min double, max double, stddev double, cost double"

Centers = list[list[float]]


@dataclass(frozen=True)
class KMeansParams:
    """Settings with their ranges."""

    k: int = 2
    max_iter: int = 20
    init_mode: str = PARALLEL
    init_steps: int = 2
    epsilon: float = 1e-4
    seed: int = field(default_factory=lambda: random.getrandbits(63))

    def __post_init__(self) -> None:
        for parameter, least in (("k", 1), ("max_iter", 0), ("init_steps", 1), ("epsilon", 0)):
            if not getattr(self, parameter) >= least:
                raise ValueError(f"{parameter}={getattr(self, parameter)!r}: allowed from {least} upwards")
        if self.init_mode not in (RANDOM, PARALLEL):
            raise ValueError(f"init_mode={self.init_mode!r}: allowed are {RANDOM!r} and {PARALLEL!r}")


@dataclass(frozen=True)
class KMeansModel:
    """Cluster centres and the features they were computed from."""

    features: Features
    centers: Centers

    @property
    def k(self) -> int:
        return len(self.centers)

    @property
    def attributes(self) -> list[str]:
        return attribute_names(self.features, self.centers)

    def assign(self, df: DataFrame) -> DataFrame:
        return assign(df, self.features, self.centers)

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        """(cluster, attribute, center), one row per number."""
        rows = [
            (j, a, float(v))
            for j, center in enumerate(self.centers)
            for a, v in zip(self.attributes, center, strict=True)
        ]
        return spark.createDataFrame(rows, "cluster int, attribute string, center double")


@dataclass(frozen=True)
class KMeansRun:
    """A trained model with the patterns and the history of its last pass."""

    model: KMeansModel
    cells: list[Row]
    iterations: int
    converged: bool
    cost: float
    moves: list[float]

    def patterns(self, spark: SparkSession, metrics: Sequence[str] = PATTERN_METRICS) -> DataFrame:
        """(cluster, attribute, n, mean, min, max, stddev); an empty cluster has n = 0."""
        cells = spark.createDataFrame(self.cells, _CELL)
        return _pattern_frame(cells, self.model.features, self.model.centers, metrics)

    def info(self, spark: SparkSession) -> DataFrame:
        """(iterations, converged, cost)."""
        return spark.createDataFrame(
            [(self.iterations, self.converged, self.cost)],
            "iterations int, converged boolean, cost double",
        )


def attribute_names(features: Features, centers: Centers) -> list[str]:
    """Column names, or the positions of an array column."""
    if isinstance(features, str):
        return [str(i) for i in range(len(centers[0]))] if centers else []
    return list(features)


def assign(
    df: DataFrame,
    features: Features,
    centers: Centers,
    cluster: str = "cluster",
    distance: str = "sq_distance",
    terms: int | None = None,
) -> DataFrame:
    """Add the closest centre's index and its squared distance; ties go to the lowest index.

    ``terms`` limits the size of a written-out expression, see ``vectors``.
    """
    assigned, inputs = _nearest(df, features, centers, cluster, distance, terms)
    return assigned.drop(*inputs)


def total_cost(df: DataFrame, features: Features, centers: Centers) -> DataFrame:
    """Sum of the squared distances to the closest centre: (cost). 0 for no rows."""
    d = assign(df, features, centers)
    return d.agg(F.coalesce(F.sum("sq_distance"), F.lit(0.0)).alias("cost"))


def patterns(
    df: DataFrame,
    features: Features,
    centers: Centers,
    metrics: Sequence[str] = PATTERN_METRICS,
) -> DataFrame:
    """Patterns of one assignment to fixed centres, evaluated lazily."""
    return _pattern_frame(_cells(df, features, centers), features, centers, metrics)


def step(df: DataFrame, features: Features, centers: Centers) -> DataFrame:
    """Centres after one pass: (cluster, attribute, n, center, moved_sq).

    A cluster without rows keeps its old centre. ``moved_sq`` is the squared move
    of the whole centre, the number the convergence test looks at.
    """
    grid = _grid(df.sparkSession, features, centers)
    cells = _cells(df, features, centers).select("cluster", "pos", "n", "mean")
    # At most clusters x attributes rows on either side.
    joined = grid.join(F.broadcast(cells), ["cluster", "pos"], "left")
    center = F.coalesce("mean", "old_center")
    moved = joined.select(
        "cluster",
        "attribute",
        F.coalesce("n", F.lit(0)).alias("n"),
        center.alias("center"),
        ((center - F.col("old_center")) * (center - F.col("old_center"))).alias("part"),
    )
    # Over the clusters x attributes rows of the result, so the data are read once.
    moved_sq = F.sum("part").over(Window.partitionBy("cluster"))
    return moved.withColumn("moved_sq", moved_sq).drop("part")


def lloyd(
    df: DataFrame,
    features: Features,
    centers: Centers,
    max_iter: int = 20,
    epsilon: float = 1e-4,
    log: str | None = None,
) -> KMeansRun:
    """Iterate from the given centres until every one moves at most ``epsilon``.

    With ``log``, a path in the shared folder, every pass is written there when it is done, and
    a run that finds passes at the path goes on after the last one, on any driver. It must be given
    the same rows, features and number of centres.

    Runs one Spark job per pass. Persist ``df`` first if it is costly to compute;
    a parquet input is as fast unpersisted, as each pass reads the feature
    columns only.
    """
    if not centers:
        raise ValueError("at least one start centre is needed")
    current = [[float(v) for v in c] for c in centers]
    cells: list[Row] = []
    moves = [0.0] * len(current)
    iterations, converged, cost = 0, False, 0.0
    if log is not None:
        done = _last_pass(df.sparkSession, log)
        if done:
            iterations = done[0]["pass"]
            width = max(r.pos for r in done) + 1
            if len(done) != len(current) * width or width != len(current[0]):
                raise ValueError(f"{log} holds passes of another number of centres or attributes")
            for r in done:
                current[r.cluster][r.pos] = r.center
                moves[r.cluster] = r.move
            cells = [_CELL_ROW(*r[4:]) for r in done if r.n is not None]
            cost = sum(c.cost for c in cells if c.pos == 0)
            converged = all(m <= epsilon * epsilon for m in moves)
    while iterations < max_iter and not converged:
        cells = _cells(df, features, current).collect()
        found = [list(c) for c in current]
        for cell in cells:
            found[cell.cluster][cell.pos] = cell["mean"]
        moves = [sum((a - b) ** 2 for a, b in zip(new, old)) for new, old in zip(found, current)]
        cost = sum(cell.cost for cell in cells if cell.pos == 0)
        converged = all(m <= epsilon * epsilon for m in moves)
        current = found
        iterations += 1
        if log is not None:
            _log_pass(df.sparkSession, log, iterations, current, moves, cells)
    return KMeansRun(KMeansModel(features, current), cells, iterations, converged, cost, moves)


_LOGGED = f"pass int, center double, move double, empty boolean, {_CELL}"
_CELL_ROW = Row(*[c.split()[0] for c in _CELL.split(", ")])


def _log_pass(spark: SparkSession, path: str, number: int, centers: Centers, moves: list[float], cells: list[Row]) -> None:
    """Append a pass: a row per cluster and attribute, without statistics for an empty cluster."""
    known = {(c.cluster, c.pos): c for c in cells}
    rows = [
        (number, float(v), float(moves[j]), (j, pos) not in known, *(known.get((j, pos)) or (j, pos, *[None] * 6)))
        for j, center in enumerate(centers)
        for pos, v in enumerate(center)
    ]
    # A job that is committed whole or not at all.
    spark.createDataFrame(rows, _LOGGED).coalesce(1).write.mode("append").parquet(path)


def _last_pass(spark: SparkSession, path: str) -> list[Row]:
    """The rows of the last pass at the path, none if there is nothing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return []
    passes = spark.read.schema(_LOGGED).parquet(path)
    last = passes.agg(F.max("pass")).first()[0]
    # Clusters x attributes rows; a driver that died between writing and telling may have written a pass twice.
    return sorted(passes.where(F.col("pass") == last).distinct().collect(), key=lambda r: (r.cluster, r.pos)) if last else []


def train(
    df: DataFrame,
    features: Features,
    k: int = 2,
    max_iter: int = 20,
    init_mode: str = PARALLEL,
    init_steps: int = 2,
    epsilon: float = 1e-4,
    seed: int | None = None,
    key: Sequence[str | Column] | None = None,
    initial_model: KMeansModel | None = None,
) -> KMeansRun:
    """Choose a start (unless a model is given) and iterate.

    With ``key``, columns that identify a row, the result depends on the seed only;
    without, also on the partitioning. Rows that share a key are drawn all or none,
    so leave the key out if it is not unique. Fewer than ``k`` clusters may come back if
    there are fewer distinct rows.
    """
    from orelode.operators.kmeans_start import start_centers

    chosen = {} if seed is None else {"seed": seed}
    params = KMeansParams(k, max_iter, init_mode, init_steps, epsilon, **chosen)
    if initial_model is not None:
        if initial_model.k != k:
            raise ValueError(f"the initial model has {initial_model.k} centres, not {k}")
        start = initial_model.centers
    else:
        start = start_centers(df, features, params, key)
    return lloyd(df, features, start, max_iter, epsilon)


def _nearest(
    df: DataFrame, features: Features, centers: Centers, cluster: str, distance: str, terms: int | None = None
) -> tuple[DataFrame, list[str]]:
    """Assignment plus the names of the checked inputs it added: columns or one array."""
    if not is_narrow(features, len(centers), terms):
        wide = feature_array(features, len(centers[0]))
        found = df.withColumn("__x", wide).withColumn("__near", nearest_udf(centers)("__x"))
        found = found.withColumn(distance, F.col("__near.d")).withColumn(cluster, F.col("__near.j"))
        return found.drop("__near"), ["__x"]
    found, xs = with_required(df, features)
    ds = [f"__d{j}" for j in range(len(centers))]
    found = found.selectExpr("*", *[f"{sq_distance_sql(xs, c)} AS {d}" for c, d in zip(centers, ds)])
    found = found.selectExpr("*", f"{best_of_sql('least', ds)} AS {distance}")
    return found.selectExpr("*", f"{first_best_sql(ds, distance)} AS {cluster}").drop(*ds), xs


def _cells(df: DataFrame, features: Features, centers: Centers) -> DataFrame:
    """One pass: a row per non-empty cluster and attribute. One shuffle of task totals."""
    pruned = df.select(features) if isinstance(features, str) else df.select(*features)
    found, inputs = _nearest(pruned, features, centers, "__cluster", "__cost")
    if len(inputs) > 1 or inputs[0] != "__x":
        if len(inputs) <= _WIDE_AGGREGATE:
            return _cells_by_column(found, inputs)
        found = found.withColumn("__x", F.array(*inputs))
    values = found.select("__cluster", "__cost", F.posexplode("__x").alias("pos", "x"))
    totals = ["count(1) AS n", *_statistics("x"), "sum(__cost) AS cost"]
    return values.groupBy(F.col("__cluster").alias("cluster"), "pos").agg(*map(F.expr, totals))


def _cells_by_column(found: DataFrame, inputs: list[str]) -> DataFrame:
    totals = ["count(1) AS n", "sum(__cost) AS cost"]
    totals += [f"struct({', '.join(_statistics(x))}) AS {x}" for x in inputs]
    wide = found.groupBy(F.col("__cluster").alias("cluster")).agg(*map(F.expr, totals))
    cells = ", ".join(f"struct({i} AS pos, {x}.*)" for i, x in enumerate(inputs))
    return wide.selectExpr("cluster", "n", "cost", f"inline(array({cells}))").select(
        "cluster", "pos", "n", "mean", "min", "max", "stddev", "cost"
    )


def _statistics(x: str) -> list[str]:
    return [f"avg({x}) AS mean", f"min({x}) AS min", f"max({x}) AS max", f"stddev_samp({x}) AS stddev"]


def _grid(spark: SparkSession, features: Features, centers: Centers) -> DataFrame:
    """Every cluster and attribute with its old centre: clusters x attributes rows."""
    names = attribute_names(features, centers)
    rows = [
        (j, pos, a, float(v))
        for j, center in enumerate(centers)
        for pos, (a, v) in enumerate(zip(names, center, strict=True))
    ]
    schema = T.StructType(
        [
            T.StructField("cluster", T.IntegerType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("attribute", T.StringType()),
            T.StructField("old_center", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def _pattern_frame(
    cells: DataFrame, features: Features, centers: Centers, metrics: Sequence[str]
) -> DataFrame:
    unknown = set(metrics) - set(PATTERN_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}; choose from {PATTERN_METRICS}")
    grid = _grid(cells.sparkSession, features, centers).select("cluster", "pos", "attribute")
    # At most clusters x attributes rows on either side.
    joined = grid.join(F.broadcast(cells), ["cluster", "pos"], "left")
    filled = joined.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return filled.select("cluster", "attribute", *metrics)
