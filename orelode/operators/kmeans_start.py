"""Start centres for K-Means: random rows, or k-means|| (Bahmani et al., VLDB 2012)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.vectors import FILTERED_TERMS, Features, feature_array
from orelode.operators.kmeans import PARALLEL, Centers, KMeansParams, assign, attribute_names
from orelode.operators.sampling import Key, sample_by_probability, take_sample

# Fixed value: rounds of the weighted clustering that reduces the candidates.
REDUCE_ROUNDS = 30

# A key with fewer values than this share of the different rows is refused. Both counts are
# estimates with a deviation of 5 %; a few repeated keys do no harm.
MOSTLY_UNIQUE = 0.75


def start_centers(df: DataFrame, features: Features, params: KMeansParams, key: Key = None) -> Centers:
    if params.init_mode == PARALLEL:
        return parallel_start(df, features, params.k, params.init_steps, params.seed, key)
    return random_start(df, features, params.k, params.seed, key)


def random_rows(df: DataFrame, features: Features, k: int, seed: int, key: Key = None) -> DataFrame:
    """At most ``k`` distinct feature rows of a random sample of ``k`` rows."""
    columns = [features] if isinstance(features, str) else list(features)
    return take_sample(df, k, key, seed).select(*columns).dropDuplicates(columns)


def random_start(df: DataFrame, features: Features, k: int, seed: int, key: Key = None) -> Centers:
    """Centres at random rows; fewer than ``k`` if the sample holds equal rows."""
    sample = take_sample(df, k, key, seed)
    return _checked(_distinct(_points(sample, features)))


def first_center(df: DataFrame, features: Features, seed: int, key: Key = None) -> Centers:
    """One random row, the start of k-means||."""
    return _checked(_points(take_sample(df, 1, key, seed), features))


def with_cost(
    df: DataFrame, features: Features, new_centers: Centers, cost: str = "cost"
) -> DataFrame:
    """Squared distance to the closest centre so far.

    If ``df`` already has the cost against earlier centres, only the distances to
    the new ones are computed and the smaller value is kept.
    """
    found = assign(df, features, new_centers, "__cluster", "__new_cost", FILTERED_TERMS).drop("__cluster")
    smaller = F.least(cost, "__new_cost") if cost in df.columns else F.col("__new_cost")
    return found.withColumn(cost, smaller).drop("__new_cost")


def parallel_round(
    costed: DataFrame, k: int, seed: int, round_number: int, key: Key = None, cost: str = "cost"
) -> DataFrame:
    """Rows drawn as new candidates, each with probability ``2 k cost / total cost``.

    About ``2 k`` rows come out on average, whatever the size of the input.
    """
    total = costed.agg(F.coalesce(F.sum(cost), F.lit(0.0))).first()[0]
    if total <= 0.0:
        return costed.limit(0)
    probability = F.lit(2.0) * F.col(cost) * F.lit(float(k)) / F.lit(total)
    return sample_by_probability(costed, probability, key, seed, round_number)


def check_key(df: DataFrame, features: Features, key: Key) -> None:
    """Raise if rows that differ share keys: they would be drawn all or none. Copies of a row may share one."""
    if not key:
        return
    columns = [features] if isinstance(features, str) else list(features)
    counts = F.approx_count_distinct(F.struct(*key)), F.approx_count_distinct(F.struct(*key, *columns))
    keys, rows = df.agg(*counts).first()
    if keys < MOSTLY_UNIQUE * rows:
        raise ValueError(f"the key has about {keys} values for {rows} different rows")


def parallel_candidates(
    df: DataFrame, features: Features, k: int, steps: int, seed: int, key: Key = None
) -> Centers:
    """Distinct candidates after ``steps`` oversampling rounds: about ``1 + 2 k steps``."""
    # Once, as the key is the same in every round.
    check_key(df, features, key)
    candidates = first_center(df, features, seed, key)
    newest, costed = candidates, df
    for round_number in range(steps):
        if not newest:
            break
        costed = with_cost(costed, features, newest, "__candidate_cost")
        chosen = parallel_round(costed, k, seed, round_number, key, "__candidate_cost")
        # Copies of a row are one candidate; made distinct before they are collected,
        # as a key that is not unique draws all copies together. Sorted, as the order
        # of collected rows depends on the partitioning.
        columns = [features] if isinstance(features, str) else list(features)
        newest = sorted(_points(chosen.select(*columns).dropDuplicates(), features))
        candidates = candidates + newest
    return _distinct(candidates)


def candidate_weights(df: DataFrame, features: Features, candidates: Centers) -> DataFrame:
    """(candidate, n): how many rows are closest to each candidate, 0 included."""
    spark = df.sparkSession
    counts = assign(df, features, candidates, "candidate").groupBy("candidate").agg(F.count(F.lit(1)).alias("n"))
    every = spark.createDataFrame([(j,) for j in range(len(candidates))], "candidate int")
    # One row per candidate on either side.
    joined = every.join(F.broadcast(counts), "candidate", "left")
    return joined.select("candidate", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def reduce_candidates(candidates: Centers, weights: Sequence[int], k: int) -> Centers:
    """Cluster the weighted candidates themselves down to ``k`` centres.

    The heaviest candidate is the first centre, the next is the one with the largest
    weight times squared distance to the centres so far (ties: the first candidate);
    then weighted passes until nothing moves, REDUCE_ROUNDS at most. There are about
    ``2 k`` candidates per round, so this takes no Spark job.
    """
    if len(candidates) <= k:
        return candidates
    x, w = np.array(candidates, dtype="float64"), np.array(weights, dtype="float64")
    x, w = x[w > 0], w[w > 0]
    centers = x[[int(w.argmax())]]
    while len(centers) < min(k, len(x)):
        gain = w * _squares(x, centers).min(1)
        centers = np.vstack([centers, x[int(gain.argmax())]])
    for _ in range(REDUCE_ROUNDS):
        owner = _squares(x, centers).argmin(1)
        means = [np.average(x[owner == j], 0, w[owner == j]) if (owner == j).any() else c for j, c in enumerate(centers)]
        if np.array_equal(means, centers):
            break
        centers = np.array(means)
    return centers.tolist()


def parallel_start(
    df: DataFrame, features: Features, k: int, steps: int, seed: int, key: Key = None
) -> Centers:
    """k-means||: oversample candidates, weigh them by the rows they attract, reduce to ``k``."""
    candidates = parallel_candidates(df, features, k, steps, seed, key)
    if len(candidates) <= k:
        return candidates
    # One number per candidate.
    weights = {r.candidate: r.n for r in candidate_weights(df, features, candidates).collect()}
    return reduce_candidates(candidates, [weights[j] for j in range(len(candidates))], k)


def candidates_frame(spark: SparkSession, features: Features, candidates: Centers) -> DataFrame:
    """(candidate, attribute, value), one row per number."""
    names = attribute_names(features, candidates)
    rows = [(j, a, float(v)) for j, c in enumerate(candidates) for a, v in zip(names, c, strict=True)]
    return spark.createDataFrame(rows, "candidate int, attribute string, value double")


def _points(rows: DataFrame, features: Features) -> Centers:
    """The sampled rows' features on the driver; callers pass about k rows only."""
    return [[float(v) for v in r.x] for r in rows.select(feature_array(features).alias("x")).collect()]


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((x[:, None] - centers[None]) ** 2).sum(2)


def _distinct(points: Centers) -> Centers:
    return [list(p) for p in dict.fromkeys(tuple(p) for p in points)]


def _checked(points: Centers) -> Centers:
    if not points:
        raise ValueError("no rows to choose start centres from")
    return points


