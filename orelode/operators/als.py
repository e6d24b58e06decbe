"""Recommendation by alternating least squares on explicit ratings."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.operators.partitions import persisted
from orelode.sources.staging import stage

# Fixed value: the regularisation the ratings model is trained with.
LAMBDA = 0.01

BLOCKS, RATINGS_PER_BLOCK = 8, 4_000_000


def train(
    ratings: DataFrame,
    rank: int,
    iterations: int,
    seed: int | None = None,
    user: str = "user",
    item: str = "item",
    rating: str = "rating",
    reg: float = LAMBDA,
    blocks: int | None = None,
    keep: bool = True,
) -> ALSModel:
    """Factorise (user, item, rating) with integer ids.

    Unknown users and items are dropped when the model scores. Every iteration cuts its
    lineage in the folder of ``spark.checkpoint.dir``, if the cluster names one: the
    vectors that earlier iterations sent are then deleted, not kept to the end. Ratings
    that are cheap to read again, like staged ones, need no copy: with ``keep=False``
    there is none, and blocks that memory does not hold are built again from the shuffle
    files they come from, every half step, instead of written beside them.
    The ratings are cut into ``blocks`` x ``blocks`` parts, which the result depends on.
    Unless told otherwise there is one block per RATINGS_PER_BLOCK ratings and BLOCKS at
    least, so the same ratings give the same result on any cluster. All ratings of one
    user (and of one item) are in one block.
    """
    if rank < 1:
        raise ValueError(f"rank must be positive but got {rank}")
    if iterations < 0:
        raise ValueError(f"iterations must not be negative but got {iterations}")
    estimator = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        coldStartStrategy="drop",
        checkpointInterval=1,
        intermediateStorageLevel="MEMORY_AND_DISK" if keep else "MEMORY_ONLY",
        **({} if seed is None else {"seed": seed}),
    )
    rows = ratings.select(user, item, rating)
    # Kept, as counting and fitting would compute the ratings twice.
    with persisted(rows) if keep else nullcontext():
        blocks = blocks or max(BLOCKS, -(-rows.count() // RATINGS_PER_BLOCK))
        return estimator.setNumBlocks(blocks).fit(rows)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """(user, item, prediction) for every pair the model knows; repeated pairs stay.

    Two equi-joins on the factor tables. A user or item that holds much of the pairs
    is split by Spark's adaptive skew join, which is on by default.
    """
    columns = [model.getUserCol(), model.getItemCol()]
    scored = model.setColdStartStrategy("drop").transform(pairs.select(*columns))
    return scored.select(F.col(columns[0]).alias("user"), F.col(columns[1]).alias("item"), "prediction")


def factors(model: ALSModel) -> DataFrame:
    """(side, id, position, value), every number of both factor tables."""
    sides = [
        table.select(F.lit(side).alias("side"), "id", F.posexplode("features").alias("position", "value"))
        for side, table in (("user", model.userFactors), ("item", model.itemFactors))
    ]
    return sides[0].unionByName(sides[1])


def coverage(pairs: DataFrame, ratings: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """The pairs whose user and item both occur in the ratings, repeated pairs included.

    These are the pairs ``predict`` keeps. Semi joins on distinct ids, which are written
    to the shared folder first: the adaptive join splits a hot id of the pairs only if
    nothing stands between the shuffles and the join.
    """
    users = stage(ratings.select(user).distinct(), "known-users")
    items = stage(ratings.select(item).distinct(), "known-items")
    return pairs.join(users, user, "left_semi").join(items, item, "left_semi")


def top_predictions(predictions: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` smallest (user, item, prediction) triples in their natural order."""
    return predictions.orderBy("user", "item", "prediction").limit(n)
