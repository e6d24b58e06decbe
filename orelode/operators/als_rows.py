"""Alternating least squares without blocks: a hot user or item is spread over tasks.

A half step gives each user the vector that solves its regularised least squares, given the
items' vectors (and the other way around)::

    (sum y y' + reg n I) x = sum rating y        over the user's n ratings

The ratings meet the items' vectors in an equi-join and are dealt by user. Users with more
than 1 in HOT_SHARE of the ratings are dealt in slices by item: each slice adds up its part of
both sums, and only these sums, as large as the model's rank squared, meet to be solved. There
are at most HOT_SHARE such users, whatever the data. Everything in between is staged in the
shared folder, and start vectors are hashed from ids, so lost executors, other partitions and
other clusters change nothing but the last digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.functions.keyed import keyed_uniform
from orelode.operators.als import LAMBDA
from orelode.session import ship_package
from orelode.sources.staging import discard, stage

#: Owners of more than this share of all ratings are cut into slices of about that size.
HOT_SHARE = 1000
#: Bytes of products that a task holds at once.
BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class FactorModel:
    """``users`` and ``items``: id and factors (array of doubles), staged in the shared folder."""

    users: DataFrame
    items: DataFrame
    rank: int

    def predict(self, pairs: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
        """(user, item, prediction) of the pairs whose user and item the model knows; repeated pairs stay."""
        users = self.users.select(F.col("id").alias("user"), F.col("factors").alias("x"))
        items = self.items.select(F.col("id").alias("item"), F.col("factors").alias("y"))
        known = pairs.select(F.col(user).alias("user"), F.col(item).alias("item")).join(users, "user").join(items, "item")
        product = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return known.select("user", "item", product.alias("prediction"))

    def factors(self) -> DataFrame:
        """(side, id, position, value), every number of both tables."""
        sides = [
            t.select(F.lit(side).alias("side"), "id", F.posexplode("factors").alias("position", "value"))
            for side, t in (("user", self.users), ("item", self.items))
        ]
        return sides[0].unionByName(sides[1])


def train(
    ratings: DataFrame,
    rank: int,
    iterations: int,
    seed: int = 0,
    user: str = "user",
    item: str = "item",
    rating: str = "rating",
    reg: float = LAMBDA,
) -> FactorModel:
    """Factorise (user, item, rating); ids are whole numbers. Repeated pairs are ratings of their own.

    NULL ids or ratings and ratings that are not finite raise. Each iteration computes the items'
    vectors and then the users'; without iterations the users' start vectors are all there is.
    """
    if rank < 1 or iterations < 0 or not reg > 0:
        raise ValueError(f"rank {rank}, iterations {iterations} and reg {reg} must be positive")
    rows = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("rating"))
    good = F.col("user").isNotNull() & F.col("item").isNotNull() & (F.abs("rating") < float("inf"))
    checked = F.when(good, F.col("rating")).otherwise(F.raise_error(F.lit("a rating without user, item or finite number")).cast("double"))
    rows = stage(rows.withColumn("rating", checked), "ratings")
    n = rows.count()
    hot = {side: _hot(rows, side, n) for side in ("user", "item")}
    users = stage(rows.select(F.col("user").alias("id")).distinct().select("id", start_factors("id", rank, seed).alias("factors")), "user-factors")
    items = stage(users.limit(0), "item-factors")
    for _ in range(iterations):
        before = items, users
        items = half_step(rows, users, "item", "user", rank, reg, hot["item"])
        users = half_step(rows, items, "user", "item", rank, reg, hot["user"])
        for old in before:
            discard(old)
    return FactorModel(users, items, rank)


def start_factors(column: str, rank: int, seed: int):
    """Numbers from 0 to 1 by id, position and seed."""
    return F.array(*[keyed_uniform([column], seed, p) for p in range(rank)])


def half_step(
    rows: DataFrame, factors: DataFrame, own: str, other: str, rank: int, reg: float, hot: DataFrame | None = None
) -> DataFrame:
    """id, factors of the ``own`` side of staged (user, item, rating), given the vectors of the ``other`` side.

    ``hot`` (id, slices) names the owners to be cut; they are at most HOT_SHARE.
    """
    # The tasks call this module's functions.
    ship_package(rows.sparkSession)
    vectors = factors.select(F.col("id").alias(other), F.col("factors").alias("y"))
    joined = rows.join(vectors, other)
    slice_ = F.lit(0)
    if hot is not None:
        joined = joined.join(F.broadcast(hot.withColumnRenamed("id", own)), own, "left")
        slice_ = F.when(F.col("slices").isNull(), -1).otherwise(F.pmod(F.xxhash64(other, "rating"), F.col("slices")))
    dealt = joined.select(F.col(own).cast("long").alias("id"), slice_.cast("int").alias("slice"), "rating", "y")
    dealt = dealt.repartition("id", "slice").sortWithinPartitions("id", "slice")
    cells = rank * (rank + 1) // 2 + rank
    schema = "id long, slice int, n long, sums array<double>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, sums in _added(batches, rank):
            yield _sums_batch(keys, n, sums)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = batch.column(2).flatten().to_numpy().reshape(-1, cells)
            x = solved(sums, batch.column(1).to_numpy(), rank, reg)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * rank, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "factors"])

    sums = dealt.mapInArrow(add, schema)
    if hot is not None:
        # Only the slices of hot owners meet again, a row of sums each.
        sums = stage(sums, "partial-sums")
        parts = sums.where("slice >= 0").select("id", "n", F.posexplode("sums").alias("place", "s"))
        whole = parts.groupBy("id", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        whole = whole.groupBy("id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "s"))).alias("sums"))
        sums = sums.where("slice < 0").select("id", "n", "sums").unionByName(whole.select("id", "n", F.col("sums.s").alias("sums")))
    kind = rows.schema[own].dataType
    found = sums.select("id", "n", "sums").mapInArrow(solve, "id long, factors array<double>")
    return stage(found.select(F.col("id").cast(kind).alias("id"), "factors"), f"{own}-factors")


def solved(sums: np.ndarray, n: np.ndarray, rank: int, reg: float) -> np.ndarray:
    """The vectors of owners from their sums: products of vectors (upper triangle), then ratings times vectors."""
    upper = np.triu_indices(rank)
    a = np.zeros((len(sums), rank, rank))
    a[:, upper[0], upper[1]] = a[:, upper[1], upper[0]] = sums[:, : len(upper[0])]
    a[:, np.arange(rank), np.arange(rank)] += reg * n[:, None]
    return np.linalg.solve(a, sums[:, len(upper[0]) :, None])[:, :, 0]


def _added(batches: Iterator[pa.RecordBatch], rank: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, slice), count and sums of rows in their order; an owner that goes on in the next batch waits for it."""
    upper = np.triu_indices(rank)
    held = None
    step = max(1, BLOCK_BYTES // (8 * (len(upper[0]) + rank)))
    for batch in batches:
        keys = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns[:2]], axis=1)
        rating, y = batch.column(2).to_numpy(), batch.column(3).flatten().to_numpy().reshape(-1, rank)
        for begin in range(0, len(keys), step):
            here = slice(begin, begin + step)
            own, part = keys[here], y[here]
            products = np.concatenate([part[:, upper[0]] * part[:, upper[1]], rating[here, None] * part], axis=1)
            edges = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]).any(1)]))
            sums, n = np.add.reduceat(products, edges, axis=0), np.diff(np.append(edges, len(own)))
            own = own[edges]
            if held is not None:
                if (held[0][0] == own[0]).all():
                    n[0] += held[1][0]
                    sums[0] += held[2][0]
                else:
                    yield held
            if len(own) > 1:
                yield own[:-1], n[:-1], sums[:-1]
            held = own[-1:], n[-1:], sums[-1:]
    if held is not None:
        yield held


def _sums_batch(keys: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(sums) + 1) * sums.shape[1], pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))
    columns = [pa.array(keys[:, 0]), pa.array(keys[:, 1].astype(np.int32)), pa.array(n.astype(np.int64)), lists]
    return pa.RecordBatch.from_arrays(columns, names=["id", "slice", "n", "sums"])


def _hot(rows: DataFrame, side: str, n: int) -> DataFrame | None:
    """id, slices of the owners of more than 1 in HOT_SHARE of the ratings, if there are any."""
    limit = max(1, n // HOT_SHARE)
    counts = rows.groupBy(F.col(side).alias("id")).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    hot = stage(counts.select("id", F.ceil(F.col("n") / limit).cast("int").alias("slices")), f"hot-{side}")
    return None if hot.isEmpty() else hot
