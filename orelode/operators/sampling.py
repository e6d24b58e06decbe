"""Splits and samples.

All draws come from ``keyed_uniform``, so the same key and seed pick the same
rows whatever the partitioning. Without a key they fall back on ``F.rand``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.keyed import uniform

#: Bits of a uniform, those counted in one scan, and rows of the last bucket, which is sorted.
NUMBER_BITS, LEVEL_BITS, SMALL = 52, 13, 10_000

Key = Sequence[str | Column] | None


def with_split_flag(df: DataFrame, train_share: float, key: Key, seed: int, flag: str = "in_train") -> DataFrame:
    """Mark each row as training or test row. Narrow: no shuffle."""
    if not 0.0 <= train_share <= 1.0:
        raise ValueError(f"training share must be between 0 and 1 but got {train_share}")
    return df.withColumn(flag, uniform(key, seed) < F.lit(float(train_share)))


def split_train_test(df: DataFrame, train_share: float, key: Key, seed: int) -> tuple[DataFrame, DataFrame]:
    """Two disjoint DataFrames that together hold every row."""
    flagged = with_split_flag(df, train_share, key, seed, "__in_train")
    return (
        flagged.filter("__in_train").drop("__in_train"),
        flagged.filter("NOT __in_train").drop("__in_train"),
    )


def take_sample(df: DataFrame, n: int, key: Key, seed: int) -> DataFrame:
    """``n`` rows without replacement: the smallest uniforms, a distributed top-n."""
    # As a column the uniform is computed once per row, not at every comparison.
    drawn = df.withColumn("__u", uniform(key, seed))
    return drawn.orderBy("__u").limit(n).drop("__u")


def take_many(df: DataFrame, n: int, key: Sequence[str | Column], seed: int) -> DataFrame:
    """The rows of ``take_sample``, for any ``n``: the threshold is found first, and then rows are only filtered.

    The uniforms are counted by their first bits, the bucket that holds the n-th smallest by the
    next bits, and so on until it has SMALL rows or no bits are left. Each count is one scan, combined
    per task, of which 2**LEVEL_BITS rows come back. Only that last bucket is sorted. Rows that
    share a key share a uniform, and any of them may be the ones taken; there must be few.
    """
    if not key:
        raise ValueError("a large sample needs a key, as rows are drawn in several scans")
    if n <= 0:
        return df.limit(0)
    number = (uniform(key, seed) * F.lit(float(2**NUMBER_BITS))).cast("long")
    below, prefix, shift = 0, 0, NUMBER_BITS
    while True:
        inside = df.select(number.alias("number")).where(F.shiftright("number", shift) == prefix)
        shift -= LEVEL_BITS
        counts = inside.groupBy(F.shiftright("number", shift).alias("bucket")).count().collect()
        for bucket, count in sorted(tuple(r) for r in counts):
            if below + count >= n:
                break
            below += count
        else:
            return df
        prefix = bucket
        if count <= SMALL or not shift:
            break
    # A column of its own, computed once per row.
    drawn = df.withColumn("__number", number)
    bucket = F.shiftright("__number", shift)
    last = drawn.where(bucket == prefix).orderBy("__number").limit(n - below)
    return drawn.where(bucket < prefix).unionByName(last).drop("__number")


def sample_by_probability(df: DataFrame, probability: Column, key: Key, *seed: int) -> DataFrame:
    """Keep each row with its own probability."""
    return df.filter(uniform(key, *seed) < probability)
