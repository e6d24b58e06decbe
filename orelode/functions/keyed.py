"""Repeatable random numbers that depend on the row's key, not on its partition.

``F.rand(seed)`` changes when the same rows are partitioned differently. The
uniform below is a hash of the key and the seed, so a re-run, a retried task or
another cluster size draws the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 52 bits of the hash: every value is exact in a double, and the smallest
# probability that can be told from 0 is far below one row of any table.
_BITS = 52


def keyed_uniform(key: Sequence[str | Column], *seed: int) -> Column:
    """A uniform number in [0, 1) from the key columns and any number of seeds.

    The hash looks at types: cast if the same key is an int here and a bigint there.
    """
    seeds = [F.lit(int(s)).cast("bigint") for s in seed]
    hashed = F.xxhash64(*seeds, *[_column(k) for k in key])
    return F.shiftrightunsigned(hashed, 64 - _BITS).cast("double") / F.lit(float(2**_BITS))


def uniform(key: Sequence[str | Column] | None, *seed: int) -> Column:
    """``keyed_uniform`` if the rows have a key, else Spark's own generator."""
    if key:
        return keyed_uniform(key, *seed)
    mixed = 0
    for s in seed:
        mixed = mixed * 1_000_003 + int(s)
    return F.rand(mixed % (2**63))


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
