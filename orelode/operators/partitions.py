"""Partitions of inputs that are small for the cluster, and of inputs read many times."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Give an input with fewer partitions than the cluster has cores one per core.

    For inputs read straight from files, before work that costs more than moving the
    rows once: a file of one row group is a single task otherwise. Large inputs have
    partitions enough and are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *key)


def gather(df: DataFrame, rows: int, each: int) -> DataFrame:
    """At most a task per ``each`` of some ``rows``, one per core at least.

    For the last step of a table that is small for the shuffle partitions: a task that
    writes a handful of rows costs what thousands do. Large tables keep their tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // each)))


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep rows that are costly to compute while an iterative job reads them again and again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
