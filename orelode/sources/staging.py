"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

Where that is unset, local mode takes a new folder of this machine and keeps it in the
setting; anywhere else it is an error, as executors do not see each other's folders.
"""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_path(spark: SparkSession, what: str) -> str:
    """A new path for an intermediate table or model."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="orelode-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write a DataFrame and read it back: a short lineage that survives lost executors."""
    path = work_path(df.sparkSession, what)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a staged table once nothing that reads it is left to run."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder, unless the context has a folder for it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "checkpoints"))


def release(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files and cached blocks of what nothing refers to any more.

    Spark deletes them when the driver's JVM collects its garbage, which it may not do
    for half an hour. For the end of a step that shuffles much; costs two full collections
    and three seconds: Py4J tells the JVM of dropped objects once a second, and events of
    the last query still name it for a moment.
    """
    gc.collect()
    for _ in range(2):
        time.sleep(1.5)
        spark._jvm.System.gc()
