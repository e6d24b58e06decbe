"""A session with the settings the operators are tuned for.

Nothing here is required: the operators run in any Spark 4 session.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(app: str, cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own settings."""
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        # Call sites of every column function cost the driver a second per query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, once per application.

    The driver zips its own copy and Spark sends it to every executor, as ``--py-files``
    would; without effect where the package is installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    handle, archive = tempfile.mkstemp(prefix="orelode-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
