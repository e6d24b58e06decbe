from __future__ import annotations

import pytest

from orelode.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) rows, with the other columns and some of clashing names."""

    def make(rows: list[tuple], parts: int = 3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, node long, g string, size string"
        full = [(r[0], r[1], *(list(r[2:]) + [None] * 2)[:2], None, -1, "g", None) for r in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make
