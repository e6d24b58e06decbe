from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from orelode.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session("tests", 8, **{"spark.checkpoint.dir": str(shared)})
    yield session
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    """Write lines to a new file and return its path."""
    count = iter(range(1000))

    def write(*rows: str) -> str:
        path = tmp_path / f"input-{next(count)}.txt"
        path.write_text("".join(r + "\n" for r in rows), encoding="utf-8")
        return str(path)

    return write
