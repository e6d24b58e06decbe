"""A training corpus from raw documents: language, near copies, benchmark leaks, mixture, token file."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orelode.llm.pipeline import ORACLE_SQL, STAGES, run  # noqa: E402

__all__ = ["ORACLE_SQL", "STAGES", "run"]
