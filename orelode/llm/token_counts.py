"""Token counts: batches in Arrow functions, lengths only.

Rows are taken in blocks of equal bytes rather than equal rows, and texts are cut at
places where a token always ends (``tokenizing``), so one very long text costs a task
no more memory than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.arrays import utf8
from orelode.llm.tokenizing import count_column


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text", keep: list[str] = ("doc_id",), limit: int = 1024) -> DataFrame:
    """``keep`` columns, n_bytes, n_tokens and over_limit (more tokens than ``limit``) of each row.

    ``tokenizer`` is a file of the tokenizers library with byte-level pieces, present on
    every executor. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are
    counted one by one; other columns of ``df`` are not read.
    """
    rows = df.select(*keep, F.col(text).alias("__text"))
    names = list(keep)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(names))
            tokens = count_column(column, tokenizer)
            sizes = np.diff(utf8(column)[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                names=[*names, "n_bytes", "n_tokens", "over_limit"],
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(measure, ", ".join([*kept, "n_bytes long", "n_tokens long", "over_limit boolean"]))
