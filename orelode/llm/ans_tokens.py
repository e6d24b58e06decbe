"""Token ids as static range asymmetric numeral codes (rANS), in a block format.

A token file is a folder with three Parquet tables, so that Spark commits, splits and
reads them on any store:

* ``table``: token, freq. The shared frequency table; frequencies sum to 2**20.
* ``blocks``: one row per block of whole documents: shard, block, inside (tokens of the
  shard before it), n_docs, n_tokens, docs and lengths (arrays), words (the code, 32-bit little-endian), at (word position
  and the state of every lane at each checkpoint), code_crc32, ids_crc32.
* ``shards``: shard, start. Tokens before the first one of a shard.

Blocks are independent. Inside one, token i belongs to lane i mod LANES, all lanes share
one stream, and every CHECKPOINT steps the lanes' states are kept, so that decoding can
start there as well as at the beginning.

Shards and blocks are in ascending order of document; null documents come first, and
rows of one document follow in the order of a hash of their ids. A repeated row is a
document of its own. A null or empty text holds the end id alone. No rows at all make a
file without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.llm.arrays import utf8
from orelode.llm.tokenizing import encode_column
from orelode.sources.storage import stage

SCALE_BITS = 20
LANES = 256
CHECKPOINT = 256
BLOCK_TOKENS = 1 << 17
#: States stay in [LOW, LOW << 32); 32 bits leave or enter at a time.
LOW = 1 << 31

BLOCKS = (
    "shard int, block int, inside long, n_docs int, n_tokens long, docs array<long>, lengths array<long>, "
    "words binary, at binary, code_crc32 long, ids_crc32 long"
)


def token_ids(df: DataFrame, tokenizer: str, end_id: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """doc_id and the ids of each text with the end id, as 32-bit little-endian bytes.

    ``tokenizer`` is a file of the tokenizers library that ignores case and white space.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (start, stop), ids, offsets in encode_column(batch.column(1), tokenizer, uncased=True):
                n = stop - start
                out = np.full(len(ids) + n, end_id, ids.dtype)
                out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
                where = (offsets + np.arange(n + 1)) * ids.dtype.itemsize
                column = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(where.astype(np.int64)), pa.py_buffer(out)]
                )
                wide = pa.array([ids.dtype.itemsize] * n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), column.cast(pa.binary()), wide], names=["doc_id", "ids", "width"]
                )

    rows = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids binary, width int")


def staged_ids(df: DataFrame, tokenizer: str, end_id: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``token_ids`` in a table of the shared folder, each row with a number of its own (``tie``)."""
    tie = F.monotonically_increasing_id().alias("tie")
    return stage(token_ids(df, tokenizer, end_id, text, doc).select("*", tie), "token-ids")


def write(tokens: DataFrame, path: str) -> None:
    """Write staged rows of ``token_ids`` as a token file at a new path. ``tokens`` is read twice."""
    spark = tokens.sparkSession
    frequencies(tokens).write.mode("errorifexists").parquet(f"{path}/table")
    table = _load_table(spark, path)
    shared = spark.sparkContext.broadcast(table)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encode_shard(batches, *shared.value)

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Hash and tie also split a document that has a large share of the rows.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("tie")]
    ordered = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "ids", "width")
    ordered.mapInArrow(blocks, BLOCKS).write.mode("errorifexists").parquet(f"{path}/blocks")
    _shard_starts(spark, path).write.mode("errorifexists").parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decode a token file: doc_id, start (ids before it), n_tokens, ids_crc32, ids (32-bit).

    A block whose code or ids do not have the recorded checksum raises.
    """
    # One row per shard, as many as the writer had shuffle partitions.
    starts = {r.shard: r.start for r in spark.read.parquet(f"{path}/shards").collect()}
    shared = spark.sparkContext.broadcast(_load_table(spark, path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _decoded_documents(row, starts[row["shard"]] + row["inside"], *shared.value)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    return spark.read.parquet(f"{path}/blocks").mapInArrow(decode, schema)


def frequencies(tokens: DataFrame) -> DataFrame:
    """token, freq: counts of all ids, scaled to sum to 2**SCALE_BITS with at least 1 each.

    Every task sends one row per distinct token; the scaling sees at most the vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            # All rows come from one tokenizer, so they have one width.
            part = np.bincount(utf8(batch.column(0))[0].view(f"<u{batch.column(1)[0].as_py()}"))
            total = np.pad(total, (0, max(0, len(part) - len(total))))
            total[: len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["token", "n"])

    counted = tokens.select("ids", "width").mapInArrow(count, "token long, n long").groupBy("token")
    rows = sorted((r.token, r.n) for r in counted.agg(F.sum("n").alias("n")).collect())
    spark = tokens.sparkSession
    if not rows:
        return spark.createDataFrame([], "token long, freq long")
    freq = scale(np.array([n for _, n in rows], np.float64))
    data = [(token, int(f)) for (token, _), f in zip(rows, freq, strict=True)]
    return spark.createDataFrame(data, "token long, freq long").coalesce(1)


def scale(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies of at least 1 that sum to 2**SCALE_BITS."""
    total = 1 << SCALE_BITS
    if len(counts) > total // 2:
        raise ValueError(f"at most {total // 2} distinct tokens, not {len(counts)}")
    spare = total - len(counts)
    exact = counts / counts.sum() * spare
    freq = np.floor(exact).astype(np.int64)
    rest = spare - int(freq.sum())
    freq[np.argsort(freq - exact, kind="stable")[:rest]] += 1
    return freq + 1


def encode_block(symbols: np.ndarray, freq: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code words of a block, and (word position, lane states) at every checkpoint.

    ``symbols`` are positions in the table. Codes are made from the last step to the
    first, so that reading goes forwards.
    """
    steps = -(-len(symbols) // LANES)
    f, c = freq[symbols].astype(np.uint64), first[symbols].astype(np.uint64)
    state = np.full(LANES, LOW, np.uint64)
    words: list[np.ndarray] = []
    at, written = [], 0
    shift, limit_bits = np.uint64(32), np.uint64(63 - SCALE_BITS)
    for step in range(steps - 1, -1, -1):
        here = slice(step * LANES, min((step + 1) * LANES, len(symbols)))
        fs, x = f[here], state[: here.stop - here.start]
        full = np.flatnonzero(x >= fs << limit_bits)
        if len(full):
            out = x[full].astype(np.uint32)
            x[full] >>= shift
            words.append(out[::-1])
            written += len(out)
        q = x // fs
        x[:] = (q << np.uint64(SCALE_BITS)) + (x - q * fs) + c[here]
        if step % CHECKPOINT == 0:
            at.append((written, state.copy()))
    code = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
    marks = [np.concatenate([[np.uint64(written - w)], s]) for w, s in reversed(at)]
    return np.ascontiguousarray(code), np.array(marks, np.uint64).reshape(-1, LANES + 1)


def decode_from(
    code: np.ndarray, marks: np.ndarray, n: int, freq: np.ndarray, first: np.ndarray, slots: np.ndarray, checkpoint: int = 0
) -> np.ndarray:
    """Table positions from a checkpoint to the block's end."""
    begin = checkpoint * CHECKPOINT
    out = np.empty(n - begin * LANES, np.int64) if n else np.zeros(0, np.int64)
    if not n:
        return out
    place, state = int(marks[checkpoint, 0]), marks[checkpoint, 1:].copy()
    mask, low, shift = np.uint64((1 << SCALE_BITS) - 1), np.uint64(LOW), np.uint64(32)
    for start in range(0, len(out), LANES):
        stop = min(start + LANES, len(out))
        x = state[: stop - start]
        slot = x & mask
        s = slots[slot]
        out[start:stop] = s
        x[:] = freq[s] * (x >> np.uint64(SCALE_BITS)) + slot - first[s]
        empty = np.flatnonzero(x < low)
        if len(empty):
            x[empty] = (x[empty] << shift) | code[place : place + len(empty)]
            place += len(empty)
    return out


def _encode_shard(
    batches: Iterator[pa.RecordBatch], tokens: np.ndarray, freq: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Blocks of whole documents of about BLOCK_TOKENS tokens."""
    position = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
    position[tokens] = np.arange(len(tokens))
    first = np.cumsum(freq) - freq
    docs, held, size, block, shard, inside = [], [], 0, 0, 0, 0

    def flush() -> pa.RecordBatch:
        ids = np.concatenate(held).astype(np.int64)
        code, marks = encode_block(position[ids], freq, first)
        row = {
            "shard": shard, "block": block, "inside": inside, "n_docs": len(docs), "n_tokens": len(ids), "docs": docs,
            "lengths": [len(h) for h in held], "words": code.astype("<u4").tobytes(),
            "at": marks.astype("<u8").tobytes(), "code_crc32": zlib.crc32(code.astype("<u4").tobytes()),
            "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()),
        }
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK_TYPES)

    for batch in batches:
        for s, doc, ids, width in zip(*batch.columns, strict=True):
            shard = s.as_py()
            docs.append(doc.as_py())
            held.append(np.frombuffer(ids.as_buffer(), f"<u{width.as_py()}"))
            size += len(held[-1])
            if size >= BLOCK_TOKENS:
                yield flush()
                docs, held, size, block, inside = [], [], 0, block + 1, inside + size
    if docs:
        yield flush()


def _decoded_documents(row: dict, start: int, tokens: np.ndarray, freq: np.ndarray) -> Iterator[pa.RecordBatch]:
    where = f"shard {row['shard']}, block {row['block']}"
    if zlib.crc32(row["words"]) != row["code_crc32"]:
        raise ValueError(f"{where}: the code is damaged")
    ids = decode_block(row, tokens, freq)
    if zlib.crc32(ids.tobytes()) != row["ids_crc32"]:
        raise ValueError(f"{where}: the ids are damaged")
    lengths = np.array(row["lengths"], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    parts = [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(row["docs"], pa.int64()),
            pa.array(offsets[:-1] + start),
            pa.array(lengths),
            pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            pa.array(parts, pa.binary()),
        ],
        names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
    )


def decode_block(row: dict, tokens: np.ndarray, freq: np.ndarray, checkpoint: int = 0) -> np.ndarray:
    """The ids of a block from a checkpoint on, 32-bit little-endian."""
    first = np.cumsum(freq) - freq
    if _slots.get("of") is not freq:
        _slots.update({"of": freq, "slots": np.repeat(np.arange(len(freq)), freq)})
    code = np.frombuffer(row["words"], "<u4").astype(np.uint64)
    marks = np.frombuffer(row["at"], "<u8").reshape(-1, LANES + 1)
    f, c = freq.astype(np.uint64), first.astype(np.uint64)
    return tokens[decode_from(code, marks, row["n_tokens"], f, c, _slots["slots"], checkpoint)].astype("<u4")


#: The symbol of every slot of the table in use, made once per worker.
_slots: dict = {}

_BLOCK_TYPES = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("inside", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()),
        ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()),
        ("at", pa.binary()), ("code_crc32", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)


def _load_table(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The frequency table, as large as the vocabulary at most."""
    rows = sorted((r.token, r.freq) for r in spark.read.parquet(f"{path}/table").collect())
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def _shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, start: a running total over one row per shard."""
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    total = "sum(n) over (order by shard rows between unbounded preceding and current row) - n as start"
    return sizes.selectExpr("shard", total)


def round_trip(df: DataFrame, tokenizer: str, end_id: int, path: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Tokenize, write the token file at ``path`` and read it back."""
    write(staged_ids(df, tokenizer, end_id, text, doc), path)
    return read(df.sparkSession, path)
