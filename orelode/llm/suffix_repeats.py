"""Repeated byte strings: an enhanced suffix array in shards.

Every string of LENGTH bytes is assigned to an anchor, the GRAM bytes in it with the
least hash; equal strings have equal anchors. The strings that share an anchor's place
form a stretch of text, so a shard that gets all stretches of an anchor sees every
repeat of their strings, and the corpus is dealt out by anchors. Stretches that are
equal as a whole need no look inside. For the others the shard sorts their suffixes of
LENGTH bytes and more, computes the common prefixes of neighbours and scans these with a
stack: the intervals of the common-prefix tree are the repeats that cannot be extended
to the right, each with all of its occurrences. Those whose occurrences have different
bytes on their left cannot be extended there either. They cover every repeated string.

Stretches end where the next anchor takes over, so a longer repeat comes as several
groups, one per stretch, which overlap in the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelode.llm.arrays import BLOCK_BYTES, mix, prefix_hashes, row_blocks, span_hashes, utf8
from orelode.sources.storage import stage

GRAM = 32
#: Stretches of one anchor that a shard sorts together; more are split by what they share (``_split``).
GROUP_STRETCHES = 2000
#: Stretches whose suffixes are sorted at a time.
SORTED_STRETCHES = 4000

_POSITION = np.uint64((1 << 24) - 1)
#: A stretch's shape: its strings, and this times the bytes of it that stand before the anchor.
_SHAPE = 1 << 12


def without_repeats(df: DataFrame, length: int = 200, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end) and kept (binary) of each row.

    ``spans`` are the maximal runs of bytes covered by strings of ``length`` bytes that
    also start elsewhere in the corpus, in the same text included; ``kept`` is the rest
    of the text. All copies are removed, none is preferred. Repeated rows and equal texts
    repeat each other. Texts that are null, empty or shorter than ``length`` have no
    spans; a null text is empty. Other columns of ``df`` are not read.
    """
    rows = df.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    occurrences, covers = repeat_groups(rows, length)
    whole = occurrences.where("single").selectExpr("d", "e", "lo as start", f"lo + shape % {_SHAPE} + {length - 1} as end")
    inner = occurrences.where("not single").join(covers, ["g", "s"]).select("d", "e", "lo", F.inline("spans"))
    inner = inner.selectExpr("d", "e", "lo + start as start", "lo + end as end")
    spans = whole.unionByName(inner).groupBy("d", "e").agg(F.collect_set(F.struct("start", "end")).alias("covered"))
    spans = stage(spans, "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found, kept = [], []
            for i, covered in enumerate(batch.column(2)):
                own = data[offsets[i] : offsets[i + 1]]
                merged = merge([(c["start"], c["end"]) for c in covered.as_py() or ()])
                mask = np.ones(len(own), bool)
                for a, b in merged:
                    mask[a:b] = False
                found.append([{"start": a, "end": b} for a, b in merged])
                kept.append(own[mask].tobytes())
            sizes = pa.array(np.diff(offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(found, _SPANS), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    marked = _marked(rows)
    joined = marked.join(spans, ["d", "e"], "left").select("doc_id", "text", "covered")
    kind = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def repeat_groups(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Occurrences of the stretches that may repeat, and the repeats inside of those that differ.

    The first has d, e (which text), lo (where in it), shape, g, s (anchor and content)
    and single: all stretches of the anchor are equal, so all of this one repeats. The
    second has, for the others, g, s and spans in the stretch.
    """
    stretches = _stretches(rows, length)
    anchors = stretches.groupBy("g").agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b"))
    anchors = stage(anchors.where("n > 1").selectExpr("g", "a = b as single"), "anchors")
    occurrences = stage(stretches.join(anchors, "g"), "occurrences")
    differing = occurrences.where("not single").groupBy("g", "s")
    differing = differing.agg(F.count("*").alias("n"), F.min(F.struct("d", "e", "lo", "shape")).alias("at"))
    differing = stage(differing.select("g", "s", "n", "at.*"), "differing")
    return occurrences, _covers(stage(_with_bytes(rows, differing, length), "stretches"), length)


def _stretches(rows: DataFrame, length: int) -> DataFrame:
    """g, s, d, e, lo, shape of every stretch of every text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for first, stop in row_blocks(offsets):
                where = offsets[first : stop + 1] - offsets[first]
                block = data[offsets[first] : offsets[stop]]
                d, e = _keys(block, where)
                for shift, part, edges in _chunks(block, where, length):
                    g, s, lo, shape = stretches_of(part, edges, length)
                    if len(g):
                        owner = np.searchsorted(where, lo + shift, "right") - 1
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(pa.array(x.view(np.int64)) for x in (g, s)),
                                pa.array(d[owner]),
                                pa.array(e[owner]),
                                pa.array((lo + shift - where[owner]).astype(np.int32)),
                                pa.array(shape.astype(np.int32)),
                            ],
                            names=["g", "s", "d", "e", "lo", "shape"],
                        )

    return rows.select("text").mapInArrow(find, "g long, s long, d long, e int, lo int, shape int")


def stretches_of(data: np.ndarray, edges: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, place and shape of the stretches of the texts between ``edges``."""
    m, reach = len(data) - length + 1, length - GRAM + 1
    if m <= 0:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    sums = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = span_hashes(sums, at, at + GRAM)
    anchor = (_sliding_minimum((grams & ~_POSITION) | at.astype(np.uint64), reach)[:m] & _POSITION).astype(np.int64)
    inside = np.zeros(m + 1, np.int64)
    # A string that crosses the edge of a text is none.
    for edge in edges[1:-1]:
        inside[max(0, min(m, edge - length + 1))] += 1
        inside[min(m, edge)] -= 1
    x = np.flatnonzero(np.cumsum(inside)[:m] == 0)
    if not len(x):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    begin = np.flatnonzero(np.concatenate([[True], (np.diff(x) != 1) | (np.diff(anchor[x]) != 0)]))
    lo, windows = x[begin], np.diff(np.append(begin, len(x)))
    before = anchor[lo] - lo
    content = span_hashes(sums, lo, lo + windows + length - 1) ^ mix(before.astype(np.uint64))
    return grams[anchor[lo]], content, lo, before * _SHAPE + windows


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from running minima over blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _chunks(data: np.ndarray, edges: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a block that overlap by the bytes of one string less one; more than one only for a long text."""
    for start in range(0, max(1, len(data) - length + 1), 2 * BLOCK_BYTES):
        stop = min(len(data), start + 2 * BLOCK_BYTES + length - 1)
        inner = edges[(edges > start) & (edges < stop)] - start
        yield start, data[start:stop], np.concatenate([[0], inner, [stop - start]])


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of a digest of each text, as a long and an int: equal texts have one key."""
    raw = data.tobytes()
    digests = b"".join(
        hashlib.blake2b(raw[a:b], digest_size=12).digest() for a, b in zip(offsets, offsets[1:], strict=False)
    )
    keys = np.frombuffer(digests, np.dtype([("d", "<i8"), ("e", "<i4")]))
    return keys["d"].copy(), keys["e"].copy()


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with the key of each text."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, e = _keys(*utf8(batch.column(batch.schema.get_field_index("text"))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(d), pa.array(e)], names=[*batch.schema.names, "d", "e"]
            )

    keys = [T.StructField("d", T.LongType()), T.StructField("e", T.IntegerType())]
    return rows.mapInArrow(mark, T.StructType([*rows.schema.fields, *keys]))


def _with_bytes(rows: DataFrame, differing: DataFrame, length: int) -> DataFrame:
    """g, s, n, before, cell, width, bytes of the stretches, cut from one of the texts that hold them."""
    wanted = differing.groupBy("d", "e").agg(F.collect_list(F.struct("g", "s", "n", "lo", "shape")).alias("wanted"))
    # Copies of a text are brought down to one before they are shuffled.
    texts = _marked(rows.select("text")).groupBy("d", "e").agg(F.first("text").alias("text"))
    held = texts.join(wanted, ["d", "e"]).select("text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, wanted_here in enumerate(batch.column(1).to_pylist()):
                own, out = data[offsets[i] : offsets[i + 1]], []
                for w in wanted_here:
                    before, windows = divmod(w["shape"], _SHAPE)
                    content = own[w["lo"] : w["lo"] + windows + length - 1].tobytes()
                    out.append((w["g"], w["s"], w["n"], before, 0, 1 << (length - 1).bit_length(), content))
                yield _batch(out, _STRETCH)

    return held.mapInArrow(cut, _STRETCH_SCHEMA)


def _covers(stretches: DataFrame, length: int) -> DataFrame:
    """g, s, spans of all stretches that repeat in part or whole; groups may have any size."""
    levels, todo = [], stretches
    while True:
        large = stage(todo.groupBy("g").agg(F.count("*").alias("k")).where(f"k > {GROUP_STRETCHES}"), "large")
        if large.isEmpty():
            done = stage(_sorted_groups(todo, length), "covers")
            break
        marked = todo.join(large, "g", "left")
        found = stage(_sorted_groups(marked.where("k is null").drop("k"), length), "covers")
        parts = stage(_split(marked.where("k is not null").drop("k"), length), "halves")
        levels.append((found, parts.select("g", "s", "g2", "s2", "shift")))
        # Halves that are equal are one stretch of the next level, with the sum of their numbers.
        equal = parts.groupBy("g2", "s2", "before", "cell", "width").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes"))
        todo = stage(equal.selectExpr("g2 as g", "s2 as s", "n", "before", "cell", "width", "bytes"), "stretches")
    for found, parts in reversed(levels):
        inner = parts.join(done.toDF("g2", "s2", "spans"), ["g2", "s2"]).select("g", "s", "shift", F.inline("spans"))
        span = F.struct((F.col("start") + F.col("shift")).alias("start"), (F.col("end") + F.col("shift")).alias("end"))
        done = stage(found.unionByName(inner.select("g", "s", F.array(span).alias("spans"))), "covers")
    return done


def _split(stretches: DataFrame, length: int) -> DataFrame:
    """The strings of each stretch in two halves, by the bytes they have before the anchor.

    A cell holds the strings with ``cell`` to ``cell + width - 1`` bytes before the anchor.
    Equal strings are in one half, and there in one group, which is named by the bytes
    that all strings of the half have in common. A half of width 1 has one string, so
    halving ends: there a group is one string.
    """

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                half = r["width"] // 2
                for cell in (r["cell"], r["cell"] + half):
                    windows = len(r["bytes"]) - length + 1
                    top = min(r["before"], cell + half - 1)
                    low = max(r["before"] - windows + 1, cell)
                    if low > top:
                        continue
                    shift = r["before"] - top
                    content = r["bytes"][shift : r["before"] - low + length]
                    common = r["bytes"][r["before"] - cell : r["before"] - cell - half + 1 + length]
                    g2, s2 = _number(cell, half, common), _number(top, cell, content)
                    out.append((r["g"], r["s"], r["n"], top, cell, half, content, g2, s2, shift))
            yield _batch(out, _HALF)

    return stretches.mapInArrow(halve, f"{_STRETCH_SCHEMA}, g2 long, s2 long, shift int")


def _number(a: int, b: int, content: bytes) -> int:
    named = hashlib.blake2b(content, digest_size=8, salt=f"{a},{b}".encode()).digest()
    return int.from_bytes(named, "little", signed=True)


def _sorted_groups(stretches: DataFrame, length: int) -> DataFrame:
    """g, s, spans of the stretches whose groups are small enough to be sorted in one go."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.select(["g", "s", "n", "bytes"]).to_pylist():
                if len(held) >= SORTED_STRETCHES and row["g"] != held[-1]["g"]:
                    yield _found(held, length)
                    held = []
                held.append(row)
        if held:
            yield _found(held, length)

    return stretches.repartition("g").sortWithinPartitions("g").mapInArrow(
        scan, "g long, s long, spans array<struct<start: int, end: int>>"
    )


def _found(rows: list[dict], length: int) -> pa.RecordBatch:
    texts = [r["bytes"] for r in rows]
    covered: list[list[tuple[int, int]]] = [[] for _ in rows]
    for depth, members in maximal_repeats(texts, length):
        for text, start in members:
            covered[text].append((start, start + depth))
    out = []
    for row, spans in zip(rows, covered, strict=True):
        if row["n"] > 1:
            spans = [(0, len(row["bytes"]))]
        if spans:
            out.append((row["g"], row["s"], [{"start": a, "end": b} for a, b in merge(spans)]))
    return _batch(out, pa.schema([("g", pa.int64()), ("s", pa.int64()), ("spans", pa.list_(_SPAN32))]))


def maximal_repeats(texts: list[bytes], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(bytes, occurrences as (text, start)) of the repeats of ``length`` bytes and more that cannot be extended.

    An occurrence is given with the longest repeat that starts there; that of a shorter
    one also are those of the longer ones inside of its interval.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    windows = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(texts)), windows)
    x = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + (ends - sizes)[owner]
    if not len(x):
        return
    # The first ``length`` bytes are one symbol: their hash, confirmed below.
    head = span_hashes(prefix_hashes(data), x, x + length)
    left = np.where(x > (ends - sizes)[owner], data[x - 1].astype(np.int64), -1)
    order = np.argsort(head, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], np.diff(head[order]) != 0]))
    count = np.diff(np.append(begin, len(order)))
    low, high = np.minimum.reduceat(left[order], begin), np.maximum.reduceat(left[order], begin)
    # With one byte to the left of all occurrences, the repeat starts further left.
    useful = np.repeat((count > 1) & ((low < 0) | (low != high)), count)
    chosen = order[useful]
    if not len(chosen):
        return
    x, owner, left, head = x[chosen], owner[chosen], left[chosen], head[chosen]
    rest = ends[owner] - x - length
    tail = _tails(data, x + length, rest)
    keys = tail.view(">u8")
    order = np.lexsort([*keys.T[::-1], head])
    x, owner, left, head, rest, tail = (v[order] for v in (x, owner, left, head, rest, tail))
    common = _common(tail, rest)
    body = data[x[:, None] + np.arange(length)]
    same = (head[1:] == head[:-1]) & (body[1:] == body[:-1]).all(1)
    prefix = np.where(same, length + common, 0)
    varied = np.concatenate([[0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0))])
    depth = np.zeros(len(x), np.int64)
    groups = []
    for a, b, shared in intervals(prefix):
        if varied[b] > varied[a] or left[a] < 0:
            inside = depth[a : b + 1]
            groups.append((shared, a + np.flatnonzero(inside == 0)))
            inside[inside == 0] = shared
    origin = (ends - sizes)[owner]
    for shared, members in groups:
        yield int(shared), [(int(owner[i]), int(x[i] - origin[i])) for i in members]


def intervals(prefix: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, common prefix) of the intervals of the common-prefix tree, inner ones first.

    ``prefix`` has the common prefix of each suffix with the next; those of 0 end all.
    """
    stack: list[tuple[int, int]] = []
    for i, shared in enumerate([*prefix.tolist(), 0]):
        start = i
        while stack and stack[-1][1] > shared:
            start, depth = stack.pop()
            yield start, i, depth
        if shared and (not stack or stack[-1][1] < shared):
            stack.append((start, shared))


def _tails(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes from ``start`` on, a row each, filled with zeros to a multiple of 8."""
    width = max(8, -(-int(size.max()) // 8) * 8)
    at = start[:, None] + np.arange(width)
    return np.where(np.arange(width) < size[:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


def _common(tail: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The equal bytes at the beginning of each row and the next."""
    differ = tail[1:] != tail[:-1]
    first = np.where(differ.any(1), differ.argmax(1), tail.shape[1])
    return np.minimum(first, np.minimum(size[1:], size[:-1]))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_STRETCH_SCHEMA = "g long, s long, n long, before int, cell int, width int, bytes binary"
_STRETCH = pa.schema(
    [(c, pa.int64()) for c in ("g", "s", "n")] + [(c, pa.int32()) for c in ("before", "cell", "width")]
    + [("bytes", pa.binary())]
)
_HALF = pa.schema([*_STRETCH, ("g2", pa.int64()), ("s2", pa.int64()), ("shift", pa.int32())])
_SPAN32 = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
