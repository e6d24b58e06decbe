"""Near-duplicate documents: MinHash with tensored tables, and links confirmed on full sets.

Two collections of HALVES keys, each made of WIDTH minimum hashes, give HALVES squared
tables: table (i, j) is keyed by key i of the first and key j of the second collection.
So 2 * HALVES * WIDTH hash functions serve HALVES ** 2 tables of 2 * WIDTH functions.
Documents of similarity s share a table with probability (1 - (1 - s**WIDTH)**HALVES)**2:
0.9996 for s = 0.8, 0.99997 for s = 0.85, 0.0001 for s = 0.1.

Documents of equal sets form a class and are handled once. In a table's bucket every
class is compared with the first one, its leader, and not with all others. Where a class
and a leader stay apart, all classes that met this leader in some table are taken
together: those outside of the largest component among them are held against all of them
by a bound that never rules out a link, and what passes is compared. So no link that a
table shows is lost, and no bucket is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelode.llm.arrays import SPACED, row_blocks, shingles, utf8
from orelode.llm.components import TASK_ROWS, components
from orelode.operators.partitions import gather
from orelode.sources.storage import stage

WIDTH, HALVES = 3, 12
#: Parts that sets are counted in for the bound, and classes of one side of a block.
SIGNATURE, BLOCK_MEMBERS = 256, 2048
#: Classes whose keys, and pairs whose texts, are worth a task.
TASK_CLASSES, TASK_PAIRS = 4000, 1000

_SALT = np.random.default_rng(11).integers(1, 1 << 63, (2, 2 * HALVES * WIDTH), dtype=np.uint64)
_CHUNK = 4096


def near_duplicates(
    df: DataFrame, size: int = 5, share: int = 80, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class (digest of the shingle set) of each row.

    Sets hold the distinct runs of ``size`` words of the whole lower-case text, or the
    whole text if it has fewer. Two rows are linked if 100 * common >= share * all of
    their shingles. component_id is the smallest id reachable over links, kept says
    whether that is the row's own.

    A null or empty text, or one of white space, has no set: it is linked with nothing
    and its class is null. Rows with one id are told apart by their class; repeated rows
    are alike in all columns. A null id is never the smallest unless all are null.
    """
    rows = stage(_sketches(df, size, doc, text), "sketches")
    classes = rows.where("class is not null").groupBy("class")
    nodes = classes.agg(F.min("doc_id").alias("doc_id"), F.first("u").alias("u"), F.first("v").alias("v"))
    # Each class makes HALVES squared keys, so they are dealt to many tasks before that.
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_CLASSES))
    nodes = nodes.repartition(min(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "classes")
    found = _components(df, nodes, size, share, doc, text)

    # Most classes have no link, so only those that do are named by their component.
    linked, every = found.count(), nodes.select("node", "class", "doc_id")
    owner = stage(gather(every.join(found, "node"), linked, TASK_ROWS), "class-components")
    smallest = owner.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    smallest = stage(gather(smallest, linked, TASK_ROWS), "smallest")
    ids = stage(gather(owner.join(smallest, "component").select("node", "component_id"), linked, TASK_ROWS), "ids")
    named = every.join(ids, "node", "left").select("class", F.coalesce("component_id", "doc_id").alias("component_id"))
    named = stage(gather(named, nodes.count(), TASK_ROWS), "class-ids")
    out = rows.join(named, "class", "left").withColumn(
        "component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select("doc_id", "n_shingles", "component_id", kept, "class")


def keep_one(df: DataFrame, size: int = 5, share: int = 80, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns unchanged, less all but one of each group of near duplicates.

    The one with the smallest id stays; of repeated rows one. Rows without words all stay.
    """
    names = df.columns
    kept = near_duplicates(df, size, share, doc, text).where("kept and class is not null").groupBy("doc_id", "class").count()
    kept = stage(kept.withColumnsRenamed({"doc_id": "__doc", "class": "__kept"}), "kept")
    marked = _with_class(df, size, text)
    same = marked[doc].eqNullSafe(kept["__doc"]) & (marked["__class"] == kept["__kept"])
    # Joins with whole texts are merge joins at every size, so the smallest table tells what the largest takes.
    out = marked.join(kept.hint("merge"), same, "left").where("__class is null or __kept is not null")
    if not kept.where("count > 1").isEmpty():
        wordless, others = out.where("__class is null"), out.where("__class is not null")
        out = others.dropDuplicates([doc, "__class"]).unionByName(wordless)
    return out.select(*[F.col(f"`{c}`") for c in names])


def _components(df: DataFrame, nodes: DataFrame, size: int, share: int, doc: str, text: str) -> DataFrame:
    """node, component of the classes with links."""
    pairs = stage(gather(_met(nodes).distinct(), nodes.count(), TASK_CLASSES), "pairs")
    texts = _texts(df, nodes, pairs, size, doc, text)
    tested = stage(_compare(pairs, texts, size, share), "compared")
    links = tested.where("linked").selectExpr("node as a", "leader as b")
    found = components(links)

    # All classes of a bucket are among those that share its leader, so these groups hold every pair of a table.
    failed = _apart(tested.where("not linked").select("node", "leader"), found)
    unsettled = stage(gather(failed.select("leader").distinct(), tested.count(), TASK_ROWS), "unsettled")
    if unsettled.isEmpty():
        return found
    followers = pairs.join(unsettled, "leader").selectExpr("leader as key", "node")
    inside = followers.union(unsettled.selectExpr("leader as key", "leader as node"))
    hopeful = _hopeful(_labelled(inside, found, "node"), texts, size, share)
    hopeful = stage(gather(hopeful, pairs.count(), TASK_ROWS), "hopeful")
    met = tested.select("node", "leader").union(tested.select("leader", "node"))
    more = _apart(hopeful.join(met, ["node", "leader"], "left_anti"), found)
    more = stage(gather(more, hopeful.count(), TASK_ROWS), "more")
    new = stage(_compare(more, texts, size, share).where("linked"), "compared").selectExpr("node as a", "leader as b")
    return found if new.isEmpty() else components(links.unionByName(new))


def _met(nodes: DataFrame) -> DataFrame:
    """node, leader of each class (node, u, v) and the lowest in one of its buckets, if that is another.

    The keys are shuffled once; buckets follow each other, each with its leader first, and none is held as a whole.
    """
    keys = nodes.select("node", "v", F.explode("u").alias("a")).select("node", "a", F.explode("v").alias("b"))
    keys = keys.select(F.xxhash64("a", "b").alias("key"), "node")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros((2, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([last, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            key, node = rows
            first = np.concatenate([[True], key[1:] != key[:-1]])
            leader = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            apart = node != leader
            # The leader of the last bucket goes on to the next batch.
            last = np.stack([key[-1:], leader[-1:]])
            yield pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(leader[apart])], names=["node", "leader"])

    sorted_ = keys.repartition("key").sortWithinPartitions("key", "node")
    return gather(sorted_, nodes.count(), TASK_CLASSES).mapInArrow(meet, "node long, leader long")


def _hopeful(members: DataFrame, texts: DataFrame, size: int, share: int) -> DataFrame:
    """node, leader (the smaller) of the pairs in one group and two components that may be linked.

    ``members`` has key, node and node_component of groups. Sets are counted in
    SIGNATURE parts by hash; the sum of the smaller counts is at least what two sets have
    in common, so a pair that fails by this bound is none. Classes outside of a group's
    largest component are held against all of the group, in blocks of BLOCK_MEMBERS of
    each side, and only pairs that pass leave the task.
    """
    counted = members.groupBy("key", "node_component").agg(F.count("*").alias("n")).groupBy("key")
    sizes = counted.agg(F.max_by("node_component", "n").alias("major"), F.max("n").alias("most"), F.sum("n").alias("n"))
    sizes = sizes.where("most < n").selectExpr(
        "key", "major", f"int(ceil(n / {BLOCK_MEMBERS})) as all_blocks", f"int(ceil((n - most) / {BLOCK_MEMBERS})) as minor_blocks"
    )
    rows = members.join(sizes, "key").withColumnRenamed("node_component", "component")
    place = F.xxhash64("node", F.lit(1))
    every = rows.select(
        "key", "node", "component", F.lit(False).alias("asks"), F.pmod(place, "all_blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)).alias("j"),
    )
    minor = rows.where("component <> major").select(
        "key", "node", "component", F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("i"), F.pmod(place, "minor_blocks").cast("int").alias("j"),
    )
    dealt = every.unionByName(minor).join(_signatures(texts, size), "node")
    group = ["key", "i", "j"]
    dealt = dealt.select(*group, "node", "component", "asks", "size", "parts")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns[:3]])
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
            for start, stop in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
                own = tuple(keys[:, start])
                if own != last and held:
                    yield _pairs_within_bound(held, share)
                    held = []
                last = own
                held.append(batch.slice(start, stop - start))
        if held:
            yield _pairs_within_bound(held, share)

    sorted_ = dealt.repartition(*group).sortWithinPartitions(*group)
    return sorted_.mapInArrow(hold, "node long, leader long").distinct()


def _pairs_within_bound(held: list[pa.RecordBatch], share: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    node, component, asks, size = (table.column(c).to_numpy() for c in ("node", "component", "asks", "size"))
    parts = np.concatenate([np.frombuffer(utf8(b.column("parts"))[0], "<u4") for b in held]).reshape(len(node), -1)
    mine, others = [], []
    for u in np.flatnonzero(asks):
        apart = np.flatnonzero(~asks & (component != component[u]))
        common = np.minimum(parts[apart], parts[u]).sum(1, dtype=np.int64)
        passed = node[apart[100 * common >= share * (size[apart] + size[u] - common)]]
        mine.append(np.maximum(passed, node[u]))
        others.append(np.minimum(passed, node[u]))
    empty = np.zeros(0, np.int64)
    columns = [pa.array(np.concatenate([empty, *c])) for c in (mine, others)]
    return pa.RecordBatch.from_arrays(columns, names=["node", "leader"])


def _signatures(texts: DataFrame, size: int) -> DataFrame:
    """node, size, parts: how many shingles each class has, in all and in each part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - (SIGNATURE - 1).bit_length())
        for batch in batches:
            sets = list(sets_of(batch.column(1), size))
            parts = [np.bincount((s >> shift).astype(np.int64), minlength=SIGNATURE).astype("<u4").tobytes() for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(parts, pa.binary())], names=["node", "size", "parts"]
            )

    return texts.mapInArrow(count, "node long, size long, parts binary")


def _labelled(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """``rows`` with the component of a node column; a node without links is its own."""
    named = found.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    joined = rows.join(named, rows[column] == named["__n"], "left")
    return joined.select(*rows.columns, F.coalesce("__c", column).alias(f"{column}_component"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose components differ."""
    labelled = _labelled(_labelled(pairs, found, "node"), found, "leader")
    return labelled.where("node_component <> leader_component").select("node", "leader")


def _texts(df: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, doc: str, text: str) -> DataFrame:
    """node, text of every class that is in a pair."""
    wanted = pairs.select("node").union(pairs.select("leader")).distinct().join(nodes.select("node", "doc_id", "class"), "node")
    wanted = stage(gather(wanted, pairs.count(), TASK_ROWS), "wanted")
    docs = df.select(F.col(doc).cast("long").alias("__doc"), F.col(text).alias("text"))
    held = docs.join(wanted.hint("merge"), docs["__doc"].eqNullSafe(wanted["doc_id"])).select("node", "class", "text")

    # Rows of one id may be of several classes.
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [_digest(s) for s in sets_of(batch.column(2), size)]
            right = pa.array([d == c.as_py() for d, c in zip(digests, batch.column(1), strict=True)], pa.bool_())
            yield batch.filter(right).select(["node", "text"])

    texts = stage(held.mapInArrow(own, "node long, text string"), "texts")
    if gather(texts.groupBy("node").count().where("count > 1"), pairs.count(), TASK_ROWS).isEmpty():
        return texts
    return stage(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")


def _compare(pairs: DataFrame, texts: DataFrame, size: int, share: int) -> DataFrame:
    """node, leader, linked of each of the staged ``pairs``, on the full sets."""
    near = pairs.join(texts.hint("merge"), "node")
    far = texts.selectExpr("node as leader", "text as other")
    rows = near.join(far.hint("merge"), "leader").select("node", "leader", "text", "other")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rows of one leader follow each other.
            last, linked = (None, None), []
            for leader, own, other in zip(batch.column(1), sets_of(batch.column(2), size), batch.column(3), strict=True):
                if leader != last[0]:
                    last = (leader, next(sets_of(pa.array([other.as_py()], pa.string()), size)))
                common = len(np.intersect1d(own, last[1], assume_unique=True))
                linked.append(100 * common >= share * (len(own) + len(last[1]) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["node", "leader", "linked"]
            )

    return gather(rows, pairs.count(), TASK_PAIRS).mapInArrow(test, "node long, leader long, linked boolean")


def _sketches(df: DataFrame, size: int, doc: str, text: str) -> DataFrame:
    """doc_id, n_shingles, class, and the keys u and v of the two collections."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, keys = [], [], []
            for s in sets_of(batch.column(1), size):
                n.append(len(s))
                digests.append(_digest(s))
                keys.append(half_keys(s) if len(s) else None)
            halves = [
                pa.array([None if k is None else k[half].tolist() for k in keys], pa.list_(pa.int64())) for half in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), *halves],
                names=["doc_id", "n_shingles", "class", "u", "v"],
            )

    rows = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(sketch, "doc_id long, n_shingles long, class binary, u array<long>, v array<long>")


def _with_class(df: DataFrame, size: int, text: str) -> DataFrame:
    place = df.columns.index(text)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([_digest(s) for s in sets_of(batch.column(place), size)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "__class"])

    return df.mapInArrow(digests, T.StructType([*df.schema.fields, T.StructField("__class", T.BinaryType())]))


def sets_of(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; words are held for one block of rows at a time."""
    data, offsets = utf8(column)
    for start, stop in row_blocks(offsets):
        edges = offsets[start : stop + 1]
        words, first = SPACED.hashes(data[edges[0] : edges[-1]], edges - edges[0])
        for a, b in zip(first, first[1:], strict=False):
            yield np.unique(shingles(words[a:b], size))


def half_keys(found: np.ndarray) -> np.ndarray:
    """The keys of both collections of a set: a row per collection."""
    least = np.full(_SALT.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(found), _CHUNK):
        h = (found[i : i + _CHUNK, None] ^ _SALT[0]) * (_SALT[1] | np.uint64(1))
        np.minimum(least, h.min(0), out=least)
    groups = least.reshape(2 * HALVES, WIDTH)
    key = np.arange(2 * HALVES, dtype=np.uint64)
    for column in groups.T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.reshape(2, HALVES).view(np.int64)


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
