"""Merkle manifest of a dataset: one digest for all rows, and a proof for every row.

Rows are leaves. The leaves of a group are in a given order; two nodes that follow each
other become their digest, level by level, and so does a last one that is alone, until one
node, the group's subroot, is left. The subroots, in order of their groups, are the leaves of
one more tree, whose last node is the root.

Only every STRIDE-th level is kept (checkpoints): a staged table has a row per aligned
subtree of STRIDE levels with the digests of its lowest level. Going up, a subtree is folded
to the next kept level; going down for proofs, the nodes between are computed anew from the
kept ones below them, the siblings of each path are taken, and the rest is dropped. Every
step handles subtrees of at most 2**stride nodes, in parallel, however large a group is.

Digests are lower-case hex sha256 of concatenated text, of digests their hex text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orelode.sources.staging import stage

STRIDE = 6

_SIBLINGS = "array<struct<hash: string, left: boolean>>"


@dataclass(frozen=True)
class Forest:
    """Trees over the leaves of groups.

    ``levels[c]`` has the subtrees whose lowest level is c * stride: tree, block, size (nodes
    of the tree at that level) and rows (at, hash and, for leaves, what came with them).
    ``roots`` has tree, hash and top (the c of the tree's last subtree).
    """

    levels: list[DataFrame]
    roots: DataFrame
    stride: int


@dataclass(frozen=True)
class Manifest:
    """The trees of all groups, and the one over their subroots."""

    groups: Forest
    top: Forest


def field_text(column: Column) -> Column:
    """``-`` for null, else the bytes of the value's text, a colon and the text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    """The digest of a row's fields."""
    return F.sha2(F.concat(*map(field_text, columns)).cast("binary"), 256)


def build(rows: DataFrame, group: str, order: str, leaf: str = "leaf", stride: int | None = None) -> Manifest:
    """The manifest of ``rows``, whose leaf digests are in the column ``leaf``; other columns are carried along.

    Groups and rows of a group are in ascending order, null first; rows of equal order by their
    digest. A null group is a group of its own. Repeated rows are leaves of their own. No rows
    make no trees. ``rows`` is read once; what it needs is staged in the shared folder.
    """
    stride = stride or STRIDE
    carried = [c for c in rows.columns if c not in (group, order, leaf)]
    leaves = rows.select(
        F.col(group).alias("tree"), F.col(order).alias("key"), F.col(leaf).alias("hash"),
        F.struct(F.col(order).alias(order), *[F.col(f"`{c}`") for c in carried]).alias("carried"),
    )
    groups = _grow(_numbered(leaves), stride)
    subroots = groups.roots.select(
        F.lit(0).alias("tree"), F.col("tree").alias("key"), "hash", F.struct(F.col("tree").alias("of"), F.col("top").alias("of_top")).alias("carried")
    )
    return Manifest(groups, _grow(_numbered(subroots), stride))


def proofs(manifest: Manifest) -> DataFrame:
    """tree, carried, leaf, subroot, root and siblings (hash, left; from the leaf to the root) of every leaf.

    A node without a sibling, which becomes its own digest, has a null hash in ``siblings``.
    """

    stride = manifest.groups.stride

    def emit(row: dict) -> Iterator[dict]:
        for leaf, path in _paths(row, stride):
            own = row["rows"][leaf]
            yield {
                "tree": row["tree"], "carried": own["carried"], "leaf": own["hash"], "subroot": row["subroot"], "root": row["root"],
                "siblings": path + row["siblings"],
            }

    tree, carried = _types(manifest.groups.levels[0])
    schema = f"tree {tree}, carried {carried}, leaf string, subroot string, root string, siblings {_SIBLINGS}"
    return _each_row(_with_paths(manifest), emit, schema)


def audit(manifest: Manifest, claimed: str) -> DataFrame:
    """tree, carried, leaf, subroot, root, proof_sha256, folded_root and verified of every leaf.

    ``claimed`` is the carried column with the leaf digest to be held against the manifest.
    It is folded with the siblings of the leaf; ``verified`` says whether the root comes out.
    ``proof_sha256`` is the digest of all siblings from the leaf to the root.
    """

    stride = manifest.groups.stride

    def emit(row: dict) -> Iterator[dict]:
        above = row["siblings"]
        for leaf, path in _paths(row, stride):
            own, path = row["rows"][leaf], path + above
            proof = _digest("".join([s["hash"] for s in path if s["hash"] is not None]))
            folded = fold(own["carried"][claimed], path)
            yield {
                "tree": row["tree"], "carried": own["carried"], "leaf": own["hash"], "subroot": row["subroot"], "root": row["root"],
                "proof_sha256": proof, "folded_root": folded, "verified": folded == row["root"],
            }

    tree, carried = _types(manifest.groups.levels[0])
    schema = f"tree {tree}, carried {carried}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _each_row(_with_paths(manifest), emit, schema)


def fold(leaf: str | None, siblings: list[dict]) -> str | None:
    """The root that a leaf and its siblings lead to."""
    if leaf is None:
        return None
    for s in siblings:
        if s["hash"] is None:
            leaf = _digest(leaf)
        else:
            leaf = _digest(s["hash"] + leaf if s["left"] else leaf + s["hash"])
    return leaf


def _numbered(leaves: DataFrame) -> DataFrame:
    """tree, at (place in the tree, from 0), size (leaves of the tree), hash, carried.

    Rows are sorted by range over all trees, so a tree with most of the rows is spread over
    most of the tasks; places are counted per task and tree, and the counts added up.
    """
    spark = leaves.sparkSession
    # A number per row also parts rows that are equal in all else.
    leaves = stage(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("tree").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("hash"), F.col("tie")]
    ranged = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.select("tree", "hash", "carried", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    ranged = stage(ranged, "sorted-leaves")
    # One row per task and tree that meet.
    counts = ranged.groupBy("tree", "part").agg(F.min("row").alias("least"), F.count("*").alias("n"))
    starts = counts.selectExpr(
        "tree", "part", "sum(n) over (partition by tree order by part) - n - least as shift", "sum(n) over (partition by tree) as size"
    )
    starts = stage(starts, "starts").withColumnsRenamed({"tree": "__tree", "part": "__part"})
    same = ranged["tree"].eqNullSafe(starts["__tree"]) & (ranged["part"] == starts["__part"])
    return ranged.join(starts, same).select("tree", (F.col("row") + F.col("shift")).alias("at"), "size", "hash", "carried")


def _grow(nodes: DataFrame, stride: int) -> Forest:
    """Fold nodes (tree, at, size, hash and for leaves carried) up to the roots, keeping every stride-th level."""
    levels, roots = [], None
    fold_block = partial(_fold_block, stride=stride)
    while True:
        carried = [c for c in ("carried",) if c in nodes.columns]
        row = F.struct("at", "hash", *carried)
        block = F.shiftright("at", stride).alias("block")
        # At most 2**stride rows, whatever the size of a tree.
        blocks = nodes.select("tree", block, "size", row.alias("row")).groupBy("tree", "block", "size")
        blocks = stage(blocks.agg(F.array_sort(F.collect_list("row")).alias("rows")), "subtrees")
        folded = stage(_each_row(blocks.select("tree", "block", "size", "rows.hash"), fold_block, _node_schema(blocks)), "nodes")
        # A tree that had one subtree left has come to its root.
        done = folded.where(f"below <= {1 << stride}").select("tree", "hash", F.lit(len(levels)).alias("top"))
        roots = done if roots is None else roots.unionByName(done)
        levels.append(blocks)
        nodes = folded.where(f"below > {1 << stride}").select("tree", "at", "size", "hash")
        if nodes.isEmpty():
            return Forest(levels, roots, stride)


def _fold_block(row: dict, stride: int) -> Iterator[dict]:
    size, nodes = row["size"], row["hash"]
    for _ in range(stride):
        if size == 1:
            break
        nodes, size = _above(nodes), -(-size // 2)
    yield {"tree": row["tree"], "at": row["block"], "below": row["size"], "size": size, "hash": nodes[0]}


def _above(nodes: list[str]) -> list[str]:
    return [_digest(nodes[i] + nodes[i + 1] if i + 1 < len(nodes) else nodes[i]) for i in range(0, len(nodes), 2)]


def _paths(row: dict, stride: int) -> Iterator[tuple[int, list[dict]]]:
    """Each node of a subtree's lowest level, with the siblings on its way to the subtree's root."""
    nodes, size, levels = [r["hash"] for r in row["rows"]], row["size"], []
    while len(levels) < stride and size > 1:
        levels.append(nodes)
        nodes, size = _above(nodes), -(-size // 2)
    for leaf in range(len(levels[0]) if levels else len(nodes)):
        path, at = [], leaf
        for level in levels:
            other = at ^ 1
            path.append({"hash": level[other] if other < len(level) else None, "left": other < at})
            at >>= 1
        yield leaf, path


def _with_paths(manifest: Manifest) -> DataFrame:
    """The lowest subtrees of the groups, each with the siblings from its root on, the subroot and the root."""
    top, stride = manifest.top, manifest.top.stride
    nothing = F.array().cast(_SIBLINGS)
    root = top.roots.select(
        "tree", F.lit(0).cast("long").alias("block"), "top", F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"),
        nothing.alias("siblings"),
    )
    above = _descend(top, root)

    def place(row: dict) -> Iterator[dict]:
        for leaf, path in _paths(row, stride):
            own = row["rows"][leaf]
            yield {
                "tree": own["carried"]["of"], "block": 0, "top": own["carried"]["of_top"], "subroot": own["hash"], "root": row["root"],
                "siblings": path + row["siblings"],
            }

    tree = _types(manifest.groups.levels[0])[0]
    schema = f"tree {tree}, block long, top int, subroot string, root string, siblings {_SIBLINGS}"
    subroots = stage(_each_row(above, place, schema), "subroots")
    return _descend(manifest.groups, subroots)


def _descend(forest: Forest, ends: DataFrame) -> DataFrame:
    """``levels[0]`` with what lies above each subtree.

    ``ends`` says it for the last subtree of each tree, at the level ``top``: tree, block,
    top, subroot, root, siblings.
    """
    above = None
    for c in range(len(forest.levels) - 1, -1, -1):
        here = ends.where(F.col("top") == c).drop("top")
        above = here if above is None else above.unionByName(here)
        named = above.withColumnsRenamed({"tree": "__tree", "block": "__block"})
        blocks = forest.levels[c]
        same = blocks["tree"].eqNullSafe(named["__tree"]) & (blocks["block"] == named["__block"])
        joined = blocks.join(named, same).drop("__tree", "__block")
        if c:
            above = stage(_each_row(joined, partial(_lower, stride=forest.stride), _above_schema(blocks)), "paths")
    return joined


def _lower(row: dict, stride: int) -> Iterator[dict]:
    for leaf, path in _paths(row, stride):
        yield {
            "tree": row["tree"], "block": row["rows"][leaf]["at"], "subroot": row["subroot"], "root": row["root"],
            "siblings": path + row["siblings"],
        }


def _each_row(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of every row as a dictionary; it makes any number of rows."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                made = [out for row in batch.slice(i, 64).to_pylist() for out in function(row)]
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return df.mapInArrow(run, schema)


def _types(level: DataFrame) -> tuple[str, str]:
    """SQL types of the tree's name and of what its leaves carry."""
    row = level.schema["rows"].dataType.elementType
    return level.schema["tree"].dataType.simpleString(), row["carried"].dataType.simpleString() if "carried" in row.names else "int"


def _node_schema(level: DataFrame) -> str:
    return f"tree {_types(level)[0]}, at long, below long, size long, hash string"


def _above_schema(level: DataFrame) -> str:
    return f"tree {_types(level)[0]}, block long, subroot string, root string, siblings {_SIBLINGS}"


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
