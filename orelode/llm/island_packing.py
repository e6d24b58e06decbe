"""Packing of documents into sequences by a grouping genetic algorithm on islands.

A solution is a grouping of pieces into bins of at most ``capacity`` tokens. A crossover
takes some of the best filled bins of one parent whole into a copy of the other, takes
out the bins that hold one of their pieces again, and puts the displaced pieces back by
best fit, longest first; a mutation empties a few bins and does the same. Solutions with
fewer bins are better, and among those the ones whose free space lies in fewer bins.

Pieces are dealt by hash into shards of about SHARD_ITEMS. Every shard evolves on ISLANDS
islands, each a row of its own with its own population. After an epoch, staged in the
shared folder, the elite of every island migrates to the next one of its ring. A shard
whose best solution meets the bound (tokens / capacity, rounded up) is settled; the others
go on for EPOCHS epochs. The emptiest bins of all shards are packed anew together, level by
level, until one shard holds them, so what shards waste is no more than a bin or so of the last.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.arrays import utf8
from orelode.llm.tokenizing import encode_column
from orelode.sources.staging import stage

SHARD_ITEMS = 4096
ISLANDS, EPOCHS = 4, 4
POPULATION, GENERATIONS, CHILDREN = 6, 8, 3
#: A bin with this share of the capacity free may be packed anew with those of other shards,
#: as long as these are no more than that share of the shard's pieces.
LOOSE_SPACE, LOOSE_ITEMS = 1 / 64, 1 / 8

_PLAN = "shard long, island int, items array<long>, lengths array<int>, plan binary, bins int, fitness double, bound int, population binary"


def pack_documents(
    df: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """doc_id, piece, start, length, ids, width, ids_crc32, sequence_id, offset of each piece of a document.

    A document is its token ids and ``end_id``. Only documents of more than ``capacity``
    tokens are cut, into pieces of that many; the last piece may be shorter. ``ids`` are
    little-endian and ``width`` bytes each, the checksum is over 32-bit ids. A piece is in
    one sequence, at ``offset``; sequences have no gaps and numbers without a meaning.

    A null or empty text is the end id alone. Repeated rows and null ids are documents of
    their own. No rows give no pieces. Other columns are not read. ``tokenizer`` is a file
    of the tokenizers library that ignores case and white space.
    """
    pieces = stage(token_pieces(df, tokenizer, end_id, capacity, text, doc), "pieces")
    full = pieces.where(F.col("length") == capacity)
    full = full.withColumns({"sequence_id": -1 - F.col("number"), "offset": F.lit(0).cast("long")})
    placed = place(pieces.where(F.col("length") < capacity).selectExpr("number as item", "length"), capacity)
    tails = pieces.where(F.col("length") < capacity).join(placed.withColumnRenamed("item", "number"), "number")
    columns = ["doc_id", "piece", "start", "length", "ids", "width", "ids_crc32", "sequence_id", "offset"]
    return full.select(*columns).unionByName(tails.select(*columns))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (32-bit little-endian), doc_ids and lengths of every sequence."""
    row = F.struct("offset", "doc_id", "length", "width", "ids")
    # A sequence has at most ``capacity`` tokens and a piece at least one.
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sequence, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4") for r in rows])
                values = {
                    "sequence_id": sequence, "n_tokens": len(ids), "ids": ids.tobytes(), "doc_ids": [r["doc_id"] for r in rows],
                    "lengths": [r["length"] for r in rows],
                }
                yield pa.RecordBatch.from_pylist([values], schema=_SEQUENCE)

    return grouped.mapInArrow(join, "sequence_id long, n_tokens long, ids binary, doc_ids array<long>, lengths array<long>")


def token_pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """number, doc_id, piece, start, length, ids, width, ids_crc32; ``number`` is for the table to be written once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (start, stop), ids, offsets in encode_column(batch.column(1), tokenizer, uncased=True):
                yield _cut_documents(batch.column(0).slice(start, stop - start), ids, offsets, end_id, capacity)

    rows = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids binary, width int, ids_crc32 long")
    return pieces.withColumn("number", F.monotonically_increasing_id())


def _cut_documents(docs: pa.Array, ids: np.ndarray, offsets: np.ndarray, end_id: int, capacity: int) -> pa.RecordBatch:
    n = len(docs)
    whole = np.full(len(ids) + n, end_id, ids.dtype)
    whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    size = np.diff(offsets) + 1
    parts = -(-size // capacity)
    owner = np.repeat(np.arange(n), parts)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    length = np.minimum(size[owner] - piece * capacity, capacity)
    # The pieces follow each other as the documents do.
    edges = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    wide = memoryview(whole.astype("<u4").tobytes())
    sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(edges, edges[1:], strict=False)]
    column = pa.Array.from_buffers(
        pa.large_binary(), len(owner), [None, pa.py_buffer(edges * whole.itemsize), pa.py_buffer(np.ascontiguousarray(whole))]
    )
    return pa.RecordBatch.from_arrays(
        [
            docs.take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(length, pa.int64()),
            column.cast(pa.binary()), pa.array(np.full(len(owner), whole.itemsize), pa.int32()), pa.array(sums, pa.int64()),
        ],
        names=["doc_id", "piece", "start", "length", "ids", "width", "ids_crc32"],
    )


def place(items: DataFrame, capacity: int) -> DataFrame:
    """item, sequence_id, offset: items (item, length) in sequences of at most ``capacity``.

    ``items`` must be staged, ``item`` different in every row and 1 <= length <= capacity.
    """
    levels, level = [], 0
    while True:
        n = items.count()
        shards = max(1, -(-n // SHARD_ITEMS))
        found = stage(_laid_out(_evolved(items, shards, level, capacity), level, shards > 1, capacity), "placed")
        levels.append(found.where("not loose").select("item", "sequence_id", "offset"))
        if shards == 1:
            break
        items, level = found.where("loose").select("item", "length"), level + 1
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def _evolved(items: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    """The best plan found for every shard: shard, items, lengths, plan."""
    spark = items.sparkSession
    # A task holds a bounded number of islands at once.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards * ISLANDS // 64))
    shard = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards)).alias("shard")
    # By hash a shard has SHARD_ITEMS items, a tenth more at the most.
    row = F.struct(F.col("length").cast("int").alias("length"), "item")
    dealt = items.select(shard, row.alias("row")).groupBy("shard").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    islands = dealt.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "rows")
    state = islands.select(
        "shard", "island", F.col("rows.item").alias("items"), F.col("rows.length").alias("lengths"),
        F.lit(None).cast("binary").alias("population"), F.lit(None).cast("binary").alias("immigrant"),
    )
    settled = None
    for epoch in range(EPOCHS):
        seed = level * EPOCHS + epoch

        def evolve(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _evolve_row(batch.slice(i, 1).to_pylist()[0], seed, capacity)

        state = stage(state.repartition(tasks, "shard", "island").mapInArrow(evolve, _PLAN), "islands")
        rank = F.struct(-F.col("bins"), F.col("fitness"), -F.col("island"))
        best = state.groupBy("shard").agg(
            F.max_by(F.struct("items", "lengths", "plan"), rank).alias("best"), F.min("bins").alias("least"), F.first("bound").alias("bound")
        )
        last = epoch + 1 == EPOCHS
        done = best if last else best.where("least <= bound")
        done = done.select("shard", "best.*")
        settled = done if settled is None else settled.unionByName(done)
        if last:
            break
        # One row per shard, of which most are settled.
        open_ = stage(best.where("least > bound").select("shard"), "open-shards")
        if open_.isEmpty():
            break
        going = state.join(open_, "shard", "left_semi")
        elite = going.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("plan").alias("immigrant"))
        state = going.join(elite, ["shard", "island"]).select("shard", "island", "items", "lengths", "population", "immigrant")
    return settled


def _laid_out(plans: DataFrame, level: int, more: bool, capacity: int) -> DataFrame:
    """item, length, sequence_id, offset, loose of every item of the plans."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, items, lengths, plan = (c[i] for c in batch.columns)
                items, lengths = (np.array(c.values) for c in (items, lengths))
                bins = np.frombuffer(plan.as_buffer(), "<i4").astype(np.int64)
                order = np.lexsort((items, bins))
                items, lengths, bins = items[order], lengths[order].astype(np.int64), bins[order]
                ends = np.cumsum(lengths)
                first = np.searchsorted(bins, bins)
                loose = loose_bins(bins, lengths, capacity)[bins] if more else np.zeros(len(bins), bool)
                number = np.int64((level << 56) + (shard.as_py() << 20)) + bins
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items), pa.array(lengths), pa.array(number), pa.array(ends - lengths - (ends - lengths)[first]), pa.array(loose)],
                    names=["item", "length", "sequence_id", "offset", "loose"],
                )

    return plans.select("shard", "items", "lengths", "plan").mapInArrow(
        lay, "item long, length long, sequence_id long, offset long, loose boolean"
    )


def loose_bins(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Which bins to pack anew: the emptiest ones, within LOOSE_SPACE and LOOSE_ITEMS."""
    fill, held = np.bincount(bins, lengths), np.bincount(bins)
    order = np.argsort(fill, kind="stable")
    chosen = np.cumsum(held[order]) <= len(bins) * LOOSE_ITEMS
    chosen &= capacity - fill[order] >= capacity * LOOSE_SPACE
    loose = np.zeros(len(fill), bool)
    loose[order[chosen]] = True
    return loose


def _evolve_row(row: dict, seed: int, capacity: int) -> pa.RecordBatch:
    lengths = np.array(row["lengths"], np.int64)
    rng = np.random.default_rng([row["shard"], row["island"], seed])
    held = []
    if row["population"] is not None:
        held = list(np.frombuffer(row["population"], "<i4").reshape(-1, len(lengths)).astype(np.int64))
        held.append(np.frombuffer(row["immigrant"], "<i4").astype(np.int64))
    population = evolve(lengths, capacity, rng, held)
    bins, squares = fitness(population[0], lengths, capacity)
    values = {
        "shard": row["shard"], "island": row["island"], "items": row["items"], "lengths": row["lengths"],
        "plan": population[0].astype("<i4").tobytes(), "bins": bins, "fitness": squares,
        "bound": -(-int(lengths.sum()) // capacity), "population": np.concatenate(population).astype("<i4").tobytes(),
    }
    return pa.RecordBatch.from_pylist([values], schema=_PLAN_TYPES)


def evolve(lengths: np.ndarray, capacity: int, rng: np.random.Generator, held: list[np.ndarray] = ()) -> list[np.ndarray]:
    """A population after GENERATIONS generations, the best plan first. A plan has the bin of each item."""
    population = list(held)
    if not population:
        # Longest first, with ties in any order, and orders that are shuffled more and more.
        for k in range(POPULATION):
            order = np.argsort(-lengths * np.exp(rng.normal(0, 0.15 * k, len(lengths))), kind="stable")
            population.append(best_fit(lengths, np.full(len(lengths), -1), order, capacity))
    ranked = _ranked(population, lengths, capacity)
    for _ in range(GENERATIONS):
        children = []
        for _ in range(CHILDREN):
            a, b = (ranked[min(rng.integers(len(ranked), size=2))] for _ in range(2))
            children.append(crossover(a, b, lengths, capacity, rng))
        ranked = _ranked([*ranked, *children], lengths, capacity)[:POPULATION]
    return ranked


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with some well filled bins of ``b``, a few of its other bins emptied, and all displaced items by best fit."""
    fill = np.bincount(b, lengths)
    count = 1 + int(rng.integers(max(1, len(fill) // 16)))
    best = np.argsort(-fill, kind="stable")[: max(count, len(fill) // 2)]
    taken = np.zeros(len(fill), bool)
    taken[rng.choice(best, count, replace=False)] = True
    injected = taken[b]
    bins = int(a.max()) + 1
    gone = np.zeros(bins, bool)
    gone[a[injected]] = True
    # Mutation: the emptiest bins and one more.
    spare = np.argsort(np.bincount(a, lengths), kind="stable")[:2]
    gone[spare] = True
    gone[rng.integers(bins)] = True
    child = np.where(gone[a], -1, a)
    child[injected] = bins + b[injected]
    displaced = np.flatnonzero(child < 0)
    used = child >= 0
    child[used] = np.unique(child[used], return_inverse=True)[1]
    displaced = swap(child, lengths, displaced, capacity)
    order = displaced[np.lexsort((rng.random(len(displaced)), -lengths[displaced]))]
    return best_fit(lengths, child, order, capacity)


def swap(plan: np.ndarray, lengths: np.ndarray, displaced: np.ndarray, capacity: int) -> np.ndarray:
    """Exchange an item of a bin for a longer displaced one that fits instead; ``plan`` changes. Returns what is displaced then.

    Smaller items are left over, which best fit has more places for.
    """
    spare = displaced[np.argsort(lengths[displaced], kind="stable")].tolist()
    sizes = lengths[spare].tolist()
    inside = np.flatnonzero(plan >= 0)
    inside = inside[np.argsort(plan[inside], kind="stable")]
    owner, ends = np.unique(plan[inside], return_index=True)
    ends = [*ends[1:].tolist(), len(inside)]
    space = (capacity - np.bincount(plan[inside], lengths[inside])).astype(np.int64).tolist() if len(inside) else []
    members, begin = inside.tolist(), 0
    own = lengths[inside].tolist()
    for j, end in zip(owner.tolist(), ends, strict=True):
        left = space[j]
        if left and sizes:
            gain, which, at = 0, -1, -1
            for k in range(begin, end):
                found = bisect_right(sizes, own[k] + left) - 1
                if found >= 0 and sizes[found] - own[k] > gain:
                    gain, which, at = sizes[found] - own[k], k, found
            if gain:
                item, put = members[which], spare.pop(at)
                del sizes[at]
                plan[put], plan[item] = j, -1
                back = bisect_left(sizes, own[which])
                spare.insert(back, item)
                sizes.insert(back, own[which])
        begin = end
    return np.array(spare, np.int64)


def best_fit(lengths: np.ndarray, plan: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """``plan`` with the items of ``order``, which had no bin, each in the fullest bin it fits in, or a new one.

    Bins are kept by their free space, and the spaces in use are the bits of one whole number.
    """
    plan = plan.copy()
    used = plan >= 0
    free = (capacity - np.bincount(plan[used], lengths[used])).astype(np.int64).tolist() if used.any() else []
    by_space: dict[int, list[int]] = {}
    spaces = 0
    for j, space in enumerate(free):
        by_space.setdefault(space, []).append(j)
        spaces |= 1 << space
    count, chosen = len(free), []
    for length in lengths[order].tolist():
        fitting = spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            same = by_space[space]
            j = same.pop()
            if not same:
                spaces ^= 1 << space
        else:
            space, j = capacity, count
            count += 1
        left = space - length
        same = by_space.get(left)
        if same:
            same.append(j)
        else:
            by_space[left] = [j]
            spaces |= 1 << left
        chosen.append(j)
    plan[order] = chosen
    return plan


def fitness(plan: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Bins, and the mean square of their fill."""
    if not len(plan):
        return 0, 0.0
    fill = np.bincount(plan, lengths) / capacity
    return len(fill), float((fill * fill).mean())


def _ranked(plans: list[np.ndarray], lengths: np.ndarray, capacity: int) -> list[np.ndarray]:
    scores = [fitness(p, lengths, capacity) for p in plans]
    return [plans[i] for i in sorted(range(len(plans)), key=lambda i: (scores[i][0], -scores[i][1]))]


_PLAN_TYPES = pa.schema(
    [
        ("shard", pa.int64()), ("island", pa.int32()), ("items", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
        ("plan", pa.binary()), ("bins", pa.int32()), ("fitness", pa.float64()), ("bound", pa.int32()), ("population", pa.binary()),
    ]
)

_SEQUENCE = pa.schema(
    [("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]
)
