"""Nearest neighbours by cosine: a vantage-point tree per shard.

Vectors of length 1 have the distance sqrt(2 - 2 cosine), for which the triangle
inequality holds. Each inner node keeps a vantage point and the nearest and farthest
distance to it in either half, so a half can be skipped when even its nearest edge is
farther from the query than the k-th neighbour found so far. ``factor`` multiplies that
gap: at 1 no neighbour is missed, larger values skip more.

A block of queries walks a tree together: each node is met once per block, by those
queries that cannot skip it. First every query goes down to its own leaf, so that the
skipping starts with a good k-th distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.sources.staging import stage

LEAF = 64
#: Vectors of a shard, queries that one task puts to a shard, and those that walk its tree together.
SHARD_ROWS, QUERY_ROWS, WALK_ROWS = 8192, 8192, 512
#: Rounding of cosines is far below this; sorting out candidates leaves so much room.
SLACK = 1e-9


class Tree:
    """A vantage-point tree over the rows of a matrix of unit vectors, kept in arrays."""

    def __init__(self, unit: np.ndarray):
        self.unit, self.order = unit, np.arange(len(unit))
        #: start, end, vantage row, children, and the distance range of the two halves
        self.nodes: list[tuple] = []
        self._grow(0, len(unit))

    def _grow(self, start: int, end: int) -> int:
        me = len(self.nodes)
        self.nodes.append((start, end, -1, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if end - start <= LEAF:
            return me
        rows = self.order[start:end]
        # The row farthest from the first is at the rim, which splits best.
        vantage = rows[int(np.argmin(self.unit[rows] @ self.unit[rows[0]]))]
        d = distances(self.unit[rows], self.unit[vantage][None])[:, 0]
        half = (end - start) // 2
        by = np.argpartition(d, half)
        self.order[start:end], d = rows[by], d[by]
        left = self._grow(start, start + half)
        right = self._grow(start + half, end)
        near, far = d[:half], d[half:]
        self.nodes[me] = (start, end, vantage, left, right, near.min(), near.max(), far.min(), far.max())
        return me

    def search(self, queries: np.ndarray, factor: float, visit) -> None:
        """Call ``visit(queries, rows)`` for every leaf that some queries cannot skip.

        ``visit`` returns the k-th distance of all queries so far.
        """
        reach, slack = np.full(len(queries), np.inf), distance_slack(queries.shape[1])
        home = np.zeros(len(queries), np.int64)
        self._descend(0, np.arange(len(queries)), queries, home)
        for leaf in np.unique(home):
            here = np.flatnonzero(home == leaf)
            reach[here] = visit(here, self._rows(leaf))
        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, here = stack.pop()
            _, _, vantage, left, right, *edges = self.nodes[node]
            if vantage < 0:
                here = here[home[here] != node]
                if len(here):
                    reach[here] = visit(here, self._rows(node))
                continue
            d = distances(queries[here], self.unit[vantage][None])[:, 0]
            for child, low, high in ((right, *edges[2:]), (left, *edges[:2])):
                gap = np.maximum(low - d, d - high)
                going = here[gap * factor <= reach[here] + slack]
                if len(going):
                    stack.append((child, going))

    def _descend(self, node: int, here: np.ndarray, queries: np.ndarray, home: np.ndarray) -> None:
        _, _, vantage, left, right, _, near_high, far_low, _ = self.nodes[node]
        if vantage < 0:
            home[here] = node
            return
        inner = distances(queries[here], self.unit[vantage][None])[:, 0] * 2 <= near_high + far_low
        for child, part in ((left, here[inner]), (right, here[~inner])):
            if len(part):
                self._descend(child, part, queries, home)

    def _rows(self, leaf: int) -> np.ndarray:
        return self.order[self.nodes[leaf][0] : self.nodes[leaf][1]]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def distance_slack(width: int) -> float:
    """More than what three distances of vectors of so many components are off by rounding.

    The squared distance is off by about ``width`` units in the last place at most, and
    near 0 the distance by the root of that.
    """
    return 3.0 * float(np.sqrt(4 * (width + 4) * np.finfo(np.float64).eps))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision, summed from the first component to the last."""
    return _dots(a, b) / (np.sqrt(_dots(a, a)) * np.sqrt(_dots(b, b)))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for x, y in zip(a.T, b.T, strict=True):
        total += x * y
    return total


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` rows of ``df`` nearest to each query.

    A query's own row is no candidate: of the rows with its key and exactly its direction one
    is left out, other rows of its key stay. Ties go to the smaller key, and a repeated row
    counts as often as it is there, among the candidates and (with the same query_id) among
    the queries. Null keys, and vectors that are null,
    empty, zero or hold a null or non-finite component, take no part, neither do
    candidates of another length than the query's. All candidates are returned if they
    are fewer than ``k``; no candidates or no queries give no rows.

    Shards hold about SHARD_ROWS rows each and blocks about QUERY_ROWS queries. Every
    block meets every shard in a task of its own, which returns ``k`` rows per query.
    """
    # Rows are dealt by numbers that are written once, so a task that is run again deals them alike.
    index, asked = (stage(_usable(d, key, vector).withColumn("number", F.monotonically_increasing_id()), "vectors") for d in (df, queries))
    shards = max(1, -(-index.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    index = index.withColumn("shard", _dealt(shards)).withColumn("block", _each(blocks))
    asked = asked.withColumn("block", _dealt(blocks)).withColumn("shard", _each(shards))

    def answer(key_: tuple, rows: pd.DataFrame, queries_: pd.DataFrame) -> pd.DataFrame:
        return search_shard(rows, queries_, k, factor) if len(rows) else _EMPTY

    partial = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        answer, "asked long, query_id long, vec_id long, score double, own boolean"
    )
    # k + 1 rows per query and shard; the first of the rows that may be the query's own goes.
    place = F.expr("row_number() over (partition by asked order by score desc, vec_id)")
    ranked = partial.withColumn("place", place)
    ranked = ranked.withColumn("mine", F.expr("min(case when own then place end) over (partition by asked)"))
    rank = F.expr("place - case when mine < place then 1 else 0 end").cast("int")
    ranked = ranked.where("mine is null or mine <> place").withColumn("rank", rank)
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_shard(rows: pd.DataFrame, queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    """The k + 1 rows of one shard nearest to each query of a block, as (asked, query_id, vec_id, score, own)."""
    k, out = k + 1, [_EMPTY]
    widths, asked_widths = (d["v"].map(len).to_numpy() for d in (rows, queries))
    for width in np.intersect1d(widths, asked_widths):
        part, asked = rows[widths == width], queries[asked_widths == width]
        ids, x = part["id"].to_numpy(), np.stack(part["v"].to_numpy()).astype(np.float64)
        query_ids, y = asked["id"].to_numpy(), np.stack(asked["v"].to_numpy()).astype(np.float64)
        best_ids = np.full((len(y), k), np.iinfo(np.int64).max)
        best = np.full((len(y), k), -np.inf)

        unit, asked_unit = (m / np.sqrt((m * m).sum(1, keepdims=True)) for m in (x, y))

        def visit(here: np.ndarray, leaf: np.ndarray) -> np.ndarray:
            # The matrix product finds who can enter; only for these is the score computed as specified.
            hopeful = asked_unit[here] @ unit[leaf].T >= best[here, -1:] - SLACK
            some = np.flatnonzero(hopeful.any(1))
            q, r = np.nonzero(hopeful[some])
            at = here[some]
            scores = np.full((len(some), len(leaf)), -np.inf)
            scores[q, r] = cosines(y[at[q]], x[leaf[r]])
            both = np.hstack([best[at], scores])
            named = np.hstack([best_ids[at], np.broadcast_to(ids[leaf], scores.shape)])
            pick = np.lexsort((named, -both), axis=1)[:, :k]
            best[at] = np.take_along_axis(both, pick, 1)
            best_ids[at] = np.take_along_axis(named, pick, 1)
            worst = best[here, -1]
            return np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * worst)))

        tree = Tree(unit)
        for i in range(0, len(y), WALK_ROWS):
            walking = np.arange(i, min(i + WALK_ROWS, len(y)))
            tree.search(asked_unit[walking], factor, lambda here, leaf, own=walking: visit(own[here], leaf))
        held = np.isfinite(best)
        own = (best_ids == query_ids[:, None]) & (best == cosines(y, y)[:, None])
        columns = {"asked": np.repeat(asked["number"].to_numpy(), k)[held.ravel()], "query_id": np.repeat(query_ids, k)[held.ravel()]}
        out.append(pd.DataFrame({**columns, "vec_id": best_ids[held], "score": best[held], "own": own[held]}))
    return pd.concat(out)


_EMPTY = pd.DataFrame(
    {c: pd.Series(dtype=t) for c, t in (("asked", "int64"), ("query_id", "int64"), ("vec_id", "int64"), ("score", "float64"), ("own", "bool"))}
)


def _dealt(parts: int) -> Column:
    """One of ``parts`` by the row's number, since a key may be repeated without bound."""
    return F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int")


def _each(parts: int) -> Column:
    """A row for each of ``parts``."""
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v (doubles) of the rows that take part."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
