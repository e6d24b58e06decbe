"""Mixing sources to target weights by hash thresholds, without sorting.

Every document has a number from the hash of its id and text. A source whose target is r
times its size takes every document floor(r) times, and those below a threshold once more.
The threshold is read from a histogram of the source's words over the first 12 bits of the
number; only the bucket that holds it is counted again over the next 12 bits, and the
bucket in that over the last. Rows that share the number at the threshold, as repeated rows
do, are staged and told apart by histograms over numbers of their own. All of it is
DataFrame operations on narrow columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.sources.storage import stage

#: Bits of the document's number that one histogram tells apart, and the number of histograms.
LEVEL_BITS, LEVELS = 12, 3
#: A target is at most so many times the words of its source.
MOST = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """The number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_number(doc: Column, text: Column) -> Column:
    """A keyed number of LEVEL_BITS * LEVELS bits, the same for rows of equal id and text."""
    digits = LEVEL_BITS * LEVELS // 4
    whole = F.concat_ws(":", F.coalesce(doc.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, digits), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: list[float]) -> DataFrame:
    """source, source_size, target from rows of (source, source_size), one per source.

    Sources in order, null last, take ``weights`` in turn and share the sum of all sizes
    by them. No target exceeds MOST times its source; the excess goes to the others by
    weight. That is a common level L with target = min(MOST * size, L * weight): sources
    are capped in the order of MOST * size / weight, so L follows from running totals.
    """
    turn = F.expr("row_number() over (order by source asc nulls last)") - 1
    weight = reduce(
        lambda rest, i: F.when(F.pmod(turn, F.lit(len(weights))) == i, F.lit(float(weights[i]))).otherwise(rest),
        range(len(weights)),
        F.lit(None),
    )
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    ordered = "over (order by cap / weight, source asc nulls last rows between unbounded preceding and 1 preceding)"
    level = f"""(sum(source_size) over () - coalesce(sum(cap) {ordered}, 0))
        / (sum(weight) over () - coalesce(sum(weight) {ordered}, 0))"""
    # The level of the first source that it does not cap; those of later sources are lower.
    found = rows.withColumn("level", F.expr(level)).withColumn(
        "level", F.expr("max(case when level * weight <= cap then level end) over ()")
    )
    return found.selectExpr(
        "source", "source_size", "cast(least(cap, coalesce(level * weight, cap)) as double) as target"
    )


def mix(
    df: DataFrame,
    weights: list[float] = (5.0, 2.0, 1.0),
    doc: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """doc_id, source, size (words), source_size, target and copies (0 to MOST) of each row.

    A null text has 0 words; null sources are one source, the last in order. The words
    taken of a source differ from its target by no more than the words of one document,
    also where ids are null or repeated; of rows that are equal in id, text and source any
    may be the ones taken once more. No rows give no rows.
    """
    size, number = word_count(F.col(text)).alias("size"), document_number(F.col(doc), F.col(text)).alias("number")
    rows = df.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), size, number)
    rows = stage(rows, "mixture")
    return _with_copies(rows, _plan(rows, weights)).select("doc_id", "source", "size", "source_size", "target", "copies")


def repeat_rows(
    df: DataFrame,
    weights: list[float] = (5.0, 2.0, 1.0),
    doc: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The rows of ``df``, all columns unchanged, each as often as the mix takes it."""
    size, number = word_count(F.col(text)).alias("size"), document_number(F.col(doc), F.col(text)).alias("number")
    plan = _plan(stage(df.select(F.col(source).alias("source"), size, number), "mixture"), weights)
    packed = df.select(F.col(source).alias("source"), size, number, F.struct("*").alias("row"))
    taken = _with_copies(packed, plan).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def _plan(rows: DataFrame, weights: list[float]) -> DataFrame:
    """source, source_size, target, whole, and the boundary number with what is left for its rows (``spare``, of ``last`` words in ``held`` rows)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stage(
        targets(sizes, weights).selectExpr(
            "source", "source_size", "target",
            "cast(floor(target / greatest(source_size, 1)) as int) as whole",
            "target - floor(target / greatest(source_size, 1)) * source_size as budget",
        ),
        "mixture-targets",
    )
    state = _threshold(rows, plan.selectExpr("source", "budget", "0L as prefix", "0L as before"), "mixture-level")
    limits = state.selectExpr("source as of", "prefix as boundary", "budget - before as spare", "last", "held")
    return stage(plan.join(limits, plan["source"].eqNullSafe(limits["of"])).drop("of", "budget"), "mixture-plan")


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, size, number and others) with copies, source_size and target."""
    names = [*rows.columns, "source_size", "target"]
    limits = plan.withColumnRenamed("source", "of")
    placed = rows.join(limits, rows["source"].eqNullSafe(limits["of"])).drop("of")
    # The last row is taken once more if that comes nearer to the budget than leaving it.
    more = F.when(F.col("number") < F.col("boundary"), 1).when((F.col("number") == F.col("boundary")) & (2 * F.col("spare") >= F.col("last")), 1)
    shared = (F.col("number") == F.col("boundary")) & (F.col("held") > 1)
    copies = (F.col("whole") + F.coalesce(more, F.lit(0))).alias("copies")
    if plan.where("held > 1").isEmpty():
        return placed.select(*names, copies)
    own = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - LEVEL_BITS * LEVELS)
    alike = stage(placed.where(shared).withColumn("own", own), "mixture-alike")
    state = alike.groupBy("source").agg(F.first("spare").alias("budget")).selectExpr("source", "budget", "0L as prefix", "0L as before")
    found = _threshold(alike.selectExpr("source", "size", "own as number"), state, "mixture-alike-level")
    found = found.selectExpr("source as of", "prefix + if(2 * (budget - before) >= last, 1, 0) as least")
    split = alike.join(found, alike["source"].eqNullSafe(found["of"]))
    split = split.select(*names, (F.col("whole") + (F.col("own") < F.col("least")).cast("int")).alias("copies"))
    return placed.where(~shared).select(*names, copies).unionByName(split)


def _threshold(rows: DataFrame, state: DataFrame, what: str) -> DataFrame:
    """source, budget, prefix (the number that holds the budget's end), before, last and held (words and rows of that number)."""
    for level in range(1, LEVELS + 1):
        state = stage(_refine(rows, state, level), f"{what}-{level}")
    return state


def _refine(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Count the boundary bucket of each source over the next bits and find the boundary in there.

    ``prefix`` is the boundary bucket so far, ``before`` the words of all buckets before it.
    """
    shift = LEVEL_BITS * (LEVELS - level)
    inside = state.selectExpr("source as of", "budget", "prefix", "before")
    bucket = F.shiftright("number", shift)
    held = rows.select("source", "size", bucket.alias("bucket")).join(
        inside,
        F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")),
    )
    counted = held.groupBy("source", "bucket").agg(
        F.sum("size").alias("n"), F.count("*").alias("held"), F.first("budget").alias("budget"), F.first("before").alias("before")
    )
    running = """before - n + sum(n) over
        (partition by source order by bucket rows between unbounded preceding and current row)"""
    found = counted.withColumn("upto", F.expr(running)).where("upto <= budget")
    # The last bucket whose words begin within the budget.
    last = found.groupBy("source").agg(F.max(F.struct("bucket", "upto", "n", "held", "budget")).alias("m"))
    return last.selectExpr("source", "m.budget as budget", "m.bucket as prefix", "m.upto as before", "m.n as last", "m.held as held")
