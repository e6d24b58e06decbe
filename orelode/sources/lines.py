"""Text inputs and their parsers.

A parser takes a DataFrame of lines (one string column ``value``), so files and
lines that are already in a DataFrame go through the same code. A missing field
or a bad number raises, in ANSI mode or not. Fields are not quoted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.text import class_code, number, number_or_zero
from orelode.sources.staging import stage

# The layouts of the known files, in file order.
ACTIVITY_COLUMNS = ("datetime", "CellID", "countrycode", "smsin", "smsout", "callin", "callout", "internet")
ACTIVITY_FEATURES = ("smsin", "smsout", "callin", "callout")
FLOWER_COLUMNS = ("Id", "SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm", "Species")
FLOWER_FEATURES = ("SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value), one row per line of a file, folder or glob."""
    return spark.read.text(path)


def header_line(lines: DataFrame) -> str:
    """The first line of a file input."""
    first = lines.first()
    if first is None:
        raise ValueError("no header: the input is empty")
    return first.value


def drop_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Remove the header, in every file of a folder.

    Only lines equal to the header go, not those that share its first character. An
    empty line stays and is for the parser to judge.
    """
    if header is None:
        header = header_line(lines)
    return lines.filter(F.col("value") != header)


def parse_activity(lines: DataFrame, *keep: str) -> DataFrame:
    """Phone activity: four features, an empty field is 0.0.

    Columns named in ``keep`` stay in front, here as in every parser.
    """
    rows = _fields(lines, 7)
    features = [
        number_or_zero(_field(ACTIVITY_COLUMNS.index(f)), f).alias(f) for f in ACTIVITY_FEATURES
    ]
    return rows.select(*keep, *features)


def parse_labelled(lines: DataFrame, *keep: str) -> DataFrame:
    """Flowers with their class: label code and four features."""
    rows = _fields(lines, 6)
    label = class_code(_field(FLOWER_COLUMNS.index("Species")))
    return rows.select(*keep, label.alias("label"), *_flower_features())


def parse_unlabelled(lines: DataFrame, *keep: str) -> DataFrame:
    """Flowers to score: four features; the class may be absent and is ignored."""
    return _fields(lines, 5).select(*keep, *_flower_features())


def parse_ratings(lines: DataFrame, *keep: str) -> DataFrame:
    """Ratings without header, exactly three fields: user, item, rating."""
    rows = _fields(lines, 3, exactly=True)
    return rows.select(
        *keep,
        _whole(_field(0), "user").alias("user"),
        _whole(_field(1), "item").alias("item"),
        number(_field(2), "rating").alias("rating"),
    )


def parse_pairs(lines: DataFrame, *keep: str) -> DataFrame:
    """(user, item) pairs to score: two fields, or more that are ignored."""
    rows = _fields(lines, 2)
    return rows.select(
        *keep, _whole(_field(0), "user").alias("user"), _whole(_field(1), "item").alias("item")
    )


def parse_matrix(lines: DataFrame, width: int | None = None, *keep: str) -> DataFrame:
    """Numbers separated by one blank, as an array column ``x``.

    All rows must have ``width`` numbers; without it the first line tells.
    """
    if width is None:
        first = lines.first()
        if first is None:
            raise ValueError("no rows: the input is empty")
        width = len(first.value.split(" "))
    fields = F.split("value", " ", -1)
    rows = lines.select(*keep, "value", fields.alias("__fields"))
    bad = _raise(F.concat(F.lit(f"not {width} numbers: "), F.col("value"))).cast("array<string>")
    rows = rows.withColumn("__fields", F.when(F.size("__fields") == width, F.col("__fields")).otherwise(bad))
    # Position by position the numbers are read in generated code.
    return rows.select(*keep, F.array(*[number(_field(i)) for i in range(width)]).alias("x"))


def matrix_columns(matrix: DataFrame, width: int, prefix: str = "c", keep: tuple[str, ...] = ()) -> DataFrame:
    """One double column per position of the array ``x``."""
    return matrix.select(*keep, *[F.col("x")[i].alias(f"{prefix}{i}") for i in range(width)])


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    return parse_activity(drop_header(read_lines(spark, path)))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    return parse_labelled(drop_header(read_lines(spark, path)))


def read_unlabelled(spark: SparkSession, path: str, *keep: str) -> DataFrame:
    return parse_unlabelled(drop_header(read_lines(spark, path)), *keep)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return parse_ratings(read_lines(spark, path))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return parse_pairs(read_lines(spark, path))


def read_matrix(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    return parse_matrix(read_lines(spark, path), width)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_id, value): every line with its number, from 0, over all files in order of their paths.

    Lines are counted per block of a file that a task reads, and the counts of the blocks before
    are added, so the numbers are the same however the files are split. Text is read twice and
    moved at most once; a row per block is sorted.
    """
    text = spark.read.text(path)
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    rows = text.select("value", *block, F.monotonically_increasing_id().alias("place"))
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    before = "sum(n) over (order by file, block rows between unbounded preceding and current row) - n"
    starts = stage(counts.selectExpr("file", "block", f"{before} - least as shift"), "line-starts")
    return rows.join(starts, ["file", "block"]).select((F.col("place") + F.col("shift")).alias("line_id"), "value")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text), one document per line; ``doc_id`` is the number of the line."""
    return numbered_lines(spark, path).withColumnsRenamed({"line_id": "doc_id", "value": "text"}).select("doc_id", "text")


def _fields(lines: DataFrame, n: int, exactly: bool = False) -> DataFrame:
    """Split lines at commas and insist on the number of fields."""
    rows = lines.withColumn("__fields", F.split("value", ",", -1))
    count = F.size("__fields")
    enough = count == n if exactly else count >= n
    missing = _raise(F.concat(F.lit(f"not {n} fields: "), F.col("value"))).cast("array<string>")
    return rows.withColumn("__fields", F.when(enough, F.col("__fields")).otherwise(missing))


def _field(i: int) -> Column:
    return F.get(F.col("__fields"), F.lit(i))


def _flower_features() -> list[Column]:
    return [number(_field(FLOWER_COLUMNS.index(f)), f).alias(f) for f in FLOWER_FEATURES]


def _whole(text: Column, what: str) -> Column:
    bad = _raise(F.concat(F.lit(f"bad {what}: "), F.coalesce(text, F.lit("NULL"))))
    return F.coalesce(text.try_cast("int"), bad.cast("int"))


def _raise(message: Column) -> Column:
    return F.raise_error(message)
