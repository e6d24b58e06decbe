"""The tables seen as the inputs of the operators: features, lines, ratings, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.operators.partitions import spread

SEED = 7

# Columns that identify a lineitem row.
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty_key"]
F4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Naive Bayes needs numbers of similar size that are not negative.
SCALED = ["quantity", "price_k", "discount_pct", "tax_pct"]
EMBEDDING = "embedding"

# Start centres within the range of F4; no row is near the last of STEP_CENTERS.
CENTERS = [
    [10.0, 10000.0, 0.02, 0.02],
    [25.0, 40000.0, 0.05, 0.04],
    [40.0, 70000.0, 0.08, 0.06],
    [49.0, 95000.0, 0.1, 0.08],
]
STEP_CENTERS = [*CENTERS[:3], [1e6, 1e9, 100.0, 100.0]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    """Row key and the four numbers."""
    items = table(spark, folder, "lineitem")
    return items.select(*KEY[:4], F.col("l_quantity").cast("bigint").alias("qty_key"), *F4)


def scaled_items(spark: SparkSession, folder: str) -> DataFrame:
    """Row key, label and the four numbers scaled."""
    return table(spark, folder, "lineitem").select(
        *KEY[:4],
        F.col("l_quantity").cast("bigint").alias("qty_key"),
        F.col("l_returnflag").alias("label"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("price_k"),
        (F.col("l_discount") * F.lit(100.0)).alias("discount_pct"),
        (F.col("l_tax") * F.lit(100.0)).alias("tax_pct"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", EMBEDDING)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts. Splitting and counting words costs more than moving the texts."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """(user, item, rating): how much of a part each customer ordered.

    Both inputs are pruned to two or three columns before the join on the order.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(
        F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item")
    ).agg(F.sum("l_quantity").alias("rating"))


def activity_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as phone-activity lines; some fields are empty."""
    e = table(spark, folder, "events")
    value = F.col("value").cast("string")
    fields = [
        F.lit("2013-11-01 00:00:00"),
        F.col("user_id").cast("string"),
        F.lit("39"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(value),
        F.when(F.col("event_type") == "view", value).otherwise(F.lit("")),
        value,
        F.col("user_id").cast("string"),
        F.lit(""),
    ]
    return e.select("event_id", F.concat_ws(",", *fields).alias("value"))


def flower_lines(spark: SparkSession, folder: str, with_class: bool = True) -> DataFrame:
    """Events written as flower lines; event types stand for the classes."""
    e = table(spark, folder, "events")
    value = F.col("value").cast("string")
    user = F.col("user_id").cast("string")
    fields = [F.col("event_id").cast("string"), value, user, F.lit("1.5"), value]
    if with_class:
        fields.append(flower_name())
    return e.select("event_id", F.concat_ws(",", *fields).alias("value"))


def flower_name():
    return (
        F.when(F.col("event_type") == "click", F.lit("Iris-setosa"))
        .when(F.col("event_type") == "view", F.lit("Iris-versicolor"))
        .otherwise(F.col("event_type"))
    )


def rating_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items written as rating lines."""
    items = line_items(spark, folder)
    text = F.concat_ws(",", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_quantity").cast("string"))
    return items.select(*KEY, text.alias("value"))


def matrix_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The four numbers of a line item written with blanks between them."""
    text = F.concat_ws(" ", *[F.col(f).cast("string") for f in F4])
    return line_items(spark, folder).select(*KEY, text.alias("value"))
