"""Where results and models go.

Writers fail on an existing path. Intermediate tables are in ``staging``.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.operators.kmeans import KMeansModel
from orelode.operators.naive_bayes import NaiveBayesModel
from orelode.operators.pca import PcaModel
from orelode.sources.staging import discard, stage, work_path  # noqa: F401 - part of this module's interface

FORMATS = ("parquet", "csv", "json", "text")


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a result as part files; an existing path is an error.

    ``text`` writes each row as ``(a,b,c)``, one line per row.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; choose from {FORMATS}")
    writer = df
    if fmt == "text":
        cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in df.columns]
        line = F.concat_ws(",", *cells)
        if len(cells) > 1:
            line = F.concat(F.lit("("), line, F.lit(")"))
        writer = df.select(line.alias("value"))
    writer.write.mode("errorifexists").format(fmt).save(path)


def save_kmeans(spark: SparkSession, model: KMeansModel, path: str) -> None:
    array_column = model.features if isinstance(model.features, str) else None
    rows = [
        (j, pos, attribute, float(v), array_column)
        for j, center in enumerate(model.centers)
        for pos, (attribute, v) in enumerate(zip(model.attributes, center, strict=True))
    ]
    schema = "cluster int, position int, attribute string, center double, array_column string"
    _save(spark, rows, schema, path)


def load_kmeans(spark: SparkSession, path: str) -> KMeansModel:
    rows = spark.read.parquet(path).orderBy("cluster", "position").collect()
    centers: list[list[float]] = []
    for r in rows:
        if r.position == 0:
            centers.append([])
        centers[r.cluster].append(r.center)
    features = rows[0].array_column or [r.attribute for r in rows if r.cluster == 0]
    return KMeansModel(features, centers)


def save_naive_bayes(spark: SparkSession, model: NaiveBayesModel, path: str) -> None:
    # ``repr`` keeps every bit of a numeric label.
    rows = [
        (c, label if isinstance(label, str) else repr(label), model.label_type, pi, pos, f, t)
        for c, (label, pi, row) in enumerate(zip(model.labels, model.pi, model.theta, strict=True))
        for pos, (f, t) in enumerate(zip(model.features, row, strict=True))
    ]
    schema = "class int, label string, label_type string, pi double, position int, attribute string, theta double"
    _save(spark, rows, schema, path)


def load_naive_bayes(spark: SparkSession, path: str) -> NaiveBayesModel:
    rows = spark.read.parquet(path).orderBy("class", "position").collect()
    label_type = rows[0].label_type
    heads = [r for r in rows if r.position == 0]
    if label_type == "string":
        labels = [r.label for r in heads]
    else:
        parse = float if label_type in ("double", "float") else int
        labels = [parse(r.label) for r in heads]
    theta = [[r.theta for r in rows if r["class"] == h["class"]] for h in heads]
    features = [r.attribute for r in rows if r["class"] == heads[0]["class"]]
    return NaiveBayesModel(features, labels, [h.pi for h in heads], theta, label_type)


def save_pca(spark: SparkSession, model: PcaModel, path: str) -> None:
    array_column = model.features if isinstance(model.features, str) else None
    rows = [
        (c, explained, pos, attribute, loading, array_column)
        for c, (row, explained) in enumerate(zip(model.loadings, model.explained, strict=True))
        for pos, (attribute, loading) in enumerate(zip(model.attributes, row, strict=True))
    ]
    schema = (
        "component int, explained double, position int, attribute string, loading double, array_column string"
    )
    _save(spark, rows, schema, path)


def load_pca(spark: SparkSession, path: str) -> PcaModel:
    rows = spark.read.parquet(path).orderBy("component", "position").collect()
    heads = [r for r in rows if r.position == 0]
    loadings = [[r.loading for r in rows if r.component == h.component] for h in heads]
    attributes = [r.attribute for r in rows if r.component == 0]
    features = rows[0].array_column or attributes
    return PcaModel(features, attributes, loadings, [h.explained for h in heads])


def save_als(model: ALSModel, path: str) -> None:
    model.write().save(path)


def load_als(path: str) -> ALSModel:
    return ALSModel.load(path)


def _save(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    """A model is a small table: one part file."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(path)
