"""The six analyses from text file to saved result, one function per action.

Each reads its files, runs the operators, writes what it computed and returns a
report of DataFrames. Results keep what the caller needs to use them: scored rows
keep the line they came from. Samples in a report are read back from what was written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.operators import als, kmeans, naive_bayes, pca, sampling, summary, tfidf
from orelode.operators.partitions import persisted
from orelode.sources import lines, storage

SAMPLE_ROWS = 100


@dataclass(frozen=True)
class KMeansReport:
    model: kmeans.KMeansModel
    patterns: DataFrame
    info: DataFrame
    centers: DataFrame


def run_kmeans(
    spark: SparkSession,
    in_path: str,
    model_path: str,
    k: int,
    max_iter: int = 20,
    metrics: Sequence[str] = kmeans.PATTERN_METRICS,
    seed: int | None = None,
    **settings,
) -> KMeansReport:
    """Cluster phone activity, save the centres, report the patterns."""
    text = lines.drop_header(lines.read_lines(spark, in_path))
    with persisted(lines.parse_activity(text, "value")) as rows:
        # The line is the key of the draws; lines that are repeated more than now and
        # then identify no row, and then the draws depend on the partitions.
        whole, distinct = rows.agg(F.count("*"), F.approx_count_distinct("value")).first()
        key = ["value"] if distinct >= 0.9 * whole else None
        run = kmeans.train(rows, list(lines.ACTIVITY_FEATURES), k, max_iter, seed=seed, key=key, **settings)
    storage.save_kmeans(spark, run.model, model_path)
    model = storage.load_kmeans(spark, model_path)
    return KMeansReport(model, run.patterns(spark, metrics), run.info(spark), model.centers_frame(spark))


@dataclass(frozen=True)
class NaiveBayesReport:
    model: naive_bayes.NaiveBayesModel
    labels: DataFrame
    accuracy: DataFrame


def train_naive_bayes(
    spark: SparkSession, in_path: str, model_path: str, train_share: float, seed: int = 0
) -> NaiveBayesReport:
    """Split labelled flowers, train, save the model, report the accuracy on the rest."""
    flowers = lines.parse_labelled(lines.drop_header(lines.read_lines(spark, in_path)), "value")
    # The line itself is the key of the split, so equal lines always are on one side.
    training, test = sampling.split_train_test(flowers, train_share, ["value"], seed)
    model = naive_bayes.train(training, "label", list(lines.FLOWER_FEATURES))
    storage.save_naive_bayes(spark, model, model_path)
    accuracy = naive_bayes.accuracy(model.predict(test), "label")
    return NaiveBayesReport(model, model.labels_frame(spark), accuracy)


def predict_naive_bayes(
    spark: SparkSession, in_path: str, model_path: str, out_path: str, fmt: str = "parquet"
) -> DataFrame:
    """Score flowers with a saved model; returns the 100 smallest predictions."""
    model = storage.load_naive_bayes(spark, model_path)
    flowers = lines.read_unlabelled(spark, in_path, "value")
    storage.write_result(model.predict(flowers).select("value", "prediction"), out_path, fmt)
    return _written(spark, out_path, fmt, ["value", "prediction"]).select("prediction").orderBy("prediction").limit(SAMPLE_ROWS)


@dataclass(frozen=True)
class PcaReport:
    model: pca.PcaModel
    components: DataFrame
    sample: DataFrame


def run_pca(spark: SparkSession, in_path: str, out_path: str, k: int, fmt: str = "parquet") -> PcaReport:
    """Top ``k`` components of a number matrix; writes each line with its projection."""
    text = lines.read_lines(spark, in_path)
    with persisted(lines.parse_matrix(text, None, "value")) as matrix:
        model = pca.fit(matrix, "x", k)
        storage.write_result(model.project(matrix).drop("x"), out_path, fmt)
    columns = ["value", *[f"pc{c}" for c in range(k)]]
    sample = _written(spark, out_path, fmt, columns).orderBy("value").limit(SAMPLE_ROWS)
    return PcaReport(model, model.components_frame(spark), sample)


def run_statistics(
    spark: SparkSession,
    in_path: str,
    out_path: str | None = None,
    metrics: Sequence[str] = summary.METRICS,
    fmt: str = "parquet",
) -> DataFrame:
    """Column statistics of a number matrix, written if a path is given."""
    report = summary.column_summary(lines.read_matrix(spark, in_path), "x", metrics)
    if out_path is not None:
        storage.write_result(report, out_path, fmt)
    return report


def run_tfidf(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    buckets: int = 0,
    min_doc_freq: int = 0,
    fmt: str = "parquet",
) -> DataFrame:
    """Hashed TF-IDF of a file of documents; ``buckets = 0`` is the default number.

    Term frequencies are staged once: document numbers then stay the same in every
    later step, and text is read and hashed a single time.
    """
    docs = lines.read_documents(spark, in_path)
    tf = storage.stage(tfidf.hashed_term_frequency(docs, buckets, strip_trailing=True), "tf")
    model = tfidf.fit_idf(tf, docs.count(), min_doc_freq, "bucket")
    try:
        storage.write_result(model.transform(tf), out_path, fmt)
    finally:
        model.release()
        storage.discard(tf)
    columns = ["doc_id", "bucket", "tf", "weight"]
    numbers = [F.col(c).cast(t).alias(c) for c, t in zip(columns, ("bigint", "int", "bigint", "double"))]
    return _written(spark, out_path, fmt, columns).select(*numbers).orderBy("doc_id", "bucket").limit(SAMPLE_ROWS)


def train_als(
    spark: SparkSession, in_path: str, model_path: str, rank: int, iterations: int, seed: int | None = None
) -> ALSModel:
    """Train on a ratings file and save the model."""
    with persisted(lines.read_ratings(spark, in_path)) as ratings:
        model = als.train(ratings, rank, iterations, seed)
    storage.save_als(model, model_path)
    return model


def predict_als(
    spark: SparkSession, in_path: str, model_path: str, out_path: str, fmt: str = "parquet"
) -> DataFrame:
    """Score a file of pairs with a saved model; returns the 100 smallest triples."""
    predictions = als.predict(storage.load_als(model_path), lines.read_pairs(spark, in_path))
    storage.write_result(predictions, out_path, fmt)
    written = _written(spark, out_path, fmt, ["user", "item", "prediction"])
    numbers = written.selectExpr("cast(user as int) user", "cast(item as int) item", "cast(prediction as float) prediction")
    return als.top_predictions(numbers, SAMPLE_ROWS)


def _written(spark: SparkSession, path: str, fmt: str, columns: list[str]) -> DataFrame:
    """A result as it was written; text lines are split at their last commas."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.json(path)
    if fmt == "csv":
        return spark.read.csv(path).toDF(*columns)
    inner = F.regexp_replace("value", r"^\(|\)$", "")
    pattern = "^(.*)" + ",([^,]*)" * (len(columns) - 1) + "$"
    cells = [F.regexp_extract(inner, pattern, i + 1).alias(c) for i, c in enumerate(columns)]
    return spark.read.text(path).select(*cells)

