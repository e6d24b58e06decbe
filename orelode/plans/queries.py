"""Queries over the tables, one or more per operator: name -> (spark, folder) -> DataFrame.

Every query reads its whole tables. Values that depend on the order in which numbers
are added are rounded, as the SQL they are compared with adds in another order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.sparse import distance_sparse, dot_sparse, norm_sparse, scaled
from orelode.functions.text import class_code, number_or_zero
from orelode.functions.vectors import l2_norm, sq_distance
from orelode.operators import (
    als,
    als_rows,
    kmeans,
    kmeans_start,
    naive_bayes,
    naive_bayes_terms,
    pca,
    sampling,
    sparse_rows,
    summary,
    tfidf,
)
from orelode.operators.partitions import persisted, spread
from orelode.plans.inputs import (
    CENTERS,
    EMBEDDING,
    F4,
    KEY,
    SCALED,
    SEED,
    STEP_CENTERS,
    activity_lines,
    documents,
    embeddings,
    flower_lines,
    flower_name,
    line_items,
    matrix_lines,
    rating_lines,
    ratings,
    scaled_items,
    table,
)
from orelode.plans import jobs
from orelode.sources import lines, staging, storage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HEADER = "event_type,value"
PASSES = 3
TRAIN_SHARE = 0.7
MIN_DOC_FREQ = 2
BUCKETS = 1000
ALS_RANK = 5
ALS_ITERATIONS = 5


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_")] = function
    return function


def rounded(column: str, places: int) -> Column:
    return F.round(column, places).alias(column)


# Parsing ------------------------------------------------------------------------


@query
def parse_activity(spark, folder):
    return lines.parse_activity(activity_lines(spark, folder), "event_id")


@query
def parse_labelled(spark, folder):
    return lines.parse_labelled(flower_lines(spark, folder), "event_id")


@query
def parse_unlabelled(spark, folder):
    return lines.parse_unlabelled(flower_lines(spark, folder, with_class=False), "event_id")


@query
def parse_ratings(spark, folder):
    return lines.parse_ratings(rating_lines(spark, folder), *KEY)


@query
def parse_matrix(spark, folder):
    matrix = lines.parse_matrix(matrix_lines(spark, folder), len(F4), *KEY)
    return lines.matrix_columns(matrix, len(F4), keep=tuple(KEY))


@query
def parse_double_or_zero(spark, folder):
    raw = F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("value").cast("string"))
    return table(spark, folder, "events").select("event_id", number_or_zero(raw).alias("number"))


@query
def label_encode(spark, folder):
    return table(spark, folder, "events").select("event_id", class_code(flower_name()).alias("label"))


@query
def drop_header(spark, folder):
    """A header put before the lines goes; lines that also start with ``e`` stay."""
    text = F.concat_ws(",", "event_type", F.col("event_id").cast("string")).alias("value")
    body = table(spark, folder, "events").select(text)
    header = body.limit(1).select(F.lit(HEADER).alias("value"))
    return lines.drop_header(header.unionByName(body), HEADER)


# Column statistics ---------------------------------------------------------------


@query
def col_summary(spark, folder):
    return _rounded_summary(summary.column_summary(line_items(spark, folder), F4))


@query
def col_summary_wide(spark, folder):
    """More columns than one generated aggregate takes: the numbers shifted by 0 to 17."""
    shifted = [(F.col(F4[c % 4]) + F.lit(float(c))).alias(f"c{c}") for c in range(18)]
    return _rounded_summary(summary.column_summary(line_items(spark, folder).select(*shifted), [f"c{c}" for c in range(18)]))


@query
def col_summary_selected(spark, folder):
    report = summary.column_summary(line_items(spark, folder), F4, ("n", "mean", "max"))
    return report.select("attribute", "n", rounded("mean", 6), "max")


@query
def col_summary_array(spark, folder):
    return _rounded_summary(summary.column_summary(embeddings(spark, folder), EMBEDDING))


@query
def col_summary_matrix(spark, folder):
    """Statistics of a number matrix that comes as text."""
    matrix = lines.parse_matrix(matrix_lines(spark, folder), len(F4))
    return _rounded_summary(summary.column_summary(matrix, "x"))


def _rounded_summary(report: DataFrame) -> DataFrame:
    # Prices have variances near 1e9: significant digits, not places.
    scale = F.when(F.col("variance") > 1e6, F.round("variance", 0)).otherwise(F.round("variance", 8))
    return report.select("attribute", "n", rounded("mean", 6), "min", "max", scale.alias("variance"))


# Vectors and samples ----------------------------------------------------------------


@query
def row_l2_norm(spark, folder):
    return embeddings(spark, folder).select("vec_id", F.round(l2_norm(EMBEDDING), 8).alias("norm"))


@query
def row_l2_norm_columns(spark, folder):
    return scaled_items(spark, folder).select(*KEY, F.round(l2_norm(SCALED), 8).alias("norm"))


@query
def sq_distance_array(spark, folder):
    distance = sq_distance(EMBEDDING, [i / 64 for i in range(64)])
    return embeddings(spark, folder).select("vec_id", F.round(distance, 8).alias("sq_distance"))


@query
def split_train_test(spark, folder):
    return sampling.with_split_flag(line_items(spark, folder).select(*KEY), TRAIN_SHARE, KEY, SEED)


@query
def split_train_test_sizes(spark, folder):
    """Both sides of the split, which together are the whole table."""
    train, test = sampling.split_train_test(line_items(spark, folder).select(*KEY), TRAIN_SHARE, KEY, SEED)
    sides = train.select(F.lit("train").alias("side")).unionByName(test.select(F.lit("test").alias("side")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query
def take_sample(spark, folder):
    return sampling.take_sample(line_items(spark, folder), 50, KEY, SEED)


@query
def take_sample_half(spark, folder):
    """Half of the line items, as one draw that no task sorts."""
    items = line_items(spark, folder).select(*KEY)
    return sampling.take_many(items, items.count() // 2, KEY, SEED)


# K-Means ---------------------------------------------------------------------------


def first_centers(items: DataFrame, k: int = 4) -> kmeans.Centers:
    """The rows with the smallest keys as start centres."""
    rows = items.orderBy(*KEY).limit(k).select(*F4).collect()
    return [[float(v) for v in r] for r in rows]


def first_embeddings(vectors: DataFrame, k: int = 4) -> kmeans.Centers:
    rows = vectors.orderBy("vec_id").limit(k).collect()
    return [[float(v) for v in r[EMBEDDING]] for r in rows]


def _lloyd(spark: SparkSession, folder: str, passes: int = PASSES) -> kmeans.KMeansRun:
    items = line_items(spark, folder)
    return kmeans.lloyd(items, F4, first_centers(items), max_iter=passes)


def _rounded_patterns(patterns: DataFrame) -> DataFrame:
    return patterns.select("cluster", "attribute", "n", rounded("mean", 5), "min", "max", rounded("stddev", 5))


@query
def kmeans_assign(spark, folder):
    found = kmeans.assign(line_items(spark, folder), F4, CENTERS)
    return found.select(*KEY, "cluster", rounded("sq_distance", 4))


@query
def kmeans_assign_array(spark, folder):
    vectors = embeddings(spark, folder)
    found = kmeans.assign(vectors, EMBEDDING, first_embeddings(vectors))
    return found.select("vec_id", "cluster", rounded("sq_distance", 8))


@query
def kmeans_cost_per_row(spark, folder):
    costed = kmeans_start.with_cost(line_items(spark, folder), F4, CENTERS[:2])
    costed = kmeans_start.with_cost(costed, F4, CENTERS[2:])
    return costed.select(*KEY, rounded("cost", 4))


@query
def kmeans_cost(spark, folder):
    cost = kmeans.total_cost(scaled_items(spark, folder), SCALED, _scaled_centers())
    return cost.select(rounded("cost", 2))


def _scaled_centers() -> kmeans.Centers:
    return [[q, p / 1000.0, d * 100.0, t * 100.0] for q, p, d, t in CENTERS]


@query
def kmeans_step(spark, folder):
    after = kmeans.step(line_items(spark, folder), F4, STEP_CENTERS)
    moved = F.round(F.col("moved_sq") / 1e6, 5).alias("moved_sq_m")
    return after.select("cluster", "attribute", "n", rounded("center", 5), moved)


@query
def kmeans_lloyd(spark, folder):
    return _lloyd(spark, folder).model.centers_frame(spark).select("cluster", "attribute", rounded("center", 5))


@query
def kmeans_centers(spark, folder):
    """Centres after one pass over the embeddings."""
    vectors = embeddings(spark, folder)
    run = kmeans.lloyd(vectors, EMBEDDING, first_embeddings(vectors), max_iter=1)
    return run.model.centers_frame(spark).select("cluster", "attribute", rounded("center", 7))


@query
def kmeans_patterns(spark, folder):
    return _rounded_patterns(_lloyd(spark, folder).patterns(spark))


@query
def kmeans_patterns_selected(spark, folder):
    patterns = _lloyd(spark, folder).patterns(spark, ("n", "mean", "max"))
    return patterns.select("cluster", "attribute", "n", rounded("mean", 5), "max")


@query
def kmeans_patterns_array(spark, folder):
    vectors = embeddings(spark, folder)
    patterns = kmeans.patterns(vectors, EMBEDDING, first_embeddings(vectors))
    return patterns.select(
        "cluster", "attribute", "n", rounded("mean", 7), rounded("min", 7), rounded("max", 7), rounded("stddev", 7)
    )


@query
def kmeans_patterns_empty(spark, folder):
    """One pass with a centre no row is close to: n = 0 and no statistics."""
    return _rounded_patterns(kmeans.patterns(line_items(spark, folder), F4, STEP_CENTERS))


@query
def kmeans_resumed(spark, folder):
    """Patterns of a run that was stopped after its first pass and gone on with."""
    items, log = line_items(spark, folder), storage.work_path(spark, "kmeans-log")
    kmeans.lloyd(items, F4, first_centers(items), max_iter=1, log=log)
    run = kmeans.lloyd(items, F4, first_centers(items), max_iter=PASSES, log=log)
    return _rounded_patterns(run.patterns(spark))


@query
def kmeans_converged(spark, folder):
    """How far each centre moved in the last of the passes, and whether that is a stop."""
    run = _lloyd(spark, folder)
    rows = [(j, float(m), m <= 1e-4 * 1e-4) for j, m in enumerate(run.moves)]
    moved = spark.createDataFrame(rows, "cluster int, moved_sq double, stopped boolean")
    return moved.select("cluster", rounded("moved_sq", 2), "stopped")


@query
def kmeans_run_info(spark, folder):
    info = _lloyd(spark, folder).info(spark)
    return info.select("iterations", "converged", F.round(F.col("cost") / 1e9, 4).alias("cost_bn"))


@query
def kmeans_init_random(spark, folder):
    return kmeans_start.random_rows(line_items(spark, folder), F4, 4, SEED, KEY)


@query
def kmeans_parallel_round(spark, folder):
    items = line_items(spark, folder)
    costed = kmeans_start.with_cost(items, F4, kmeans_start.first_center(items, F4, SEED, KEY))
    chosen = kmeans_start.parallel_round(costed, 4, SEED, 0, KEY)
    return chosen.select(*KEY, *F4, rounded("cost", 4))


@query
def kmeans_candidate_weights(spark, folder):
    """Candidates after one round, and how many rows each attracts."""
    items = line_items(spark, folder)
    candidates = kmeans_start.parallel_candidates(items, F4, 4, 1, SEED, KEY)
    weights = kmeans_start.candidate_weights(items, F4, candidates)
    rows = [(j, *c) for j, c in enumerate(candidates)]
    points = spark.createDataFrame(rows, "candidate int, " + ", ".join(f"{f} double" for f in F4))
    return weights.join(F.broadcast(points), "candidate").select("candidate", *F4, "n")


@query
def kmeans_reduce_candidates(spark, folder):
    items = line_items(spark, folder)
    start = kmeans_start.parallel_start(items, F4, 4, 2, SEED, KEY)
    return kmeans.KMeansModel(F4, start).centers_frame(spark).select("cluster", "attribute", rounded("center", 5))


@query
def kmeans_train(spark, folder):
    # Some twenty passes over six narrow columns.
    with persisted(spread(line_items(spark, folder))) as items:
        run = kmeans.train(items, F4, 4, 10, seed=SEED, key=KEY)
    return _rounded_patterns(run.patterns(spark))


@query
def kmeans_train_check(spark, folder):
    """A trained model's clusters hold every row once, and their means are its centres."""
    run = kmeans.train(line_items(spark, folder), F4, 4, 10, init_mode=kmeans.RANDOM, seed=SEED, key=KEY)
    both = run.patterns(spark).join(run.model.centers_frame(spark), ["cluster", "attribute"])
    return both.groupBy("attribute").agg(
        F.sum("n").alias("n"), F.max(F.abs(F.col("mean") - F.col("center"))).alias("largest_difference")
    )


@query
def kmeans_model_roundtrip(spark, folder):
    """Rows that a saved and loaded model assigns differently: none."""
    items = line_items(spark, folder)
    model = kmeans.lloyd(items, F4, first_centers(items), max_iter=2).model
    path = storage.work_path(spark, "kmeans")
    storage.save_kmeans(spark, model, path)
    loaded = storage.load_kmeans(spark, path)
    both = kmeans.assign(model.assign(items), F4, loaded.centers, "cluster_2", "sq_distance_2")
    same = (F.col("cluster") == F.col("cluster_2")) & (F.col("sq_distance") == F.col("sq_distance_2"))
    return _differing(both, same)


def _differing(rows: DataFrame, same: Column) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("differing"))


# Naive Bayes -----------------------------------------------------------------------


def _nb_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return sampling.split_train_test(scaled_items(spark, folder), TRAIN_SHARE, KEY, SEED)


def _nb_model(training: DataFrame) -> naive_bayes.NaiveBayesModel:
    return naive_bayes.train(training, "label", SCALED)


@query
def nb_class_sums(spark, folder):
    sums = naive_bayes.class_sums(scaled_items(spark, folder), "label", SCALED)
    return sums.select("label", "n", *[rounded(f, 3) for f in SCALED])


@query
def nb_train(spark, folder):
    model = _nb_model(_nb_split(spark, folder)[0])
    both = model.theta_frame(spark).join(model.priors_frame(spark), "label")
    return both.select("label", "attribute", rounded("pi", 10), rounded("theta", 10))


@query
def nb_labels(spark, folder):
    return _nb_model(_nb_split(spark, folder)[0]).labels_frame(spark)


@query
def nb_predict(spark, folder):
    training, test = _nb_split(spark, folder)
    return _nb_model(training).predict(test).select(*KEY, "label", "prediction")


@query
def nb_accuracy(spark, folder):
    training, test = _nb_split(spark, folder)
    result = naive_bayes.accuracy(_nb_model(training).predict(test), "label")
    return result.select("n", "correct", rounded("accuracy", 10))


@query
def nb_top100(spark, folder):
    training, test = _nb_split(spark, folder)
    scored = _nb_model(training).predict(test).select("prediction", *KEY)
    return scored.orderBy("prediction", *KEY).limit(100)


@query
def nb_model_roundtrip(spark, folder):
    training, test = _nb_split(spark, folder)
    model = _nb_model(training)
    path = storage.work_path(spark, "naive-bayes")
    storage.save_naive_bayes(spark, model, path)
    both = storage.load_naive_bayes(spark, path).predict(model.predict(test), "prediction_2")
    return _differing(both, F.col("prediction") == F.col("prediction_2"))


def _nb_texts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = spread(table(spark, folder, "documents").select("doc_id", "lang", "text"), "doc_id").where("lang is not null")
    return sampling.split_train_test(docs, TRAIN_SHARE, ["doc_id"], SEED)


@query
def nb_text_train(spark, folder):
    """Parameters of the languages' terms."""
    model = naive_bayes_terms.train(_nb_texts(spark, folder)[0], "lang")
    return model.parameters().select("label", "term", rounded("pi", 10), rounded("theta", 10))


@query
def nb_text_predict(spark, folder):
    training, test = _nb_texts(spark, folder)
    return naive_bayes_terms.train(training, "lang").predict(test)


@query
def nb_text_hashed_predict(spark, folder):
    """The same over hash buckets."""
    training, test = _nb_texts(spark, folder)
    return naive_bayes_terms.train(training, "lang", buckets=BUCKETS).predict(test)


# Principal components -----------------------------------------------------------------


@query
def pca_covariance(spark, folder):
    cells = pca.covariance(scaled_items(spark, folder), SCALED)
    return cells.select("attribute_a", "attribute_b", rounded("cov", 6))


@query
def pca_covariance_array(spark, folder):
    cells = pca.covariance(embeddings(spark, folder), EMBEDDING)
    return cells.select("attribute_a", "attribute_b", rounded("cov", 9))


@query
def pca_components(spark, folder):
    found = pca.fit(scaled_items(spark, folder), SCALED, 3).components_frame(spark)
    return found.select("component", "attribute", rounded("loading", 6))


@query
def pca_components_array(spark, folder):
    return pca.fit(embeddings(spark, folder), EMBEDDING, 5).components_frame(spark)


@query
def pca_project(spark, folder):
    items = scaled_items(spark, folder)
    projected = pca.fit(items, SCALED, 2).project(items)
    return projected.select(*KEY, rounded("pc0", 4), rounded("pc1", 4))


@query
def pca_project_array(spark, folder):
    vectors = embeddings(spark, folder)
    return pca.fit(vectors, EMBEDDING, 2).project(vectors).drop(EMBEDDING)


@query
def pca_sample100(spark, folder):
    return pca_project(spark, folder).orderBy(*KEY).limit(100)


@query
def pca_eigen_residual(spark, folder):
    """How far covariance . loadings is from share * total variance * loadings, per component: nowhere."""
    vectors = embeddings(spark, folder)
    model = pca.fit(vectors, EMBEDDING, 5)
    upper = pca.covariance(vectors, EMBEDDING)
    lower = upper.where("attribute_a <> attribute_b").selectExpr("attribute_b", "attribute_a", "cov")
    both = upper.union(lower)
    total = upper.where("attribute_a = attribute_b").agg(F.sum("cov").alias("total"))
    v = model.components_frame(spark)
    product = both.join(v.withColumnRenamed("attribute", "attribute_b"), "attribute_b")
    product = product.groupBy("component", F.col("attribute_a").alias("attribute")).agg(F.sum(F.expr("cov * loading")).alias("cv"))
    scaled = v.join(model.explained_frame(spark), "component").join(product, ["component", "attribute"]).crossJoin(total)
    residual = F.max(F.abs(F.col("cv") - F.col("explained") * F.col("total") * F.col("loading")))
    length = F.sum(F.col("loading") * F.col("loading"))
    return scaled.groupBy("component").agg(F.round(residual, 6).alias("residual"), F.round(length, 6).alias("length"))


@query
def pca_total_variance(spark, folder):
    """All components together carry the variance of all attributes."""
    items = scaled_items(spark, folder)
    projected = pca.fit(items, SCALED, len(SCALED)).project(items)
    whole = sum((F.var_samp(f"pc{c}") for c in range(1, len(SCALED))), F.var_samp("pc0"))
    return projected.agg(F.round(whole, 6).alias("variance"))


@query
def pca_rotation_norm(spark, folder):
    """All components together turn a row without changing its length."""
    items = scaled_items(spark, folder)
    projected = pca.fit(items, SCALED, len(SCALED)).project(items)
    norm = l2_norm([f"pc{c}" for c in range(len(SCALED))])
    return projected.select(*KEY, F.round(norm, 8).alias("norm"))


# TF-IDF ----------------------------------------------------------------------------


@query
def doc_tokens(spark, folder):
    return tfidf.tokens(documents(spark, folder))


@query
def doc_tokens_stripped(spark, folder):
    return tfidf.tokens(documents(spark, folder), strip_trailing=True)


@query
def tf(spark, folder):
    return tfidf.term_frequency(documents(spark, folder))


@query
def tf_hashed(spark, folder):
    return tfidf.hashed_term_frequency(documents(spark, folder), BUCKETS)


@query
def tf_hashed_default(spark, folder):
    return tfidf.hashed_term_frequency(documents(spark, folder), 0)


@query
def doc_freq(spark, folder):
    return tfidf.document_frequency(tfidf.term_frequency(documents(spark, folder)))


def _idf(spark: SparkSession, folder: str, min_doc_freq: int) -> DataFrame:
    docs = documents(spark, folder)
    table = tfidf.document_frequency(tfidf.term_frequency(docs))
    found = tfidf.inverse_document_frequency(table, docs.count(), min_doc_freq)
    return found.select("term", "df", rounded("idf", 10))


@query
def idf(spark, folder):
    return _idf(spark, folder, 0)


@query
def idf_min_doc_freq(spark, folder):
    return _idf(spark, folder, MIN_DOC_FREQ)


def _rounded_weights(weights: DataFrame) -> DataFrame:
    return weights.withColumn("weight", F.round("weight", 9))


@query
def tfidf_(spark, folder):
    return _rounded_weights(tfidf.tfidf(documents(spark, folder), MIN_DOC_FREQ))


@query
def tfidf_sample100(spark, folder):
    weights = _rounded_weights(tfidf.tfidf(documents(spark, folder), MIN_DOC_FREQ))
    return weights.orderBy("doc_id", "term").limit(100)


@query
def tfidf_hashed(spark, folder):
    return _rounded_weights(tfidf.tfidf(documents(spark, folder), MIN_DOC_FREQ, buckets=BUCKETS))


# Sparse vectors --------------------------------------------------------------------------


def _hashed_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's hashed terms next to those of the document with half its number."""
    own = tfidf.hashed_vectors(documents(spark, folder), BUCKETS)
    other = own.select(F.col("doc_id").alias("other_id"), F.col("features").alias("other"))
    return own.join(other, F.expr("doc_id div 2") == F.col("other_id"))


@query
def dot_sparse_(spark, folder):
    return _hashed_pairs(spark, folder).select("doc_id", "other_id", dot_sparse("features", "other").alias("dot"))


@query
def distance_sparse_(spark, folder):
    return _hashed_pairs(spark, folder).select("doc_id", "other_id", distance_sparse("features", "other").alias("sq_distance"))


@query
def norm_sparse_(spark, folder):
    vectors = tfidf.hashed_vectors(documents(spark, folder), BUCKETS)
    return vectors.select("doc_id", F.round(norm_sparse("features"), 8).alias("norm"))


@query
def col_summary_sparse(spark, folder):
    """Statistics of every hash bucket's term frequency over all documents, 0 where it has none."""
    report = sparse_rows.column_summary(tfidf.hashed_vectors(documents(spark, folder), BUCKETS), "features")
    return report.select("attribute", "n", rounded("mean", 8), "min", "max", rounded("variance", 6))


def _tfidf_clusters(spark: SparkSession, folder: str) -> tuple[DataFrame, sparse_rows.SparseKMeansRun]:
    """Hashed TF-IDF vectors, and K-Means from those of the four smallest ids."""
    vectors = tfidf.hashed_vectors(documents(spark, folder), BUCKETS)
    idf = tfidf.sparse_idf(vectors, min_doc_freq=MIN_DOC_FREQ)
    weights = vectors.select("doc_id", scaled("features", idf).alias("features"))
    first = weights.orderBy("doc_id").limit(4).collect()
    start = np.zeros((len(first), BUCKETS))
    for center, row in zip(start, first, strict=True):
        center[row.features["indices"]] = row.features["values"]
    return weights, sparse_rows.lloyd(weights, "features", start, PASSES)


@query
def kmeans_tfidf(spark, folder):
    """Patterns of documents clustered by their hashed TF-IDF."""
    weights, run = _tfidf_clusters(spark, folder)
    found = sparse_rows.patterns(weights, "features", run.model.centers)
    numbers = [rounded(c, 6) for c in ("mean", "min", "max", "stddev")]
    return found.select("cluster", "attribute", "n", *numbers)


@query
def kmeans_tfidf_assign(spark, folder):
    weights, run = _tfidf_clusters(spark, folder)
    return run.model.assign(weights).select("doc_id", "cluster", rounded("sq_distance", 4))


# From file to file ---------------------------------------------------------------------


def _file(lines_: DataFrame, header: str | None, what: str) -> str:
    """Write lines as text, every part after a header if there is one."""
    spark = lines_.sparkSession
    path = storage.work_path(spark, what)
    values = lines_.select("value")
    if header is not None:

        def headed(batches):
            yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
            for batch in batches:
                yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])

        # A part of the header alone, as a table without rows has no parts.
        alone = spark.createDataFrame([(header,)], "value string").coalesce(1)
        values = alone.unionByName(values.mapInArrow(headed, "value string"))
    storage.write_result(values, path, "text")
    return path


@query
def activity_file(spark, folder):
    """Column statistics of phone activity that was read from a file with a header."""
    path = _file(activity_lines(spark, folder), ",".join(lines.ACTIVITY_COLUMNS), "activity")
    report = summary.column_summary(lines.read_activity(spark, path), list(lines.ACTIVITY_FEATURES))
    return report.select("attribute", "n", rounded("mean", 6), "min", "max")


@query
def matrix_statistics_file(spark, folder):
    """The statistics job from a matrix file to its written report."""
    path, out = _file(matrix_lines(spark, folder), None, "matrix"), storage.work_path(spark, "statistics")
    jobs.run_statistics(spark, path, out)
    written = spark.read.parquet(out)
    return _rounded_summary(written)


@query
def nb_score_file(spark, folder):
    """A model trained on one file scores another, whose lines come back with their class code."""
    labelled = _file(flower_lines(spark, folder), ",".join(lines.FLOWER_COLUMNS), "labelled")
    unlabelled = _file(flower_lines(spark, folder, with_class=False), ",".join(lines.FLOWER_COLUMNS[:5]), "unlabelled")
    model, out = storage.work_path(spark, "naive-bayes"), storage.work_path(spark, "scored")
    jobs.train_naive_bayes(spark, labelled, model, 1.0, SEED)
    jobs.predict_naive_bayes(spark, unlabelled, model, out)
    return spark.read.parquet(out)


@query
def document_lines_file(spark, folder):
    """Documents read from a text file, with the numbers of their lines."""
    return lines.read_documents(spark, _document_file(spark, folder))


@query
def tfidf_file(spark, folder):
    """Hashed TF-IDF from a file of documents to its written result."""
    out = storage.work_path(spark, "tfidf")
    jobs.run_tfidf(spark, _document_file(spark, folder), out, BUCKETS, MIN_DOC_FREQ)
    return _rounded_weights(spark.read.parquet(out))


def _document_file(spark: SparkSession, folder: str) -> str:
    """A document per line, without line breaks and trailing blanks, in order of their ids."""
    text = F.rtrim(F.regexp_replace("text", "[\\r\\n]+", " "))
    return _file(table(spark, folder, "documents").orderBy("doc_id").select(text.alias("value")), None, "documents")


@query
def als_score_file(spark, folder):
    """Pairs of a file scored by a model that was trained on a file of ratings and saved."""
    path = _file(rating_lines(spark, folder), None, "ratings")
    model, out = storage.work_path(spark, "als"), storage.work_path(spark, "scored")
    jobs.train_als(spark, path, model, 2, 2, SEED)
    jobs.predict_als(spark, path, model, out)
    return spark.read.parquet(out).select("user", "item")


# Recommendation ------------------------------------------------------------------------


@query
def als_ratings(spark, folder):
    return ratings(spark, folder)


@query
def als_train(spark, folder):
    return als.factors(als.train(ratings(spark, folder), ALS_RANK, ALS_ITERATIONS, SEED))


@query
def als_predict(spark, folder):
    rated = ratings(spark, folder)
    return als.predict(als.train(rated, ALS_RANK, ALS_ITERATIONS, SEED), rated)


def _settled_als(spark: SparkSession, folder: str) -> tuple[DataFrame, ALSModel]:
    """The ratings and a model of them, read from the shared folder.

    A fitted model refers to all shuffles of its training and the ratings to theirs. Read
    back, they refer to none, and the files go before the next step shuffles.
    """
    staging.checkpoints(spark)
    rated = staging.stage(ratings(spark, folder), "ratings")
    staging.release(spark)
    path = storage.work_path(spark, "als")
    storage.save_als(als.train(rated, ALS_RANK, ALS_ITERATIONS, SEED, keep=False), path)
    staging.release(spark)
    return rated, storage.load_als(path)


@query
def als_normal_equations(spark, folder):
    """Users whose factors solve the regularised least squares of their ratings, given the items' factors.

    Training ends with the users. What is left of the equations is held against the sum of
    the terms' sizes, as factors are single precision. The users are joined last: the terms
    are then where their sums are made, and no shuffle holds a row per term.
    """
    rated, model = _settled_als(spark, folder)
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    pairs = rated.join(items, "item").drop("item").join(users, "user")
    error = F.aggregate(F.zip_with("x", "y", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v) - F.col("rating")
    terms = pairs.select("user", "rating", "x", error.alias("e"), F.posexplode("y").alias("place", "yv"))
    sums = terms.groupBy("user", "place").agg(
        F.sum(F.col("e") * F.col("yv")).alias("fit"),
        F.count("*").alias("n"),
        F.first(F.get("x", F.col("place"))).cast("double").alias("xv"),
        F.sum(F.abs(F.col("rating") * F.col("yv"))).alias("scale"),
    )
    left = F.abs(F.col("fit") + F.lit(als.LAMBDA) * F.col("n") * F.col("xv")) <= 1e-3 * (F.col("scale") + 1)
    return sums.groupBy("user").agg(F.min(left).alias("solved"))


@query
def als_predict_dot(spark, folder):
    """Every rated pair, and whether its prediction is the product of the exported factors.

    The export has a row per number. It is gathered to a vector per id before it meets the
    predictions, which so are not repeated for every number.
    """
    rated, model = _settled_als(spark, folder)
    sides = als.factors(model)

    def vectors(side: str, name: str) -> DataFrame:
        numbers = F.array_sort(F.collect_list(F.struct("position", "value")))
        gathered = sides.where(F.col("side") == side).groupBy(F.col("id").alias(side)).agg(numbers.alias("numbers"))
        return gathered.select(side, F.col("numbers.value").alias(name))

    scored = staging.stage(als.predict(model, rated), "scored")
    staging.discard(rated)
    staging.release(spark)
    products = scored.join(vectors("user", "a"), "user").join(vectors("item", "b"), "item")
    dot = F.aggregate(F.zip_with("a", "b", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    summed = products.select("user", "item", dot.alias("dot"), F.col("prediction").alias("p"))
    return summed.select("user", "item", (F.abs(F.col("dot") - F.col("p")) <= 1e-4 * (F.abs("dot") + 1)).alias("same"))


@query
def als_top100(spark, folder):
    rated = ratings(spark, folder)
    return als.top_predictions(als.predict(als.train(rated, ALS_RANK, ALS_ITERATIONS, SEED), rated))


@query
def als_top100_pairs(spark, folder):
    """Which pairs the report of 100 predictions names."""
    return als_top100(spark, folder).select("user", "item")


ALS_SPARSE_SHARE = 0.05


@query
def als_predict_coverage(spark, folder):
    """Pairs scored by a model trained on few ratings: unknown users and items drop out."""
    rated = ratings(spark, folder)
    known = sampling.split_train_test(rated, ALS_SPARSE_SHARE, ["user", "item"], SEED)[0]
    return als.predict(als.train(known, 2, 1, SEED), rated).select("user", "item")


@query
def als_known_pairs(spark, folder):
    """The same pairs, found without a model."""
    rated = ratings(spark, folder)
    known = sampling.split_train_test(rated, ALS_SPARSE_SHARE, ["user", "item"], SEED)[0]
    return als.coverage(rated.select("user", "item"), known)


@query
def als_model_roundtrip(spark, folder):
    rated = ratings(spark, folder)
    model = als.train(rated, 2, 2, SEED)
    path = storage.work_path(spark, "als")
    storage.save_als(model, path)
    loaded = storage.load_als(path)
    both = loaded.setPredictionCol("prediction_2").transform(model.transform(rated))
    return _differing(both, F.col("prediction") == F.col("prediction_2"))


# Two numbers per user and item, so that SQL can repeat the training.
ALS_ROWS_RANK, ALS_ROWS_ITERATIONS = 2, 2


@query
def als_rows_train(spark, folder):
    """Factors by partial normal equations."""
    model = als_rows.train(ratings(spark, folder), ALS_ROWS_RANK, ALS_ROWS_ITERATIONS, SEED)
    return model.factors().select("side", "id", "position", rounded("value", 5))


@query
def als_rows_predict(spark, folder):
    rated = ratings(spark, folder)
    predictions = als_rows.train(rated, ALS_ROWS_RANK, ALS_ROWS_ITERATIONS, SEED).predict(rated)
    return predictions.select("user", "item", rounded("prediction", 4))


@query
def als_rows_equations(spark, folder):
    """Users whose vectors solve their equations, at the rank of the other ALS queries."""
    rated = ratings(spark, folder)
    model = als_rows.train(rated, ALS_RANK, ALS_ITERATIONS, SEED)
    users = model.users.select(F.col("id").alias("user"), F.col("factors").alias("x"))
    items = model.items.select(F.col("id").alias("item"), F.col("factors").alias("y"))
    pairs = rated.join(users, "user").join(items, "item")
    error = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) - F.col("rating")
    terms = pairs.select("user", "rating", "x", error.alias("e"), F.posexplode("y").alias("place", "yv"))
    sums = terms.groupBy("user", "place").agg(
        F.sum(F.col("e") * F.col("yv")).alias("fit"),
        F.count("*").alias("n"),
        F.first(F.get("x", F.col("place"))).alias("xv"),
        F.sum(F.abs(F.col("rating") * F.col("yv"))).alias("scale"),
    )
    left = F.abs(F.col("fit") + F.lit(als.LAMBDA) * F.col("n") * F.col("xv")) <= 1e-8 * (F.col("scale") + 1)
    return sums.groupBy("user").agg(F.min(left).alias("solved"))
