"""Sparse vectors, and what is computed from them, against the dense form in numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelode.functions import sparse
from orelode.operators import kmeans, naive_bayes_terms, sparse_rows, tfidf


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 12)) * (rng.random((60, 12)) < 0.3)
    x[7] = 0
    return x


@pytest.fixture(scope="module")
def vectors(spark, rows):
    data = [(i, r.tolist(), rows[(i * 7) % 60].tolist()) for i, r in enumerate(rows)]
    df = spark.createDataFrame([*data, (60, None, [1.0] * 12)], "id int, a array<double>, b array<double>").repartition(4)
    return df.select("id", sparse.from_dense("a").alias("a"), sparse.from_dense("b").alias("b"))


def test_products_and_distances(vectors, rows):
    w = np.arange(12) - 3.5
    out = vectors.select(
        "id", sparse.dot_sparse("a", "b").alias("dot"), sparse.distance_sparse("a", "b").alias("d"), sparse.norm_sparse("a").alias("norm"),
        sparse.dot_dense("a", w).alias("w"), sparse.to_dense("a").alias("dense"), sparse.to_dense(sparse.scaled("a", w)).alias("scaled"),
    )
    for r in out.collect():
        if r.id == 60:
            assert r[1:] == (None,) * 6
            continue
        a, b = rows[r.id], rows[r.id * 7 % 60]
        assert np.allclose([r.dot, r.d, r.norm, r.w], [a @ b, ((a - b) ** 2).sum(), np.linalg.norm(a), a @ w])
        assert np.array_equal(r.dense, a) and np.allclose(r.scaled, a * w)


def test_made_from_entries(spark):
    df = spark.createDataFrame([(1, [0, 4], [1.0, 0.0]), (2, [], []), (3, None, [1.0])], "id int, i array<int>, v array<double>")
    out = {r.id: r.x for r in df.select("id", sparse.sparse_vector(5, "i", "v").alias("x")).collect()}
    assert out[1] == (5, [0, 4], [1.0, 0.0]) and out[2] == (5, [], []) and out[3] is None


@pytest.mark.parametrize(("i", "v"), [([1, 1], [1.0, 2.0]), ([2, 1], [1.0, 2.0]), ([5], [1.0]), ([-1], [1.0]), ([1], [float("nan")]), ([1], []), ([None], [1.0])])
def test_bad_entries_raise(spark, i, v):
    df = spark.createDataFrame([([0], [1.0]), (i, v)], "i array<int>, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="ascending indices"):
        df.select(sparse.sparse_vector(5, "i", "v")).collect()


def test_sizes_must_agree(vectors):
    other = vectors.where("id < 60").select("a", sparse.from_dense(F.array(F.lit(1.0))).alias("c"))
    with pytest.raises(Exception, match="different sizes"):
        other.select(sparse.dot_sparse("a", "c")).collect()


def test_column_statistics(vectors, rows):
    out = sparse_rows.column_summary(vectors.where("id < 60"), "a").orderBy("attribute").collect()
    assert [r.n for r in out] == [60] * 12
    assert np.allclose([r["mean"] for r in out], rows.mean(0)) and np.allclose([r.variance for r in out], rows.var(0, ddof=1))
    assert np.array_equal([r["min"] for r in out], rows.min(0)) and np.array_equal([r["max"] for r in out], rows.max(0))
    assert sparse_rows.column_summary(vectors.limit(0), "a").collect() == []
    with pytest.raises(Exception, match="NULL vector"):
        sparse_rows.column_summary(vectors, "a").collect()


def test_kmeans_is_that_of_dense_rows(spark, vectors, rows):
    df = vectors.where("id < 60")
    dense = df.select("id", sparse.to_dense("a").alias("x"))
    run = sparse_rows.lloyd(df, "a", rows[:5], 4, 0.0)
    other = kmeans.lloyd(dense, "x", rows[:5].tolist(), 4, 0.0)
    assert np.allclose(run.model.centers, other.model.centers) and np.isclose(run.cost, other.cost)
    mine = {(r.cluster, r.attribute): r for r in sparse_rows.patterns(df, "a", run.model.centers).collect()}
    for r in kmeans.patterns(dense, "x", run.model.centers.tolist()).collect():
        own = mine.pop((r.cluster, int(r.attribute)), None)
        if own is None:
            assert r["n"] == 0 or r["min"] == r["max"] == 0
        else:
            assert np.allclose([own.n, own["mean"], own["min"], own["max"]], [r["n"], r["mean"], r["min"], r["max"]])
            assert (own.stddev is None and r.stddev is None) or np.isclose(own.stddev, r.stddev)
    assert not mine
    # A centre that no row is near to stays where it is.
    far = np.vstack([rows[:2], np.full((1, 12), 99.0)])
    assert np.array_equal(sparse_rows.lloyd(df, "a", far, 2).model.centers[2], far[2])
    trained = sparse_rows.train(df, "a", 3, 5, seed=3, key=["id"])
    assert trained.model.centers.shape == (3, 12) and trained.iterations >= 1
    assert sparse_rows.rows_as_centers(df.where("id in (3, 4, 7)"), "a").shape == (3, 12)


DOCS = [
    (1, "a", "x x y"), (2, "a", "x z"), (3, "b", "y y w"), (4, "b", ""), (5, "b", None), (6, "a", "x"),
]


def test_terms_of_every_class_and_none(spark):
    docs = spark.createDataFrame(DOCS, "id long, label string, text string")
    model = naive_bayes_terms.train(docs, "label")
    found = {(r.label, r.term): r.theta for r in model.parameters().collect()}
    # Attributes: x, y, z, w and the empty term of an empty text.
    assert np.isclose(found["a", "x"], np.log((4 + 1) / (6 + 5))) and np.isclose(found["b", ""], np.log((1 + 1) / (4 + 5)))
    test = spark.createDataFrame([(1, "x x"), (2, "w"), (3, "never seen"), (4, None), (5, "y")], "id long, text string")
    out = {r.id: r.prediction for r in model.predict(test, "id").collect()}
    assert out[1] == "a" and out[2] == "b" and out[5] == "b"
    # Both classes have three documents: the smallest label.
    assert out[3] == out[4] == "a"
    hashed = naive_bayes_terms.train(docs, "label", buckets=64)
    assert {r.id: r.prediction for r in hashed.predict(test, "id").collect()}[2] == "b"
    model.release()
    with pytest.raises(ValueError, match="NULL label"):
        naive_bayes_terms.train(docs.selectExpr("nullif(label, 'a') as label", "text"), "label")
    with pytest.raises(ValueError, match="no rows"):
        naive_bayes_terms.train(docs.limit(0), "label")


def test_large_tables_of_terms(spark):
    """Rare and common terms by different joins give the same as one broadcast."""
    docs = spark.createDataFrame([(i, "ab"[i % 2], f"the word{i % 17} {'odd' if i % 2 else 'even'} {'u' * 2000}{i % 3}") for i in range(80)], "id long, label string, text string")
    model = naive_bayes_terms.train(docs, "label")
    one = {r.id: r.prediction for r in model.predict(docs, "id").collect()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert {r.id: r.prediction for r in model.predict(docs, "id").collect()} == one
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert one == {i: "ab"[i % 2] for i in range(80)}


def test_hashed_vectors_are_the_term_frequencies(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, None), (4, "b " * 50)], "doc_id long, text string")
    long = {(r.doc_id, r.bucket): r.tf for r in tfidf.hashed_term_frequency(docs, 16).collect()}
    rows = tfidf.hashed_vectors(docs, 16).collect()
    assert {(r.doc_id, i): v for r in rows for i, v in zip(r.features["indices"], r.features["values"])} == long
    idf = tfidf.sparse_idf(tfidf.hashed_vectors(docs, 16))
    table = {r.bucket: r.idf for r in tfidf.inverse_document_frequency(tfidf.document_frequency(tfidf.hashed_term_frequency(docs, 16), "bucket"), 4, 0, "bucket").collect()}
    assert np.allclose(idf, [table.get(b, np.log(5.0)) for b in range(16)])
