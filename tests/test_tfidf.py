from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orelode.functions.text import term_bucket
from orelode.operators import tfidf


@pytest.fixture(scope="module")
def fruit(spark):
    return spark.createDataFrame([(0, "red apple red"), (1, "green apple")], "doc_id bigint, text string")


@pytest.fixture(scope="module")
def prose(spark):
    """A term in every document, terms in some, and many terms of one document only."""
    rows = []
    for i in range(120):
        words = ["the"] * (i % 5 + 1) + [f"w{i % j}" for j in range(2, 9)] + [f"only{i}", "", "the", "x" * 2000]
        rows.append((i, " ".join(words)))
    rows += [(200, ""), (201, "   "), (202, "tail  ")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).persist()


def expected_tf(docs):
    return {
        (r.doc_id, t): n for r in docs.collect() for t, n in Counter(r.text.split(" ")).items()
    }


def test_hand_computed(fruit):
    tf = tfidf.term_frequency(fruit)
    assert {r.term: r.df for r in tfidf.document_frequency(tf).collect()} == {"red": 1, "apple": 2, "green": 1}
    weights = {(r.doc_id, r.term): r.weight for r in tfidf.tfidf(fruit).collect()}
    assert math.isclose(weights[0, "red"], 2 * math.log(3 / 2)) and weights[0, "apple"] == 0.0


def test_idf_below_the_minimum_is_zero(spark):
    table = spark.createDataFrame([("a", 2), ("b", 1)], "term string, df bigint")
    plain = {r.term: r.idf for r in tfidf.inverse_document_frequency(table, 3).collect()}
    assert math.isclose(plain["a"], math.log(4 / 3)) and math.isclose(plain["b"], math.log(2))
    limited = {r.term: r.idf for r in tfidf.inverse_document_frequency(table, 3, 2).collect()}
    assert limited == {"a": plain["a"], "b": 0.0}
    with pytest.raises(ValueError):
        tfidf.inverse_document_frequency(table, 3, -1)


def test_frequencies_equal_brute_force(prose):
    found = {(r.doc_id, r.term): r.tf for r in tfidf.term_frequency(prose).collect()}
    assert found == expected_tf(prose)


def test_frequencies_need_no_shuffle(prose):
    for df in (tfidf.term_frequency(prose), tfidf.hashed_term_frequency(prose)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("InMemory", "") or "hashpartitioning" not in plan


def test_stripped_documents(prose):
    rows = tfidf.term_frequency(prose.filter("doc_id >= 200"), strip_trailing=True).collect()
    assert sorted((r.doc_id, r.term, r.tf) for r in rows) == [(200, "", 1), (202, "tail", 1)]


def test_documents_without_tokens_count(prose):
    """The document of blanks has no tokens but is one of the N documents."""
    docs = prose.filter("doc_id >= 201")
    rows = tfidf.tfidf(docs, strip_trailing=True).collect()
    assert [(r.term, r.weight) for r in rows] == [("tail", math.log(3 / 2))]


@pytest.mark.parametrize("buckets", [1, 29, 0])
def test_hashed_frequencies_add_up(prose, buckets):
    hashed = tfidf.hashed_term_frequency(prose, buckets)
    terms = tfidf.term_frequency(prose).groupBy("doc_id", term_bucket(F.col("term"), buckets).alias("bucket"))
    assert sorted(terms.agg(F.sum("tf").alias("tf")).collect()) == sorted(hashed.collect())


@pytest.mark.parametrize("buckets", [None, 29])
@pytest.mark.parametrize("hot_share", [10_000, 20, 3])
@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_every_way_to_look_up_weights_agrees(spark, prose, monkeypatch, buckets, hot_share, limit):
    """Broadcast table, and hot terms broadcast with rare ones shuffled: same rows."""
    key = "term" if buckets is None else "bucket"
    tf = tfidf.term_frequency(prose) if buckets is None else tfidf.hashed_term_frequency(prose, buckets)
    pairs = {(r.doc_id, r[key]): r.tf for r in tf.collect()}
    df_counts = Counter(k for _, k in pairs)
    n = prose.count()
    monkeypatch.setattr(tfidf, "HOT_SHARE", hot_share)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        model = tfidf.fit_idf(tf, n, 2, key)
        found = {(r.doc_id, r[key]): r for r in model.transform(tf).collect()}
        model.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.keys() == pairs.keys()
    for (doc, k), r in found.items():
        idf = math.log((n + 1) / (df_counts[k] + 1)) if df_counts[k] >= 2 else 0.0
        assert r.tf == pairs[doc, k] and math.isclose(r.weight, r.tf * idf, abs_tol=1e-12)
    assert (model.n_pairs, model.n_keys) == (len(pairs), len(df_counts))


def test_hot_terms_are_few(spark, prose, monkeypatch):
    monkeypatch.setattr(tfidf, "HOT_SHARE", 20)
    tf = tfidf.term_frequency(prose)
    model = tfidf.fit_idf(tf, prose.count())
    hot = {r.term for r in model.table.filter(F.col("df") > model.n_pairs // tfidf.HOT_SHARE).collect()}
    assert 0 < len(hot) <= 20 and "the" in hot and any(len(t) > tfidf.LONG_TERM_BYTES for t in hot)
    # However long, hot terms never reach the shuffled side of the merge join.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = model.transform(tf)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("strategy=broadcast") == 2 and "strategy=merge" in plan
    model.release()


def test_nothing_stays_cached(spark, prose):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert tfidf.tfidf(prose.select("doc_id", "text"), 2).count() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_agrees_with_the_vector_form(spark, prose):
    """Against the classes for RDDs, whose buckets and weights the hashed form follows."""
    from pyspark.mllib.feature import IDF
    from pyspark.mllib.linalg import Vectors

    buckets = 64
    tf = tfidf.hashed_term_frequency(prose, buckets)
    rows = tf.groupBy("doc_id").agg(F.collect_list(F.struct("bucket", "tf")).alias("b")).orderBy("doc_id").collect()
    vectors = [Vectors.sparse(buckets, sorted((x.bucket, float(x.tf)) for x in r.b)) for r in rows]
    rdd = spark.sparkContext.parallelize(vectors, 2)
    expected = IDF(minDocFreq=3).fit(rdd).transform(rdd).collect()
    found: dict = {}
    for r in tfidf.tfidf(prose, 3, buckets).collect():
        found.setdefault(r.doc_id, {})[r.bucket] = r.weight
    for r, v in zip(rows, expected):
        for i, w in zip(v.indices, v.values):
            assert math.isclose(found[r.doc_id][int(i)], w, abs_tol=1e-12)


def test_broadcast_limit(spark):
    for text, size in (("10MB", 10 << 20), ("10485760b", 10 << 20), ("1g", 1 << 30), ("-1", -1), ("512", 512), ("4k", 4096)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        try:
            assert tfidf.broadcast_limit(spark.range(1)) == size
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
