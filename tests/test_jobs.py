from __future__ import annotations

import math

import pytest

from orelode.plans import jobs
from orelode.sources import storage


def test_kmeans_job(spark, write_lines, tmp_path):
    rows = [f"t,{i},39,{i % 2 * 100 + i / 10},,{i % 2 * 50},1.5," for i in range(40)]
    path = write_lines("datetime,CellID,countrycode,smsin,smsout,callin,callout,internet", *rows)
    model_path = str(tmp_path / "model")
    report = jobs.run_kmeans(spark, path, model_path, 2, 10, ("n", "mean", "stddev"), seed=3)
    assert report.patterns.columns == ["cluster", "attribute", "n", "mean", "stddev"]
    table = {(r.cluster, r.attribute): r for r in report.patterns.collect()}
    assert sorted(r.n for k, r in table.items() if k[1] == "smsin") == [20, 20]
    for r in report.centers.collect():
        assert r.center == table[r.cluster, r.attribute]["mean"]
    assert report.info.first().converged
    assert storage.load_kmeans(spark, model_path) == report.model
    with pytest.raises(Exception):
        jobs.run_kmeans(spark, path, model_path, 2, 10, seed=3)


def test_naive_bayes_jobs(spark, write_lines, tmp_path):
    kinds = [("Iris-setosa", "9,1,1,1"), ("Iris-versicolor", "1,9,1,1"), ("other", "1,1,9,1")]
    rows = [f"{i},{kinds[i % 3][1]},{kinds[i % 3][0]}" for i in range(90)]
    path = write_lines("Id,a,b,c,d,Species", *rows)
    report = jobs.train_naive_bayes(spark, path, str(tmp_path / "m"), 0.7, seed=1)
    assert [r.label for r in report.labels.collect()] == [1.0, 2.0, 3.0]
    result = report.accuracy.first()
    assert result.accuracy == 1.0 and 10 < result.n < 45
    top = jobs.predict_naive_bayes(spark, path, str(tmp_path / "m"), str(tmp_path / "out"))
    assert [r.prediction for r in top.collect()] == [1.0] * 30 + [2.0] * 30 + [3.0] * 30
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.columns == ["value", "prediction"] and written.count() == 90


def test_pca_and_statistics_jobs(spark, write_lines, tmp_path):
    path = write_lines(*[f"{i} {2 * i} {i % 3}" for i in range(30)])
    report = jobs.run_pca(spark, path, str(tmp_path / "pca"), 2)
    written = spark.read.parquet(str(tmp_path / "pca"))
    assert written.columns == ["value", "pc0", "pc1"] and written.count() == 30 == report.sample.count()
    assert report.components.count() == 6
    stats = jobs.run_statistics(spark, path, str(tmp_path / "stats"), ("n", "mean"), "csv")
    assert {r.attribute: (r.n, r["mean"]) for r in stats.collect()} == {"0": (30, 14.5), "1": (30, 29.0), "2": (30, 1.0)}
    assert spark.read.csv(str(tmp_path / "stats")).count() == 3


@pytest.mark.parametrize("buckets", [0, 29])
@pytest.mark.parametrize("min_doc_freq", [0, 9])
def test_tfidf_job(spark, write_lines, tmp_path, buckets, min_doc_freq):
    path = write_lines("red apple red", "green apple ", "   ")
    out = str(tmp_path / "tfidf")
    sample = jobs.run_tfidf(spark, path, out, buckets, min_doc_freq)
    written = spark.read.parquet(out)
    assert written.columns == ["doc_id", "bucket", "tf", "weight"] and written.count() == 4
    assert sorted(sample.collect()) == sorted(written.collect())
    weights = {round(r.weight, 9) for r in written.collect()}
    expected = {0.0} if min_doc_freq else {math.log(4 / 3), math.log(2), 2 * math.log(2)}
    assert weights == {round(w, 9) for w in expected}


def test_als_jobs(spark, write_lines, tmp_path):
    ratings = [f"{u},{i},{(u + i) % 4 + 1}" for u in range(12) for i in range(12)]
    jobs.train_als(spark, write_lines(*ratings), str(tmp_path / "m"), 2, 3, seed=1)
    pairs = write_lines("1,2,0", "3,4", "3,4", "999,1", "1,999")
    top = jobs.predict_als(spark, pairs, str(tmp_path / "m"), str(tmp_path / "out"), "csv")
    assert [(r.user, r.item) for r in top.collect()] == [(1, 2), (3, 4), (3, 4)]
    assert spark.read.csv(str(tmp_path / "out")).count() == 3
