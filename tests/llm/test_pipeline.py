"""Every stage of the pipeline on the smallest tables: what it may change and what it must keep."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from orelode.llm import hash_mixture, string_tiling, tensor_minhash

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    from orelode.session import ship_package
    from orelode.sources.storage import stage

    ship_package(spark)
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        docs.append(stage(step(spark, docs[-1], FOLDER), f"test-{name}"))
    return docs


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_keep_rows_whole(steps):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for before, after in zip(steps[:3], steps[1:4]):
        assert after.columns == before.columns and rows(after) <= rows(before)
    assert set(rows(steps[4])) <= set(rows(steps[3])) and max(rows(steps[4]).values()) <= 3


def test_decisions_take_effect(spark, steps):
    groups = tensor_minhash.near_duplicates(steps[1]).where("kept").collect()
    assert {r.doc_id for r in groups} == {r.doc_id for r in steps[2].collect()}
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    leaking = {r.doc_id for r in string_tiling.find_leaks(steps[2], benchmark).collect()}
    kept = {r.doc_id for r in steps[3].collect()}
    assert leaking and kept == {r.doc_id for r in steps[2].collect()} - leaking
    copies = {r.doc_id: r.copies for r in hash_mixture.mix(steps[3]).collect() if r.copies}
    assert copies == Counter(r.doc_id for r in steps[4].collect())
    assert Counter(r.doc_id for r in steps[5].collect()) == copies


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
    assert docs.count() == 0
