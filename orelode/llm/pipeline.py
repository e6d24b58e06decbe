"""The stages of the corpus pipeline. Each takes the rows its predecessor kept.

All stages but the last return the columns of ``documents`` unchanged; the last returns
a row per document of the token file. Decisions are made on the stage's own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orelode.llm import ans_tokens, centroid_language, hash_mixture, string_tiling, tensor_minhash
from orelode.llm.queries import END_ID, LEAK_COVERAGE, WEIGHTS, table
from orelode.session import ship_package
from orelode.sources.storage import stage, work_path


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose text is near a centroid of a language that the labels of ``docs`` teach."""
    ship_package(spark)
    return centroid_language.keep_known(docs, centroid_language.fit(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words."""
    ship_package(spark)
    return tensor_minhash.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold less than LEAK_COVERAGE of every benchmark item in runs of 5 words and up."""
    return string_tiling.keep_clean(docs, table(spark, folder, "benchmark"), LEAK_COVERAGE)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, from not at all to three times."""
    ship_package(spark)
    return hash_mixture.repeat_rows(docs, WEIGHTS)


def token_file(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the token file, as read back."""
    ship_package(spark)
    path = work_path(spark, "token-file")
    back = ans_tokens.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, path)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_each),
    ("benchmark", without_leaks),
    ("mixture", mixed_sources),
    ("tokens", token_file),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder."""
    docs = table(spark, folder, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
