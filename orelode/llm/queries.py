"""The operators of this package applied to whole tables: one query each, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.llm import (
    ans_tokens,
    centroid_language,
    hash_mixture,
    html_layout,
    island_packing,
    merkle_manifest,
    periodic_runs,
    string_tiling,
    suffix_repeats,
    tensor_minhash,
    token_counts,
    vantage_trees,
    zstd_secrets,
)
from orelode.session import ship_package
from orelode.sources.storage import work_path

REPEAT_BYTES = 200
LINK_WORDS, LINK_SHARE = 2, 80
END_ID = 2
TOKEN_LIMIT = 1024
PACK_TOKENS, PACK_END_ID = 2048, 0
RUN_WORDS, RUN_TIMES = 24, 3
WEIGHTS = (5.0, 2.0, 1.0)
NEIGHBOURS = 5
#: Half of an item in a document tells a leak; reordered sentences of under 5 words are in no tile.
LEAK_COVERAGE = 0.5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the strings of 200 bytes that occur elsewhere."""
    left = suffix_repeats.without_repeats(table(spark, folder, "documents"), REPEAT_BYTES)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return left.select(
        "doc_id",
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_tensor_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near duplicates of every document, on shingles of two words."""
    found = tensor_minhash.near_duplicates(table(spark, folder, "documents"), LINK_WORDS, LINK_SHARE)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_ans_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Encode all documents, write the token file, and describe each document as read back."""
    path = work_path(spark, f"token-file-{uuid.uuid4().hex[:8]}")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    back = ans_tokens.round_trip(table(spark, folder, "documents"), vocabulary, END_ID, path)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_zstd_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: counts of the patterns' kinds and all spans."""
    found = zstd_secrets.find_secrets(table(spark, folder, "documents"))
    base = F.filter("found", lambda s: s["kind"] != "novel")
    line = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line("found").alias("spans"),
        count("novel"),
    )


def op5_html_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Title and visible text of every page."""
    return html_layout.extract(table(spark, folder, "pages"))


def op6_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item that leaks into it."""
    leaks = string_tiling.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), LEAK_COVERAGE)
    share = F.round(F.col("n_covered") / F.col("n_words"), 6).alias("coverage")
    return leaks.select("doc_id", "item_id", "n_words", "n_covered", "n_tiles", share)


def op7_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest of all embeddings to each whose id 50 divides; factor 1, so none is missed."""
    embeddings = table(spark, folder, "embeddings")
    return vantage_trees.nearest(embeddings, embeddings.where("vec_id % 50 = 0"), NEIGHBOURS, factor=1.0)


def op8_centroid_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from the labelled ones that are not held out."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    documents = table(spark, folder, "documents").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = centroid_language.fit(documents.where("not held_out"))
    return centroid_language.predict(documents, model, keep=["doc_id", "held_out"])


def op9_hash_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The words that the mix takes of every document."""
    mixed = hash_mixture.mix(table(spark, folder, "documents"), WEIGHTS)
    target = F.round("target", 6).alias("target")
    return mixed.select("doc_id", "size", "source_size", target, (F.col("size") * F.col("copies")).alias("taken"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), vocabulary, limit=TOKEN_LIMIT)


def op11_island_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    packed = island_packing.pack_documents(table(spark, folder, "documents"), vocabulary, PACK_END_ID, PACK_TOKENS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """doc_id, text, where a tenth of the texts repeat some of their words up to their end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+', -1), w -> w <> '')")
    rows = documents.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("int(g % n)")))
    rows = rows.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    # The period stands up to eleven times in what is left.
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)")
    planted = F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left without repeated periods."""
    documents = with_planted_periods(table(spark, folder, "documents"))
    found = periodic_runs.find_runs(documents, RUN_WORDS, RUN_TIMES)
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    # Quotients of whole numbers below 2**26 are equal as doubles only if they are equal.
    best = F.expr("array_max(transform(runs, r -> struct(r.length / r.period as share, -r.start as start, -r.period as period, r.length)))")
    return found.select("doc_id", "runs", "collapsed", lines.alias("lines"), best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digest, proof and check of every document; a seventh of them claim another number of characters."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = table(spark, folder, "documents").select(*columns)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claimed = merkle_manifest.leaf_hash([n_chars if c == "n_chars" else F.col(c) for c in columns])
    leaf = merkle_manifest.leaf_hash([F.col(c) for c in columns])
    rows = documents.select("doc_id", "lang", leaf.alias("leaf"), claimed.alias("claimed"))
    audit = merkle_manifest.audit(merkle_manifest.build(rows, "lang", "doc_id"), "claimed")
    return audit.select("carried.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_repeats,
        op2_tensor_minhash,
        op3_ans_tokens,
        op4_zstd_secrets,
        op5_html_layout,
        op6_string_tiling,
        op7_vantage_trees,
        op8_centroid_language,
        op9_hash_mixture,
        op10_token_counts,
        op11_island_packing,
        op12_periodic_runs,
        op13_merkle_manifest,
    )
}
