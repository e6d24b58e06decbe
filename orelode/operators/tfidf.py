"""Term frequency, document frequency and TF-IDF, by term or by hash bucket.

One row is one document. Its tokens are sorted and counted inside the row, so term
frequencies need no shuffle; tokens of a hot document or term are never moved.

Document frequencies are combined per task before their shuffle. Weights are then
looked up by term. Natural text puts most (document, term) pairs on few terms, so

* a table below the session's broadcast limit (measured, not guessed) is broadcast;
* otherwise the terms above 1 in ``HOT_SHARE`` of all pairs, at most ``HOT_SHARE``
  by counting, are broadcast, and only the pairs of the rare terms are shuffled. No
  rare term holds more than 1 in ``HOT_SHARE`` of the pairs. A hot term of over
  ``LONG_TERM_BYTES`` is broadcast by its SHA-256, so the table has at most 10 MB.

The idf table is written to the shared folder, not cached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.sparse import counted
from orelode.functions.text import DEFAULT_BUCKETS, check_buckets, split_tokens, term_bucket
from orelode.sources.staging import discard, stage

HOT_SHARE = 10_000
# Longer terms are looked up by their digest, which bounds the hot table to 10 MB.
LONG_TERM_BYTES = 1_024
# A row's fixed part (numbers, offsets) when the size of a table is estimated.
_ROW_BYTES = 48


def tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", strip_trailing: bool = False) -> DataFrame:
    """(doc_id, pos, token), every token in order."""
    return docs.select(doc_id, F.posexplode(split_tokens(F.col(text), strip_trailing)).alias("pos", "token"))


def term_frequency(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", strip_trailing: bool = False
) -> DataFrame:
    """(doc_id, term, tf). Narrow."""
    return _frequencies(docs, doc_id, split_tokens(F.col(text), strip_trailing), "term")


def hashed_term_frequency(
    docs: DataFrame,
    buckets: int = DEFAULT_BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
    strip_trailing: bool = False,
) -> DataFrame:
    """(doc_id, bucket, tf); terms in the same bucket add up. Narrow."""
    check_buckets(buckets)
    hashed = F.transform(split_tokens(F.col(text), strip_trailing), lambda t: term_bucket(t, buckets))
    return _frequencies(docs, doc_id, hashed, "bucket")


def hashed_vectors(
    docs: DataFrame,
    buckets: int = DEFAULT_BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
    strip_trailing: bool = False,
) -> DataFrame:
    """(doc_id, features): hashed term frequencies as a sparse vector. Narrow; a null text has no terms."""
    size = check_buckets(buckets)
    hashed = F.transform(split_tokens(F.col(text), strip_trailing), lambda t: term_bucket(t, buckets))
    return docs.select(doc_id, counted(size, hashed).alias("features"))


def sparse_idf(vectors: DataFrame, features: str = "features", min_doc_freq: int = 0) -> np.ndarray:
    """The inverse document frequency of every attribute of a column of vectors; a row is a document.

    One row per stored attribute comes back; the result has as many numbers as a vector has attributes.
    """
    sizes = vectors.agg(F.count("*").alias("n"), F.max(f"{features}.size").alias("size")).first()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, n = np.unique(batch.column(0).drop_null().field("indices").flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(n)], names=["place", "n"])

    # A filter on the vectors would be pushed below what they are computed from, and compute it again.
    held = vectors.select(features).mapInArrow(count, "place int, n long")
    table = held.groupBy("place").agg(F.sum("n").alias("df"))
    found = inverse_document_frequency(table, sizes.n, min_doc_freq, "place").toArrow()
    # What no document has gets the value of df = 0.
    idf = np.full(sizes.size or 0, np.log(sizes.n + 1.0) if min_doc_freq <= 0 else 0.0)
    idf[found.column("place").to_numpy()] = found.column("idf").to_numpy()
    return idf


def document_frequency(tf: DataFrame, key: str = "term") -> DataFrame:
    """(term, df): in how many documents each term occurs.

    ``tf`` has one row per document and term, so counting rows is enough.
    """
    return tf.groupBy(key).agg(F.count(F.lit(1)).alias("df"))


def inverse_document_frequency(
    df_table: DataFrame, n_docs: int | Column, min_doc_freq: int = 0, key: str = "term"
) -> DataFrame:
    """(term, df, idf) with ``idf = ln((N + 1) / (df + 1))``, 0 below ``min_doc_freq``."""
    if min_doc_freq < 0:
        raise ValueError(f"minimum document frequency must not be negative but got {min_doc_freq}")
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    ratio = (n.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0)
    idf = F.when(F.col("df") >= min_doc_freq, F.ln(ratio)).otherwise(F.lit(0.0))
    return df_table.select(key, "df", idf.alias("idf"))


@dataclass(frozen=True)
class IdfModel:
    """A fitted table (term, df, idf) with its measured size.

    The table is staged in the shared folder, as every use reads it; ``release``
    deletes it, after which nothing that was derived from the model may run.
    """

    table: DataFrame
    key: str
    n_docs: int
    n_keys: int
    n_pairs: int
    table_bytes: int

    def transform(self, tf: DataFrame) -> DataFrame:
        """(doc_id, term, tf, weight) with ``weight = tf * idf``."""
        weight = (F.col("tf") * F.col("idf")).alias("weight")
        return look_up(tf, self.table, self.key, "idf", self.n_pairs, self.table_bytes).select(*tf.columns, weight)

    def release(self) -> None:
        discard(self.table)


def look_up(tf: DataFrame, table: DataFrame, key: str, value: str, n_pairs: int, table_bytes: int) -> DataFrame:
    """``tf`` with the column ``value`` of the table's row of the same key; pairs of other keys drop out.

    ``table`` has key, df (pairs of the key) and value, staged, and ``table_bytes`` in all. A
    table below the broadcast limit is broadcast, else the rows of hot keys are.
    """
    columns = [*tf.columns, value]
    if table_bytes <= broadcast_limit(tf):
        return tf.join(F.broadcast(table.select(key, value)), key).select(*columns)
    hot = F.col("df") > F.lit(n_pairs // HOT_SHARE)
    hot_rows = table.filter(hot).select(*_lookup(key), value)
    rare_rows = table.filter(~hot).select(key, value)
    tagged = tf.select("*", *_lookup(key)).join(F.broadcast(hot_rows), ["__long", "__key"], "left")
    hot_pairs = tagged.filter(F.col(value).isNotNull()).select(*columns)
    rare_tf = tagged.filter(F.col(value).isNull()).select(*tf.columns)
    return hot_pairs.unionByName(rare_tf.join(rare_rows.hint("merge"), key).select(*columns))


def _lookup(key: str) -> list[Column]:
    """The term, or its digest if it is long."""
    text = F.col(key).cast("string")
    long = F.octet_length(text) > LONG_TERM_BYTES
    return [long.alias("__long"), F.when(long, F.sha2(text.cast("binary"), 256)).otherwise(text).alias("__key")]


def fit_idf(tf: DataFrame, n_docs: int, min_doc_freq: int = 0, key: str = "term") -> IdfModel:
    """Compute and stage the idf table of a corpus of ``n_docs`` documents."""
    table = stage(inverse_document_frequency(document_frequency(tf, key), n_docs, min_doc_freq, key), "idf")
    key_bytes = F.octet_length(F.col(key).cast("string")) + F.lit(_ROW_BYTES)
    size = table.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("n_pairs"),
        F.coalesce(F.sum(key_bytes), F.lit(0)).alias("bytes"),
    ).first()
    return IdfModel(table, key, n_docs, size.n_keys, size.n_pairs, size.bytes)


def tfidf(
    docs: DataFrame,
    min_doc_freq: int = 0,
    buckets: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    strip_trailing: bool = False,
) -> DataFrame:
    """Fit and weigh the same documents, by term or (with ``buckets``) by hash bucket.

    Term frequencies and the idf table are staged, so documents are split once; both
    tables stay in the shared folder, as the result reads them whenever it is run. Use
    ``fit_idf`` and ``IdfModel.release`` to decide about that yourself.
    """
    if buckets is None:
        key, tf = "term", term_frequency(docs, doc_id, text, strip_trailing)
    else:
        key, tf = "bucket", hashed_term_frequency(docs, buckets, doc_id, text, strip_trailing)
    tf = stage(tf, "tf")
    return fit_idf(tf, docs.count(), min_doc_freq, key).transform(tf)


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes (negative: never)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b").strip().lower()
    units = {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30}
    text = text.removesuffix("b") if text[-2:-1] in units else text
    if text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def _frequencies(docs: DataFrame, doc_id: str, items: Column, name: str) -> DataFrame:
    """Count equal items of each row: sort them and measure the runs."""
    rows = docs.select(doc_id, F.sort_array(items).alias("__sorted"))
    starts = F.expr(
        "filter(sequence(0, size(__sorted) - 1), i -> i = 0 OR __sorted[i] <> __sorted[i - 1])"
    )
    no_items = F.array().cast("array<int>")
    rows = rows.withColumn("__starts", F.when(F.size("__sorted") > 0, starts).otherwise(no_items))
    runs = F.expr(
        f"transform(__starts, (i, j) -> struct(__sorted[i] AS {name}, "
        "cast(coalesce(get(__starts, j + 1), size(__sorted)) - i AS bigint) AS tf))"
    )
    return rows.select(doc_id, F.inline(runs))
