"""Multinomial Naive Bayes over terms in long form: no row is ever as wide as the vocabulary.

Training is one aggregation over (label, term) and scoring a join of (document, term) pairs with
the terms' parameters. With smoothing L, D attributes and class c of n_c documents and S_c terms::

    theta_c(absent) = ln(L / (S_c + D L))
    theta_ct        = theta_c(absent) + ln(1 + s_ct / L)

so the sum over all terms of a document is its number of terms times the first, which is a
number per class, and the second only for the pairs that the training saw. Only the
classes' numbers come to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from orelode.functions.text import check_buckets, split_tokens
from orelode.operators.tfidf import hashed_term_frequency, look_up, term_frequency
from orelode.sources.staging import discard, stage

#: Classes of a model, whose numbers the driver holds and every row is scored with.
MAX_CLASSES = 10_000

# A row's fixed part and an entry of a class, when the size of the table is estimated.
_ROW_BYTES, _ENTRY_BYTES = 64, 16


@dataclass(frozen=True)
class TermBayesModel:
    """``table`` (key, df, deltas) is staged in the shared folder; ``classes`` has label, pi and absent, labels ascending."""

    table: DataFrame
    key: str
    classes: list[Row]
    label_type: str
    buckets: int | None
    n_pairs: int
    table_bytes: int

    def parameters(self) -> DataFrame:
        """(label, key, pi, theta) of all pairs that the training saw."""
        rows = self.table.select(self.key, F.inline("deltas"))
        # One row per class.
        classes = self.table.sparkSession.createDataFrame(
            [(i, c.pi, c.absent) for i, c in enumerate(self.classes)], "class int, pi double, absent double"
        )
        found = rows.join(F.broadcast(classes), "class")
        return found.select(self._label(F.col("class")).alias("label"), self.key, "pi", (F.col("absent") + F.col("delta")).alias("theta"))

    def predict(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prediction: str = "prediction") -> DataFrame:
        """(doc_id, prediction) of every document; ties go to the smallest label.

        Terms that no class saw say nothing; of hash buckets all count. Rows that share an id
        are scored as one document. A null text gets the most frequent class.
        """
        tf = _pairs(docs.select(doc_id, text), [doc_id], text, self.buckets)
        found = look_up(tf, self.table, self.key, "deltas", self.n_pairs, self.table_bytes)
        # Class -1 counts the terms that say something.
        if self.buckets is None:
            entries, n = F.concat("deltas", F.array(F.struct(F.lit(-1).alias("class"), F.lit(1.0).alias("delta")))), F.lit(0.0)
        else:
            entries, n = F.col("deltas"), F.coalesce(F.size(split_tokens(F.col(text))), F.lit(0)).cast("double")
        hits = found.select(doc_id, "tf", F.inline(entries)).select(doc_id, "class", (F.col("tf") * F.col("delta")).alias("s"))
        every = docs.select(doc_id, F.lit(-1).alias("class"), F.greatest(n, F.lit(0.0)).alias("s"))
        sums = hits.unionByName(every).groupBy(doc_id, "class").agg(F.sum("s").alias("s"))
        # A row per class and document at the most.
        held = sums.groupBy(doc_id).agg(F.map_from_entries(F.collect_list(F.struct("class", "s"))).alias("sums"))
        pi, absent = (F.array(*[F.lit(c[name]) for c in self.classes]) for name in ("pi", "absent"))
        ready = held.select(doc_id, "sums", F.col("sums")[-1].alias("n"), pi.alias("pi"), absent.alias("absent"))
        score = F.expr(
            "array_max(transform(pi, (p, c) -> struct(p + n * absent[c] + coalesce(sums[c], 0D) as score, -c as class)))"
        )
        return ready.select(doc_id, self._label(-score["class"]).alias(prediction))

    def release(self) -> None:
        discard(self.table)

    def _label(self, number):
        return F.element_at(F.array(*[F.lit(c.label).cast(self.label_type) for c in self.classes]), number + 1)


def train(
    docs: DataFrame, label: str, text: str = "text", buckets: int | None = None, smoothing: float = 1.0
) -> TermBayesModel:
    """Fit on rows of label and text, by term or (with ``buckets``) by hash bucket. NULL labels raise; a null text has no terms."""
    if not smoothing > 0:
        raise ValueError(f"smoothing must be positive but got {smoothing}")
    rows = docs.select(F.col(label).alias("label"), F.col(text).alias("text"))
    counts = rows.groupBy("label").agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    if not counts:
        raise ValueError("no rows to train on")
    if any(r.label is None for r in counts):
        raise ValueError("NULL label in the training rows")
    key = "term" if buckets is None else "bucket"
    buckets = None if buckets is None else check_buckets(buckets)
    pairs = _pairs(rows, ["label"], "text", buckets)
    sums = stage(pairs.groupBy("label", key).agg(F.sum("tf").alias("s"), F.count("*").alias("df")), "class-terms")
    whole = {r.label: r.s for r in sums.groupBy("label").agg(F.sum("s").alias("s")).collect()}
    attributes = buckets if buckets is not None else sums.select(key).distinct().count()
    n = sum(r.n for r in counts)
    counts.sort(key=lambda r: r.label)
    classes = [
        Row(
            label=r.label,
            pi=math.log((r.n + smoothing) / (n + len(counts) * smoothing)),
            absent=math.log(smoothing / (whole.get(r.label, 0) + attributes * smoothing)) if attributes else 0.0,
        )
        for r in counts
    ]
    numbers = docs.sparkSession.createDataFrame([(c.label, i) for i, c in enumerate(classes)], _schema(rows))
    entry = F.struct("class", F.log1p(F.col("s") / F.lit(float(smoothing))).alias("delta"))
    # One row per class on the broadcast side; a term has an entry per class at the most.
    table = sums.join(F.broadcast(numbers), "label").groupBy(key).agg(F.sum("df").alias("df"), F.collect_list(entry).alias("deltas"))
    table = stage(table, "term-parameters")
    width = F.octet_length(F.col(key).cast("string")) + _ROW_BYTES + _ENTRY_BYTES * F.size("deltas")
    size = table.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("pairs"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    discard(sums)
    return TermBayesModel(table, key, classes, rows.schema["label"].dataType.simpleString(), buckets, size.pairs, size.bytes)


def _pairs(rows: DataFrame, keep: list[str], text: str, buckets: int | None) -> DataFrame:
    """``keep`` columns, term or bucket, and tf. Narrow."""
    packed = rows.select(F.struct(*keep).alias("__row"), F.col(text).alias("__text"))
    if buckets is None:
        tf = term_frequency(packed, "__row", "__text")
    else:
        tf = hashed_term_frequency(packed, buckets, "__row", "__text")
    return tf.select("__row.*", *tf.columns[1:])


def _schema(rows: DataFrame) -> str:
    return f"label {rows.schema['label'].dataType.simpleString()}, class int"
