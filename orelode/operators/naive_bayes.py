"""Multinomial Naive Bayes.

Training is one aggregation by label (a row per label and task is shuffled, so a
label with most of the rows is no burden); its classes x attributes numbers are
the model. Scoring is a narrow expression over literals.

With N rows, C classes, D attributes, n_c rows and attribute sums s_cj in class c
and smoothing L::

    pi_c     = ln((n_c + L) / (N + C L))
    theta_cj = ln((s_cj + L) / (sum_j s_cj + D L))

and the predicted class is the one with the largest ``pi_c + sum_j x_j theta_cj``;
ties go to the smallest label.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelode.functions.vectors import (
    best_of_sql,
    dot_sql,
    feature_array,
    first_best_sql,
    is_narrow,
    linear_argmax_udf,
    with_required,
)

Label = str | float | int

# Wider rows are aggregated by position, as in the K-Means passes.
_WIDE_AGGREGATE = 16

#: Classes of a model, all of which the driver holds.
MAX_CLASSES = 100_000


@dataclass(frozen=True)
class NaiveBayesModel:
    """Class parameters; ``labels`` ascend and ``label_type`` is their Spark type."""

    features: list[str]
    labels: list[Label]
    pi: list[float]
    theta: list[list[float]]
    label_type: str

    def predict(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Add the predicted label to every row; the other columns stay."""
        index = "__class"
        if is_narrow(self.features, len(self.labels)):
            scored, xs = with_required(df, self.features)
            ss = [f"__s{c}" for c in range(len(self.labels))]
            scores = [f"{dot_sql(xs, t, p)} AS {s}" for t, p, s in zip(self.theta, self.pi, ss)]
            scored = scored.selectExpr("*", *scores).selectExpr("*", f"{best_of_sql('greatest', ss)} AS __best")
            scored = scored.selectExpr("*", f"{first_best_sql(ss, '__best')} AS {index}")
            scored = scored.drop("__best", *xs, *ss)
        else:
            argmax = linear_argmax_udf(self.theta, self.pi)
            scored = df.withColumn(index, argmax(feature_array(self.features)))
        names = F.array(*[F.lit(v).cast(self.label_type) for v in self.labels])
        return scored.withColumn(prediction, F.element_at(names, F.col(index) + 1)).drop(index)

    def priors_frame(self, spark: SparkSession) -> DataFrame:
        """(label, pi)."""
        schema = self._schema(T.StructField("pi", T.DoubleType()))
        return spark.createDataFrame(list(zip(self.labels, self.pi)), schema)

    def theta_frame(self, spark: SparkSession) -> DataFrame:
        """(label, attribute, theta)."""
        rows = [
            (label, f, t)
            for label, row in zip(self.labels, self.theta)
            for f, t in zip(self.features, row, strict=True)
        ]
        schema = self._schema(T.StructField("attribute", T.StringType()), T.StructField("theta", T.DoubleType()))
        return spark.createDataFrame(rows, schema)

    def labels_frame(self, spark: SparkSession) -> DataFrame:
        """(label), ascending."""
        return spark.createDataFrame([(v,) for v in self.labels], self._schema())

    def _schema(self, *more: T.StructField) -> T.StructType:
        label_type = T._parse_datatype_string(self.label_type)
        return T.StructType([T.StructField("label", label_type), *more])


def class_sums(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """(label, n, sum of every attribute under its own name); bad attributes raise, as in ``train``."""
    checked, xs = with_required(df.select(F.col(label).alias("__label"), *features), features)
    sums = [F.sum(x).alias(f) for x, f in zip(xs, features)]
    return checked.groupBy(F.col("__label").alias("label")).agg(F.count(F.lit(1)).alias("n"), *sums)


def train(df: DataFrame, label: str, features: Sequence[str], smoothing: float = 1.0) -> NaiveBayesModel:
    """Fit in one pass. Negative, NULL, NaN or infinite attributes and NULL labels raise."""
    features = list(features)
    rows = df.select(F.col(label).alias("__label"), *features)
    if len(features) > _WIDE_AGGREGATE:
        totals = _totals_by_position(rows, features)
    else:
        checked, xs = with_required(rows, features)
        totals = checked.groupBy("__label").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(x) for x in xs]).alias("sums"),
            F.array(*[F.min(x) for x in xs]).alias("smallest"),
        )
    # One row per class.
    rows = totals.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    if not rows:
        raise ValueError("no rows to train on")
    if any(r["__label"] is None for r in rows):
        raise ValueError("NULL label in the training rows")
    for f, smallest in zip(features, map(min, zip(*[r.smallest for r in rows]))):
        if smallest < 0:
            raise ValueError(f"attribute {f} must not be negative but has {smallest}")
    rows.sort(key=lambda r: r["__label"])
    n = sum(r.n for r in rows)
    pi = [math.log((r.n + smoothing) / (n + len(rows) * smoothing)) for r in rows]
    theta = []
    for r in rows:
        whole = sum(r.sums) + len(features) * smoothing
        theta.append([math.log((s + smoothing) / whole) for s in r.sums])
    label_type = df.schema[label].dataType.simpleString()
    return NaiveBayesModel(features, [r["__label"] for r in rows], pi, theta, label_type)


def _totals_by_position(rows: DataFrame, features: list[str]) -> DataFrame:
    """__label, n, sums and smallest, aggregated by label and position."""
    values = rows.select("__label", F.posexplode(feature_array(features)).alias("pos", "x"))
    cells = values.groupBy("__label", "pos").agg(F.count("x").alias("n"), F.sum("x").alias("s"), F.min("x").alias("low"))
    # A row per class and attribute, as the model has.
    held = F.array_sort(F.collect_list(F.struct("pos", "s", "low")))
    totals = cells.groupBy("__label").agg(F.first("n").alias("n"), held.alias("held"))
    return totals.select("__label", "n", F.col("held.s").alias("sums"), F.col("held.low").alias("smallest"))


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(n, correct, accuracy); the accuracy of no rows is NULL."""
    right = (F.col(prediction) == F.col(label)).cast("double")
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(right), F.lit(0.0)).cast("bigint").alias("correct"),
        F.avg(right).alias("accuracy"),
    )
