"""Vector expressions over feature columns.

Features are given either as a list of column names (one double column per
attribute) or as one array column. Two forms of the same arithmetic are used:

* up to ``NARROW_TERMS`` (centres x attributes) terms the expression is written
  out over the columns and stays inside whole-stage code generation;
* beyond that the generated Java method is too long for the JVM to compile and
  runs several times slower, so an Arrow UDF works on whole column batches instead.

Both add the terms attribute by attribute in the same order and give bit-equal
results. Both take finite numbers only: a feature that is NULL, NaN or infinite
raises, as does an array that is NULL, empty or not as wide as the model.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Features = Sequence[str] | str

# Measured on 6 M rows x 4 attributes, written out: 19 centres (76 terms) 0.7 s,
# 40 centres over 9 s, 77 centres 26 s. The Arrow form: 19 centres 1.3 s, 77 centres 3.1 s.
NARROW_TERMS = 80

# A filter on a distance is pushed below its projection, where the optimizer writes
# every term out twice more, each with its NULL check.
FILTERED_TERMS = 20


def double_literal(value: float) -> str:
    """A double as SQL text; ``repr`` keeps every bit."""
    return f"({float(value)!r}D)" if np.isfinite(value) else f"double('{float(value)!r}')"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def required_sql(column: str) -> str:
    """The column as a finite double: NULL, NaN and infinity raise.

    The last argument only tells the optimizer that the result is never NULL,
    which halves the code generated for each distance term.
    """
    label = column.replace("\\", "\\\\").replace("'", "\\'")
    value = f"cast({name(column)} AS double)"
    message = f"cast(raise_error('NULL, NaN or infinity in feature {label}') AS double)"
    return f"coalesce(CASE WHEN abs({value}) < double('Infinity') THEN {value} END, {message}, 0D)"


def with_required(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the checked features as new columns, and tell their names."""
    xs = [f"__x{i}" for i in range(len(features))]
    checked = [f"{required_sql(f)} AS {x}" for f, x in zip(features, xs)]
    return df.selectExpr("*", *checked), xs


def feature_array(features: Features, width: int | None = None) -> Column:
    """The features of a row as one array of finite doubles; anything else raises.

    Without ``width`` an array column may have any number of attributes but none.
    """
    if isinstance(features, str):
        values = F.col(features).cast("array<double>")
        fits = F.size(values) > 0 if width is None else F.size(values) == width
        finite = F.forall(values, lambda v: F.abs(v) < float("inf"))
        wanted = "attributes" if width is None else f"{width} attributes"
        bad = F.raise_error(F.lit(f"a row of {features} has not {wanted}, all finite")).cast("array<double>")
        return F.when(values.isNotNull() & fits & finite, values).otherwise(bad)
    return F.expr(f"array({', '.join(required_sql(f) for f in features)})")


def l2_norm(features: Features) -> Column:
    """Euclidean length of a row."""
    if isinstance(features, str):
        squares = F.aggregate(feature_array(features), F.lit(0.0), lambda s, v: s + v * v)
    else:
        squares = F.expr(" + ".join(f"{x} * {x}" for x in map(required_sql, features)))
    return F.sqrt(squares)


def sq_distance(features: Features, center: Sequence[float]) -> Column:
    """Squared Euclidean distance of a row to a fixed point."""
    if isinstance(features, str):
        point = F.array(*[F.expr(double_literal(v)) for v in center])
        squares = F.zip_with(feature_array(features, len(center)), point, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)
    terms = [f"({required_sql(f)} - {double_literal(v)})" for f, v in zip(features, center, strict=True)]
    return F.expr(" + ".join(f"{t} * {t}" for t in terms))


def sq_distance_sql(features: Sequence[str], center: Sequence[float]) -> str:
    """The squared distance written out over the columns."""
    terms = []
    for f, v in zip(features, center, strict=True):
        diff = f"({name(f)} - {double_literal(v)})"
        terms.append(f"{diff} * {diff}")
    return " + ".join(terms)


def dot_sql(features: Sequence[str], weights: Sequence[float], start: float | None = None) -> str:
    """``start + sum(feature * weight)``, added from left to right."""
    terms = [] if start is None else [double_literal(start)]
    terms += [f"{name(f)} * {double_literal(w)}" for f, w in zip(features, weights, strict=True)]
    return " + ".join(terms)


def is_narrow(features: Features, rows: int, limit: int | None = None) -> bool:
    """Whether ``rows`` written-out expressions over the features stay compilable."""
    limit = NARROW_TERMS if limit is None else limit
    return not isinstance(features, str) and rows * len(features) <= limit


def best_of_sql(function: str, values: Sequence[str]) -> str:
    """``least`` or ``greatest`` of columns, of which there may be one."""
    return f"{function}({', '.join(values)})" if len(values) > 1 else values[0]


def first_best_sql(values: Sequence[str], best: str) -> str:
    """Index of the first of ``values`` equal to ``best``: ties go to the lowest index."""
    cases = " ".join(f"WHEN {v} = {name(best)} THEN {j}" for j, v in enumerate(values[:-1]))
    return f"CASE {cases} ELSE {len(values) - 1} END" if cases else "0"


def nearest_udf(centers: Sequence[Sequence[float]]):
    """Arrow UDF: array of doubles -> (d, j), distance to and index of the nearest centre."""
    points = np.asarray(centers, dtype="float64")
    attributes = _attribute_reader(points.shape[1])

    def nearest(x: pa.Array) -> pa.Array:
        columns = attributes(x)
        # Running minimum over the centres: memory stays at a few columns.
        best = np.full(len(x), np.inf)
        index = np.zeros(len(x), dtype="int32")
        for j, center in enumerate(points):
            d = np.zeros(len(x))
            for column, v in zip(columns, center):
                diff = column - v
                d += diff * diff
            closer = d < best
            best[closer] = d[closer]
            index[closer] = j
        return pa.StructArray.from_arrays([pa.array(best), pa.array(index)], names=["d", "j"])

    return _arrow(nearest, "struct<d: double, j: int>")


def linear_argmax_udf(weights: Sequence[Sequence[float]], starts: Sequence[float]):
    """Arrow UDF: array of doubles -> index of the largest ``start + x . weights`` row."""
    matrix = np.asarray(weights, dtype="float64")
    first = np.asarray(starts, dtype="float64")
    attributes = _attribute_reader(matrix.shape[1])

    def argmax(x: pa.Array) -> pa.Array:
        columns = attributes(x)
        best = np.full(len(x), -np.inf)
        index = np.zeros(len(x), dtype="int32")
        for j, (start, row) in enumerate(zip(first, matrix)):
            score = np.full(len(x), start)
            for column, w in zip(columns, row):
                score += column * w
            better = score > best
            best[better] = score[better]
            index[better] = j
        return pa.array(index)

    return _arrow(argmax, "int")


def linear_udf(weights: Sequence[Sequence[float]]):
    """Arrow UDF: array of doubles -> array with ``x . weights`` for each row of weights."""
    matrix = np.asarray(weights, dtype="float64")
    attributes = _attribute_reader(matrix.shape[1])

    def products(x: pa.Array) -> pa.Array:
        columns = attributes(x)
        out = np.zeros((len(x), len(matrix)))
        # Attribute by attribute, as the written-out form adds.
        for i, column in enumerate(columns):
            term = np.multiply.outer(column, matrix[:, i])
            out = term if i == 0 else out + term
        offsets = pa.array(np.arange(len(x) + 1, dtype="int32") * len(matrix))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return _arrow(products, "array<double>")


def _attribute_reader(width: int):
    """A function from a batch of arrays to one row of numbers per attribute.

    It is made here, not defined in the module, so that it travels with the UDF and
    executors do not need this package.
    """

    def attributes(x: pa.Array) -> np.ndarray:
        flat = x.flatten()
        even = pc.all(pc.equal(pc.list_value_length(x), width)).as_py()
        if x.null_count or flat.null_count or even is False:
            raise ValueError(f"every row needs {width} attributes and none may be NULL")
        values = flat.to_numpy(zero_copy_only=False).reshape(len(x), width)
        if not np.isfinite(values).all():
            raise ValueError("no attribute may be NaN or infinite")
        return np.ascontiguousarray(values.T)

    return attributes


def _arrow(function, return_type: str):
    # The UDF type is inferred from annotations, which must be real types here.
    function.__annotations__ = {"x": pa.Array, "return": pa.Array}
    return F.arrow_udf(function, return_type)
