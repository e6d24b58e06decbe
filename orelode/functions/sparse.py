"""Sparse vectors: a struct of size, ascending indices and their values.

A column of them is a batch of rows in compressed form (CSR) when it comes to Python, so the
kernels work on the entries of a whole batch at once: two batches are merged by (row, index),
which both are sorted by. Nothing ever becomes a dense row. A null vector gives null; vectors
of different sizes in one row raise, and so do unordered indices and numbers that are not finite
where a vector is made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPARSE = "struct<size: int, indices: array<int>, values: array<double>>"


def sparse_vector(size: int, indices: str | Column, values: str | Column) -> Column:
    """A vector of ``size`` attributes from its stored ones. A null array gives a null vector.

    Indices must ascend from 0 and be below ``size``, values must be finite; a stored value may be 0.
    """

    def make(x: pa.Array, y: pa.Array) -> pa.Array:
        valid = pc.and_(pc.is_valid(x), pc.is_valid(y))
        x, y = (pc.if_else(valid, a, pa.scalar([], a.type)) for a in (x, y))
        counts = pc.list_value_length(x).to_numpy(zero_copy_only=False)
        index, value = x.flatten(), y.flatten()
        good = not index.null_count and not value.null_count and pc.all(pc.equal(pc.list_value_length(x), pc.list_value_length(y))).as_py() is not False
        index, value = (a.to_numpy(zero_copy_only=False) for a in (index, value))
        if good and len(index):
            first = np.zeros(len(index) + 1, bool)
            first[np.cumsum(counts)] = first[0] = True
            good = (first[1:-1] | (index[1:] > index[:-1])).all() and index.min() >= 0 and index.max() < size and np.isfinite(value).all()
        if not good:
            raise ValueError(f"a vector needs ascending indices below {size}, and as many finite values")
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(a)) for a in (index, value)]
        sizes = pa.array(np.full(len(counts), size, np.int32))
        return pa.StructArray.from_arrays([sizes, *lists], names=["size", "indices", "values"], mask=pc.invert(valid))

    pair = (F.col(c) if isinstance(c, str) else c for c in (indices, values))
    return _arrow(make, SPARSE, 2)(*(c.cast(t) for c, t in zip(pair, ("array<int>", "array<double>"), strict=True)))


def from_dense(values: str | Column) -> Column:
    """The vector of an array of doubles; zeros are not stored. Nulls and numbers that are not finite raise."""

    def make(x: pa.Array) -> pa.Array:
        valid = pc.is_valid(x).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
        flat = x.flatten()
        value = flat.to_numpy(zero_copy_only=False)
        if flat.null_count or not np.isfinite(value).all():
            raise ValueError("no attribute may be NULL, NaN or infinite")
        starts = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(x)), sizes)
        kept = np.flatnonzero(value)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(x)))]), pa.int32())
        index = (kept - starts[row[kept]]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(a)) for a in (index, value[kept])]
        return pa.StructArray.from_arrays([pa.array(sizes.astype(np.int32)), *lists], names=["size", "indices", "values"], mask=pa.array(~valid))

    column = F.col(values) if isinstance(values, str) else values
    return _arrow(make, SPARSE, 1)(column.cast("array<double>"))


def counted(size: int, items: str | Column) -> Column:
    """How often each whole number from 0 below ``size`` is in an array, as a vector; a null array has none."""

    def count(x: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
        item = x.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(item) and not (0 <= item.min() and item.max() < size):
            raise ValueError(f"items must be from 0 below {size}")
        keys, n = np.unique(np.repeat(np.arange(len(x)), sizes) * size + item, return_counts=True)
        offsets = pa.array(np.searchsorted(keys, np.arange(len(x) + 1) * size), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(a)) for a in ((keys % size).astype(np.int32), n.astype(np.float64))]
        return pa.StructArray.from_arrays([pa.array(np.full(len(x), size, np.int32)), *lists], names=["size", "indices", "values"])

    return _arrow(count, SPARSE, 1)(items)


def to_dense(vector: str | Column) -> Column:
    """The array of all attributes; only for vectors of few."""
    read = _reader()

    def dense(x: pa.Array) -> pa.Array:
        n, valid, size, row, index, value = read(x)
        offsets = np.concatenate([[0], np.cumsum(size)])
        flat = np.zeros(int(offsets[-1]))
        flat[offsets[row] + index] = value
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        return pc.if_else(pa.array(valid), lists, pa.nulls(n, lists.type))

    return _arrow(dense, "array<double>", 1)(vector)


def dot_sparse(a: str | Column, b: str | Column) -> Column:
    """The sum of products of the attributes that both vectors store."""
    both = _merged()

    def dot(x: pa.Array, y: pa.Array) -> pa.Array:
        n, valid, (row, left, right), _ = both(x, y)
        return pa.array(np.bincount(row, left * right, n), mask=~valid)

    return _arrow(dot, "double", 2)(a, b)


def distance_sparse(a: str | Column, b: str | Column) -> Column:
    """The squared distance: no cancellation, as every attribute's difference is squared."""
    both = _merged()

    def distance(x: pa.Array, y: pa.Array) -> pa.Array:
        n, valid, (row, left, right), alone = both(x, y)
        total = np.bincount(row, (left - right) ** 2, n)
        for own, value in alone:
            total += np.bincount(own, value * value, n)
        return pa.array(total, mask=~valid)

    return _arrow(distance, "double", 2)(a, b)


def norm_sparse(vector: str | Column) -> Column:
    """Euclidean length; stays in the JVM."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.sqrt(F.aggregate(column["values"], F.lit(0.0), lambda s, v: s + v * v))


def dot_dense(vector: str | Column, weights: np.ndarray) -> Column:
    """The product with a dense vector that the caller holds."""
    read, weights = _reader(), np.asarray(weights, np.float64)

    def dot(x: pa.Array) -> pa.Array:
        n, valid, size, row, index, value = read(x)
        if (size[valid] != len(weights)).any():
            raise ValueError(f"vectors need {len(weights)} attributes")
        return pa.array(np.bincount(row, weights[index] * value, n), mask=~valid)

    return _arrow(dot, "double", 1)(vector)


def scaled(vector: str | Column, factors: np.ndarray) -> Column:
    """Every stored value times the factor of its attribute."""
    read, factors = _reader(), np.asarray(factors, np.float64)

    def scale(x: pa.Array) -> pa.Array:
        n, valid, size, _, index, value = read(x)
        if (size[valid] != len(factors)).any():
            raise ValueError(f"vectors need {len(factors)} attributes")
        sizes, indices, _ = x.flatten()
        counts = pc.fill_null(pc.list_value_length(indices), 0).to_numpy()
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (index.astype(np.int32), value * factors[index])]
        return pa.StructArray.from_arrays([sizes, *lists], names=["size", "indices", "values"], mask=pa.array(~valid))

    return _arrow(scale, SPARSE, 1)(vector)


def nearest_sparse_udf(shared, norms: np.ndarray):
    """Arrow UDF: vector -> (d, j), squared distance to and index of the nearest centre; ties go to the lowest.

    ``shared`` is a broadcast of the centres, attributes x centres.
    """
    read, norms = _reader(), np.asarray(norms, np.float64)

    def nearest(x: pa.Array) -> pa.Array:
        n, valid, size, row, index, value = read(x)
        columns = shared.value
        if not valid.all() or (size != len(columns)).any():
            raise ValueError(f"every row needs a vector of {len(columns)} attributes")
        own = np.bincount(row, value * value, n)
        d = np.tile(norms, (n, 1)) + own[:, None]
        # Some entries at a time, so that entries x centres stay small.
        edges = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
        step, begin = max(1, (1 << 21) // max(1, len(norms))), 0
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + step, "right")) - 1)
            a, b = edges[begin], edges[end]
            products = columns[index[a:b]] * value[a:b, None]
            filled = begin + np.flatnonzero(np.diff(edges[begin : end + 1]))
            if len(filled):
                d[filled] -= 2 * np.add.reduceat(products, edges[filled] - a, axis=0)
            begin = end
        j = d.argmin(1) if n else np.zeros(0, np.int64)
        best = np.maximum(d[np.arange(n), j], 0.0)
        return pa.StructArray.from_arrays([pa.array(best), pa.array(j.astype(np.int32))], names=["d", "j"])

    return _arrow(nearest, "struct<d: double, j: int>", 1)


def _reader():
    """A function from a batch of vectors to its entries. Made here, so that it travels with the UDF."""

    def entries(x: pa.Array):
        """Rows, which are not null, their sizes, and row, index and value of every entry."""
        sizes, indices, values = x.flatten()
        valid = pc.is_valid(x).to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(indices), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(x)), counts)
        index = indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return len(x), valid, pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), row, index, values.flatten().to_numpy(zero_copy_only=False)

    return entries


def _merged():
    """A function from two batches to their common entries (row, value, value) and those of one side (row, value)."""
    read = _reader()

    def merge(x: pa.Array, y: pa.Array):
        n, valid, size, row, index, value = read(x)
        _, other_valid, other_size, other_row, other_index, other_value = read(y)
        valid = valid & other_valid
        if (size[valid] != other_size[valid]).any():
            raise ValueError("vectors of different sizes")
        width = int(max(size.max(initial=0), other_size.max(initial=0), 1))
        a, b = row * width + index, other_row * width + other_index
        place = np.searchsorted(b, a)
        match = place < len(b)
        match[match] = b[place[match]] == a[match]
        other = np.ones(len(b), bool)
        other[place[match]] = False
        common = row[match], value[match], other_value[place[match]]
        return n, valid, common, [(row[~match], value[~match]), (other_row[other], other_value[other])]

    return merge


def _arrow(function, return_type: str, arguments: int):
    # The UDF type is inferred from annotations, which must be real types here.
    function.__annotations__ = {**dict.fromkeys(["x", "y"][:arguments], pa.Array), "return": pa.Array}
    return F.arrow_udf(function, return_type)
