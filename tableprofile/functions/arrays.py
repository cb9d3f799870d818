"""Array columns: construction, reshaping, indexing, element-wise math, statistics.

Indexes are 0-based and slices exclude their end. Everything is a row-local expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def array_ones(n: int) -> Column:
    return F.array_repeat(F.lit(1.0), n)


def array_range(start: int, stop: int) -> Column:
    """start, start + 1, ..., stop - 1."""
    if stop <= start:
        return F.array().cast("array<int>")
    return F.sequence(F.lit(start), F.lit(stop - 1))


def array_item(array: Column, *index: int) -> Column:
    """Element at an index per dimension; NULL outside the array."""
    for position in index:
        array = F.get(array, F.lit(position))
    return array


def array_slice(array: Column, start: int, stop: int) -> Column:
    return F.slice(array, start + 1, max(stop - start, 0))


def array_reshape(array: Column, rows: int, columns: int) -> Column:
    """1-D to 2-D, row by row; NULL unless the array has exactly rows x columns elements."""
    grid = F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)),
        lambda row: F.slice(array, row * F.lit(columns) + F.lit(1), F.lit(columns)),
    )
    return F.when(F.size(array) == rows * columns, grid)


def array_shape(array: Column, dimensions: int = 1) -> Column:
    """Length per dimension of a rectangular array, as an array of ints."""
    sizes = []
    for _ in range(dimensions):
        sizes.append(F.size(array))
        array = F.get(array, F.lit(0))
    return F.array(*sizes)


def array_sum(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: x + y)


def array_product(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: x * y)


def array_mean(array: Column) -> Column:
    """Mean as a double; NULL for an empty array."""
    total = F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.try_divide(total, F.size(array).cast("double"))


def array_std(array: Column) -> Column:
    """Population standard deviation (divisor n), around the exact mean."""
    spread = F.aggregate(
        array,
        F.struct(F.lit(0.0).alias("squares"), array_mean(array).alias("mean")),
        lambda acc, x: F.struct(
            (acc["squares"] + (x.cast("double") - acc["mean"]) * (x.cast("double") - acc["mean"])).alias("squares"),
            acc["mean"].alias("mean"),
        ),
        lambda acc: acc["squares"],
    )
    return F.sqrt(F.try_divide(spread, F.size(array).cast("double")))
