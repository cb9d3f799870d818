import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprofile.functions import arrays as A


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([([0, 1, 2, 3, 4, 5], [0, 1, 2], [3, 4, 5], [])], "m array<int>, a array<int>, b array<int>, e array<int>")


def value(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_creation(numbers):
    assert value(numbers, A.array_zeros(6)) == [0.0] * 6
    assert value(numbers, A.array_ones(6)) == [1.0] * 6
    assert value(numbers, A.array_range(0, 6)) == [0, 1, 2, 3, 4, 5]
    assert value(numbers, A.array_range(3, 3)) == []


def test_shape_and_index(numbers):
    grid = A.array_reshape(F.col("m"), 2, 3)
    assert value(numbers, grid) == [[0, 1, 2], [3, 4, 5]]
    assert value(numbers, A.array_shape(grid, 2)) == [2, 3]
    assert value(numbers, A.array_item(grid, 0, 2)) == 2
    assert value(numbers, A.array_item(grid, 5, 2)) is None
    assert value(numbers, A.array_slice(A.array_item(grid, 1), 0, 3)) == [3, 4, 5]
    assert value(numbers, A.array_slice(F.col("m"), 1, 4)) == [1, 2, 3]
    assert value(numbers, A.array_reshape(F.col("m"), 4, 2)) is None


def test_math(numbers):
    assert value(numbers, A.array_sum(F.col("a"), F.col("b"))) == [3, 5, 7]
    assert value(numbers, A.array_product(F.col("a"), F.col("b"))) == [0, 4, 10]
    assert value(numbers, A.array_mean(F.col("b"))) == 4.0
    assert value(numbers, A.array_std(F.col("a"))) == pytest.approx(np.std([0, 1, 2]), abs=1e-15)
    assert value(numbers, A.array_mean(F.col("e"))) is None
    assert value(numbers, A.array_std(F.col("e"))) is None
