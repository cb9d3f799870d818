import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tableprofile.operators import relations as R


def wide(df):
    matrix = R.correlation_matrix(df).toPandas().set_index("column")
    return matrix


def test_readings(readings):
    matrix = wide(readings)
    assert list(matrix.columns) == ["temp", "rain"]
    assert matrix.loc["temp", "rain"] == pytest.approx(1.0)


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e5, 1e6, 1e7])
def test_offset_where_the_partner_is_present(spark, offset):
    """The same answer whatever the offset and the number of further columns."""
    rng = np.random.default_rng(9)
    x, there = rng.integers(0, 50, 5000).astype(float), rng.random(5000) < 0.02
    y = np.where(there, 2 * x + rng.integers(0, 40, 5000), np.nan)
    want = pd.Series(x).corr(pd.Series(y))
    for width in (2, 5, 20):
        more = {f"m{i}": rng.random(5000) for i in range(width - 2)}
        data = pd.DataFrame({"x": x + there * offset, "y": y, **more})
        frame = spark.createDataFrame(data).repartition(7)
        found = {(r[0], r[1]): r[2] for r in R.correlation_long(frame).collect()}
        assert found["x", "y"] == found["y", "x"] == pytest.approx(want, abs=1e-9)


def test_infinity_has_no_correlation(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, float("inf"), 2.0), (3.0, 5.0, 4.0), (4.0, 1.0, 3.0)]
    found = {(r[0], r[1]): r[2] for r in R.correlation_long(spark.createDataFrame(rows, "a double, b double, c double")).collect()}
    assert found["a", "b"] is None and found["b", "b"] is None and found["b", "c"] is None and found["a", "c"] == pytest.approx(0.8)


def test_against_pandas(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame(rng.normal(size=(400, 6)), columns=list("abcdef"))
    data["b"] = data["a"] * 2 + data["b"] * 0.1 + 1e6
    data.loc[rng.random(400) < 0.3, "c"] = np.nan
    data.loc[rng.random(400) < 0.5, "d"] = np.nan
    data["e"] = 1.1
    data["f"] = np.where(data["c"].isna(), data["f"], 3.3)
    frame = spark.createDataFrame(data.astype(object).where(data.notna(), None), ", ".join(f"{c} double" for c in data))
    ours = wide(frame).astype(float)
    theirs = data.corr()
    # A pair that is constant within its common rows is noise in pandas, missing here.
    assert np.isnan(ours.loc["c", "f"])
    theirs.loc["c", "f"] = theirs.loc["f", "c"] = np.nan
    np.testing.assert_allclose(ours.to_numpy(), theirs.to_numpy(), atol=1e-9)
    np.testing.assert_array_equal(ours.to_numpy(), ours.to_numpy().T)


def test_edges(spark, empty):
    assert R.correlation_long(empty).count() == 0
    assert R.correlation_matrix(empty).count() == 0
    words = spark.createDataFrame([("a",)], "x string")
    assert R.correlation_long(words).count() == 0
    assert R.correlation_matrix(words).count() == 0
    one = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert R.correlation_long(one, min_columns=2).count() == 0
    assert R.correlation_long(one).first()["correlation"] == 1.0
    disjoint = spark.createDataFrame([(1.0, None), (2.0, None), (None, 3.0), (None, 5.0)], "x double, y double")
    rows = {(r[0], r[1]): r[2] for r in R.correlation_long(disjoint).collect()}
    assert rows == {("x", "x"): 1.0, ("y", "y"): 1.0, ("x", "y"): None, ("y", "x"): None}


def test_scatter(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (1, None, "a"), (3, 4.0, None)], "p int, r double, c string")
    assert [tuple(r) for r in R.scatter_points(df, "p", "r", "c").collect()] == [(1, 2.0, "a")]
    assert R.scatter_points(df.withColumn("r", F.lit(float("nan"))), "p", "r", "c").count() == 0


@pytest.mark.parametrize("tile", [1, 4, 5, 11])
def test_tiles(spark, monkeypatch, tile):
    """The same numbers whatever the tile, also where the last block is smaller."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 11)) @ rng.normal(size=(11, 11)) + 100
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 7.0
    names = [f"c{i}" for i in range(11)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(3)
    monkeypatch.setattr(R, "TILE", tile)
    found = {(r["column_x"], r["column_y"]): r["correlation"] for r in R.correlation_long(df).collect()}
    want = pd.DataFrame(x, columns=names).corr()
    assert len(found) == 121
    for (a, b), value in found.items():
        assert value is None if "c3" in (a, b) else value == pytest.approx(want.loc[a, b], abs=1e-12)


def test_wide_table_in_tiles_of_bounded_size(spark):
    """2,000 columns: every tile reads at most two blocks of columns, so no task holds more than TILE by TILE pairs."""
    width = 2000
    df = spark.range(40, numPartitions=2).select(*[F.sin(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(width)])
    values = df.select(*[F.col(f"c{i}").alias(f"v{i}") for i in range(width)])
    blocks = [range(i, min(i + R.TILE, width)) for i in range(0, width, R.TILE)]
    last = R._tile(values, blocks[0], blocks[-1])
    assert len(blocks) == 8 and last.count() == 2 * len(blocks[0]) * len(blocks[-1])
    scanned = last._jdf.queryExecution().optimizedPlan().toString()
    assert "v300" not in scanned and "v1999" in scanned
    row = last.where("i = 5 and j = 1999").groupBy("i", "j").agg(F.sum("n").alias("n")).first()
    assert row["n"] == 40
