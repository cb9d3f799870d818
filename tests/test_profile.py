import math

import pytest
from pyspark.sql import functions as F

from tableprofile.functions.columns import (
    categorical_columns,
    clamp_unit,
    feature_columns,
    is_missing,
    normalize_missing,
    numeric_columns,
    summary_numeric_columns,
    text_key,
)
from tableprofile.operators import profile as P


def by_name(df, key="name"):
    return {row[key]: row for row in df.collect()}


def test_summary_of_readings(readings):
    rows = by_name(P.column_summary(readings))
    assert list(rows) == ["temp", "rain", "place"]
    temp, rain, place = rows["temp"], rows["rain"], rows["place"]
    assert (temp["non_null"], temp["missing"], temp["missing_share"], temp["unique"]) == (4, 1, 0.2, 4)
    assert (temp["min"], temp["max"], temp["mean"], temp["std"]) == (2.0, 8.0, 5.0, pytest.approx((20 / 3) ** 0.5, abs=1e-12))
    assert (rain["missing"], rain["unique"], rain["mean"]) == (0, 5, 17.4)
    assert rain["std"] == pytest.approx(77.8**0.5, abs=1e-12)
    assert (place["dtype"], place["unique"], place["is_numeric"], place["mean"]) == ("string", 2, False, None)
    assert sorted(place["example_values"]) == ["coast", "hill"]
    assert rain["example_values"] == ["8", "12", "16"]


def test_profile_and_schema(readings):
    assert P.dataset_profile(readings).first().asDict() == {"n_rows": 5, "n_cols": 3}
    assert [tuple(r) for r in P.schema_table(readings).collect()] == [
        (0, "temp", "double", 4), (1, "rain", "bigint", 5), (2, "place", "string", 4),
    ]
    assert "example_values" not in P.flatten_summary(P.column_summary(readings)).columns


def test_examples_in_order_of_appearance(spark):
    df = spark.createDataFrame([(3, "x"), (1, "z"), (2, "z"), (4, "y"), (5, "w")], "place int, word string")
    rows = P.column_summary(df, order_by="place").where("name = 'word'").first()
    assert rows["example_values"] == ["z", "x", "y"]
    assert [r["value"] for r in P.example_values(df, 2, "place").where("column = 'word'").orderBy("rank").collect()] == ["z", "x"]


def test_examples_of_long_texts_come_back_whole(spark):
    long = ["a" * 100, "b" * 5000, "sha256:" + "0" * 64]
    df = spark.createDataFrame([(t,) for t in long + long + ["short", None]], "text string")
    row = P.column_summary(df, example_values=10).first()
    assert row["unique"] == 4
    assert sorted(row["example_values"]) == sorted([*long, "short"])


@pytest.mark.parametrize("n", [1, 3, 64, 65, 2000])
def test_examples_among_many_values(spark, n):
    df = spark.range(3000).select((F.col("id") % 1500).alias("i"), F.concat(F.lit("w"), F.col("id") % 1500).alias("w"), (3000 - F.col("id")).alias("place"))
    found = P.example_values(df, n).collect()
    numbers = [r["value"] for r in sorted(found, key=lambda r: r["rank"]) if r["column"] == "i"]
    assert numbers == [str(i) for i in range(min(n, 1500))]
    words = {r["value"] for r in found if r["column"] == "w"}
    assert len(words) == min(n, 1500)
    seen = P.example_values(df, n, order_by="place").where("column = 'w'").collect()
    assert [r["value"] for r in sorted(seen, key=lambda r: r["rank"])] == [f"w{1499 - i}" for i in range(min(n, 1500))]


def test_text_key_keeps_texts_apart(spark):
    texts = ["", "a", "x" * 64, "x" * 65, "x" * 66, "sha256:" + "f" * 64]
    keys = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text_key(F.col("t"))).collect()]
    assert len(set(keys)) == len(texts)
    assert keys[:3] == texts[:3]


def test_typed_examples_and_distinct(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (true, date'2020-01-02', timestamp'2020-01-02 03:04:05', timestamp_ntz'2021-10-31 02:30:00', 1.5BD, array(1, 2), X'01', 0.1F, 0.0D),
          (false, date'2019-01-02', timestamp'2020-01-02 03:04:06', timestamp_ntz'2021-10-31 03:30:00', 1.5BD, array(1, 2), X'02', 0.1F, -0.0D),
          (null, null, null, null, null, null, null, null, double('NaN'))
        AS t(b, d, ts, nt, dec, arr, bin, f, zero)""")
    rows = by_name(P.column_summary(df))
    assert {n: r["unique"] for n, r in rows.items()} == {
        "b": 2, "d": 2, "ts": 2, "nt": 2, "dec": 1, "arr": 1, "bin": 2, "f": 1, "zero": 1,
    }
    assert all(r["missing"] == 1 for r in rows.values())
    assert rows["b"]["example_values"] == ["false", "true"]
    assert rows["d"]["example_values"] == ["2019-01-02", "2020-01-02"]
    assert rows["ts"]["example_values"][0] == "2020-01-02 03:04:05"
    assert rows["f"]["example_values"] == ["0.1"]
    assert (rows["b"]["min"], rows["b"]["max"], rows["b"]["mean"]) == (0.0, 1.0, 0.5)


def test_edge_tables(spark, empty):
    rows = by_name(P.column_summary(empty))
    assert all((r["non_null"], r["missing"], r["missing_share"], r["unique"], r["min"]) == (0, 0, 0.0, 0, None) for r in rows.values())
    assert all(r["example_values"] == [] for r in rows.values())
    assert P.missing_table(empty).count() == 0
    one = P.column_summary(spark.createDataFrame([(7.0,)], "x double")).first()
    assert (one["mean"], one["std"], one["unique"]) == (7.0, None, 1)
    nothing = P.column_summary(spark.createDataFrame([(None,), (None,)], "x double")).first()
    assert (nothing["missing_share"], nothing["unique"], nothing["mean"]) == (1.0, 0, None)


def test_approximate_unique(spark):
    df = spark.range(10_000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("word"))
    rows = by_name(P.column_summary(df, example_values=0, approximate_unique=0.02))
    assert rows["word"]["unique"] == 7
    assert abs(rows["id"]["unique"] - 10_000) < 1000


def test_many_columns_in_several_aggregates(spark):
    df = spark.range(3).select(*[(F.col("id") % (i % 3 + 1)).alias(f"c{i}") for i in range(230)])
    rows = P.column_summary(df, example_values=1).collect()
    assert [r["ordinal"] for r in rows] == list(range(230))
    assert [r["unique"] for r in rows] == [i % 3 + 1 for i in range(230)]
    assert P.missing_table(df).count() == 230


def test_missing_table(spark, readings):
    rows = [tuple(r) for r in P.missing_table(readings).collect()]
    assert rows == [("temp", 1, 0.2), ("place", 1, 0.2), ("rain", 0, 0.0)]
    assert [tuple(r) for r in P.missing_share(readings).collect()] == [("temp", 0.2), ("rain", 0.0), ("place", 0.2)]
    assert [r["column"] for r in P.problem_columns(readings, 0.2).collect()] == ["temp", "place"]
    assert P.problem_columns(readings).count() == 0
    nan = spark.createDataFrame([(math.nan, 1.0), (2.0, math.nan), (None, math.nan)], "x double, y double")
    assert {r["column"]: r["missing_count"] for r in P.missing_table(nan).collect()} == {"x": 2, "y": 2}
    assert nan.where(is_missing(nan, "x")).count() == 2
    assert normalize_missing(nan).where("x is null").count() == 2


def test_column_classes(spark):
    df = spark.createDataFrame([], "a int, b double, c boolean, d string, e date, f decimal(5,2)")
    assert summary_numeric_columns(df) == ["a", "b", "c", "f"]
    assert numeric_columns(df) == ["a", "b", "f"]
    assert numeric_columns(df, 2) == ["a", "b"]
    assert categorical_columns(df) == ["d"]
    assert feature_columns(df, ["a", "f"]) == ["b", "c", "d", "e"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], ["a.b", "c`d e"])
    rows = by_name(P.column_summary(df))
    assert rows["a.b"]["unique"] == 2 and rows["c`d e"]["missing"] == 1


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(clamp_unit(F.col("x"))).collect()] == [0.0, 0.5, 1.0, None]


@pytest.mark.parametrize("order", [None, "id"])
def test_examples_beside_a_sketch(spark, order):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("n"), F.concat(F.lit("x" * 70), F.col("id") % 40).alias("word"))
    exact = P.column_summary(df, order_by=order).select("name", "example_values").collect()
    sketch = P.column_summary(df, order_by=order, approximate_unique=0.02).select("name", "example_values").collect()
    assert exact == sketch
