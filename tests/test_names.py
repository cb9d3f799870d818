"""Columns whose names the operators use inside, or that hold dots; CSV headers that repeat."""

import pytest
from pyspark.sql import functions as F

from tableprofile.operators import checks, distribution, frequency, metrics, modeling
from tableprofile.sources.csv import read_csv

NAMES = ["p", "n", "c", "bin", "k0", "bucket", "score", "a.b", "y", "digest", "row", "key"]


def named(spark, name):
    """(name, label, probability) with other columns called like internal ones."""
    rows = [(i % 3, i % 2, i / 40, "t" * 100) for i in range(40)] + [(0, 0, 0.0, "t" * 100)]
    return spark.createDataFrame(rows, f"`{name}` int, label int, probability double, words string")


@pytest.mark.parametrize("name", NAMES)
def test_any_name(spark, name):
    df = named(spark, name)
    areas = metrics.roc_auc(df, "label", "probability", [name])
    assert areas.columns == [name, "roc_auc"] and areas.count() == 3
    again = checks.duplicate_rows(df).collect()
    assert [(r[0], r[1], r["n_copies"]) for r in again] == [(0, 0, 2)] and checks.has_duplicates(df).first()[0]
    means = distribution.bin_means(df, name, [name], [-1, 0, 1, 2], ["zero", "one", "two"])
    assert [r[1] for r in means.collect()] == [0.0, 1.0, 2.0]
    unique = df.withColumn("id", F.monotonically_increasing_id())
    split = modeling.stratified_split(unique, name, "id")
    assert split.columns == [*unique.columns, "split"] and split.count() == 41
    values = frequency.distinct_values(df, name, order_by="probability", place="least").collect()
    assert [(r[0], r["least"]) for r in values] == [(0, 0.0), (1, 1 / 40), (2, 2 / 40)]


def test_repeated_keys_at_a_cut(spark):
    df = spark.createDataFrame([(i % 4, 1) for i in range(100)], "id int, label int")
    with pytest.raises(Exception, match="not unique"):
        modeling.stratified_split(df, "label", "id").collect()


def test_missing_values_are_equal_copies(spark):
    rows = [(None, 1.0), (None, 1.0), ("a", float("nan")), ("a", None), ("b", 0.0), ("b", -0.0), ("c", 1.0)]
    got = checks.duplicate_rows(spark.createDataFrame(rows, "t string, x double")).collect()
    assert sorted((r["t"] or "", r["x"], r["n_copies"]) for r in got if r["x"] is not None) == [("", 1.0, 2), ("b", 0.0, 2)]
    assert [(r["t"], r["n_copies"]) for r in got if r["x"] is None] == [("a", 2)]


@pytest.mark.parametrize("header, names", [("a,a,b", ["a", "a.1", "b"]), ("id,ID,x", ["id", "ID.1", "x"])])
def test_headers_that_repeat(spark, tmp_path, header, names):
    (tmp_path / "t.csv").write_text(f"{header}\n1,2,3\n4,5,NA\n")
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == names and sorted(map(tuple, df.collect())) == [(1, 2, 3), (4, 5, None)]


def test_empty_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "t.csv"))
