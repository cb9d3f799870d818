import pytest
from pyspark.sql import functions as F

from tableprofile.operators import checks as C
from tableprofile.operators import grouping as G


def people(spark):
    rows = [(1, 25, "RU", 3, 100), (2, 120, "FR", -1, 10), (3, None, "RU", 4, 0), (4, 5, "US", 0, 0), (2, 120, "FR", -1, 10), (5, 30, None, 1, 7)]
    return spark.createDataFrame(rows, "user_id int, age int, country string, purchases int, revenue int")


def rules():
    return {
        "negative_purchases": F.col("purchases") < 0,
        "odd_age": (F.col("age") > 100) | (F.col("age") < 10),
        "free_purchases": (F.col("purchases") > 0) & (F.col("revenue") == 0),
    }


def test_duplicates(spark):
    df = people(spark)
    assert [tuple(r) for r in C.duplicate_rows(df).collect()] == [(2, 120, "FR", -1, 10, 2)]
    assert C.has_duplicates(df).first()[0] is True
    assert C.has_duplicates(df.dropDuplicates()).first()[0] is False
    assert C.duplicate_rows(df.limit(0)).count() == 0
    assert C.has_duplicates(df.limit(0)).first()[0] is False


def test_duplicates_with_missing_and_long_values(spark):
    text = "x" * 1000
    rows = [(None, text), (None, text), (None, text), (1.0, text), (float("nan"), text), (1.0, text + "y"), (2.0, None), (2.0, None)]
    df = spark.createDataFrame(rows, "n double, t string")
    found = {(r["n"], r["t"]): r["n_copies"] for r in C.duplicate_rows(df).collect()}
    assert found == {(None, text): 4, (2.0, None): 2}


def test_rules(spark):
    rows = C.rule_violations(people(spark), rules()).orderBy("user_id").collect()
    assert [(r["user_id"], r["violated_rules"]) for r in rows] == [
        (2, ["negative_purchases", "odd_age"]), (2, ["negative_purchases", "odd_age"]), (3, ["free_purchases"]), (4, ["odd_age"]),
    ]


def test_ranges(spark):
    rows = C.range_check(people(spark), [C.Expected("age", 10, 100), C.Expected("purchases", allowed=[-1, 0, 1, 3, 4])]).collect()
    assert [tuple(r) for r in rows] == [("age", 5.0, 120.0, 3, False), ("purchases", -1.0, 4.0, 0, True)]


def test_types(spark):
    C.require_numeric(people(spark), ["age", "revenue"])
    with pytest.raises(ValueError, match="country"):
        C.require_numeric(people(spark))
    with pytest.raises(ValueError, match="nope"):
        C.require_numeric(people(spark), ["nope"])


def test_groups(spark):
    rows = [tuple(r) for r in G.group_stats(people(spark), "country", ["revenue", "purchases"]).collect()]
    assert rows == [("FR", -2, -1.0, 20, 10.0), ("RU", 7, 3.5, 100, 50.0), ("US", 0, 0.0, 0, 0.0)] or rows == [
        ("FR", 20, 10.0, -2, -1.0), ("RU", 100, 50.0, 7, 3.5), ("US", 0, 0.0, 0, 0.0)
    ]
    assert [r["user_id"] for r in G.head_rows(people(spark), ["user_id", "age"], 3).collect()] == [1, 2, 2]
