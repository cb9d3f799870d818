import pytest
from pyspark.sql import functions as F

from tableprofile.operators import profile as P
from tableprofile.operators import quality as Q
from tableprofile.plans.report import missing_from_summary


def test_flags_of_readings(readings):
    flags = Q.quality_flags(readings).first()
    assert (flags["n_rows"], flags["n_cols"], flags["max_missing_share"]) == (5, 3, 0.2)
    assert flags["too_few_rows"] and not flags["too_many_columns"] and not flags["too_many_missing"]
    assert not flags["has_constant_columns"] and not flags["has_high_cardinality_categoricals"]
    assert flags["quality_score"] == pytest.approx(0.6, abs=1e-12)
    assert not Q.quality_verdict(Q.quality_flags(readings)).first()["ok_for_model"]


def test_constant_column_sits_on_the_limit(one_unit):
    verdict = Q.quality_verdict(Q.quality_flags(one_unit)).first()
    assert verdict["constant_columns_list"] == ["unit"]
    assert verdict["quality_score"] == 0.7000000000000001
    assert verdict["ok_for_model"] and verdict["message"] == Q.READY


def test_mostly_distinct_text(mostly_distinct):
    flags = Q.quality_flags(mostly_distinct).first()
    assert flags["high_cardinality_categoricals"] == ["code"]
    assert not flags["too_few_rows"]
    assert flags["quality_score"] == pytest.approx(0.85, abs=1e-12)


@pytest.mark.parametrize("fixture", ["readings", "one_unit", "mostly_distinct", "empty"])
def test_both_ways_to_the_flags_agree(request, fixture):
    df = request.getfixturevalue(fixture)
    assert Q.quality_flags(df).first() == Q.quality_flags_from_summary(P.column_summary(df)).first()


def test_empty_table(empty):
    flags = Q.quality_flags(empty).first()
    assert flags["constant_columns_list"] == ["number", "word", "flag"]
    assert flags["max_missing_share"] == 0.0 and not flags["has_high_cardinality_categoricals"]
    assert flags["quality_score"] == pytest.approx(0.5, abs=1e-12)


def test_all_missing_numeric_column_is_constant(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "x double, y double")
    assert Q.quality_flags(df).first()["constant_columns_list"] == ["x"]


def test_long_texts_are_told_apart(spark):
    df = spark.range(200).select(F.concat(F.repeat(F.lit("x"), 500), F.col("id").cast("string")).alias("t"))
    assert Q.quality_flags(df).first()["high_cardinality_categoricals"] == ["t"]


def test_report_and_boolean_flags(readings):
    report = Q.quality_report(readings).first()
    assert report["flags"]["too_few_rows"] is True and len(report["flags"]) == 5
    assert Q.boolean_flags(Q.quality_flags(readings)).first()["flags"] == report["flags"]
    assert 0.0 <= report["quality_score"] <= 1.0


def test_missing_from_summary(readings):
    assert missing_from_summary(P.column_summary(readings)).collect() == P.missing_table(readings).collect()


PROFILES = [
    (10000, 10, 0.1, 3, 4, 0.9, True),
    (999, 10, 0.0, 3, 4, 0.8, True),
    (1000, 101, 0.0, 0, 4, 0.8, True),
    (5000, 10, 0.6, 3, 0, 0.35, False),
    (10, 200, 1.0, 0, 5, 0.0, False),
]


def test_profiles(spark):
    rows = [(i, *p[:5]) for i, p in enumerate(PROFILES)]
    scored = Q.score_profiles(spark.createDataFrame(rows, "i int, " + Q.PROFILE_SCHEMA)).orderBy("i").collect()
    for row, expected in zip(scored, PROFILES):
        assert row["quality_score"] == pytest.approx(expected[5], abs=1e-12)
        assert row["ok_for_model"] is expected[6]
    assert scored[1]["flags"] == {
        "too_few_rows": True, "too_many_columns": False, "too_many_missing": False,
        "no_numeric_columns": False, "no_categorical_columns": False,
    }


def test_profile_validation(spark):
    rows = [(1, 1, 0.0, 0, 0), (-1, 1, 0.0, 0, 0), (1, 1, 1.5, 0, 0), (1, 1, None, 0, 0), (1, 1, 1.0, -1, 0)]
    df = spark.createDataFrame(rows, Q.PROFILE_SCHEMA)
    assert [r["is_valid"] for r in Q.validate_profiles(df).collect()] == [True, False, False, False, False]
