"""Profiles merged from parts against profiles of the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprofile.operators import profile as P
from tableprofile.operators import quality as Q
from tableprofile.operators import states as S


@pytest.fixture(scope="module")
def whole(spark):
    rng = np.random.default_rng(6)
    rows = [
        (i, f"day{i % 7}" if i < 6990 else None, None if i % 13 == 0 else float(1e9 + rng.normal()), float("nan") if i % 5 == 0 else float(i % 50), f"user {i}" + "x" * (i % 200), "same", None, i % 3 == 0)
        for i in range(7000)
    ]
    return spark.createDataFrame(rows, "id long, day string, big double, gap double, text string, constant string, empty int, flag boolean").cache()


def check(summary, df):
    want = {r["name"]: r for r in P.column_summary(df).collect()}
    got = {r["name"]: r for r in summary.collect()}
    assert list(got) == list(want)
    for name, w in want.items():
        g = got[name]
        for exact in ("dtype", "non_null", "missing", "missing_share", "is_numeric", "min", "max"):
            assert g[exact] == w[exact], (name, exact)
        for close in ("mean", "std"):
            assert g[close] == (None if w[close] is None else pytest.approx(w[close], rel=1e-7)), (name, close)
        assert g["is_constant"] == (w["unique"] <= 1)
        assert abs(g["approx_unique"] - w["unique"]) <= 0.06 * w["unique"]


def test_parts_merge_to_the_whole(whole):
    merged = S.merge_states(S.profile_states(whole, "day"))
    check(S.state_summary(merged), whole)
    points = {r["name"]: r["approx_quantiles"] for r in S.state_summary(merged, [0.1, 0.5, 0.9]).collect()}
    for p, x in zip((0.1, 0.5, 0.9), points["id"]):
        assert abs(x / 7000 - p) < 0.02
    assert points["text"] is None and points["empty"] is None
    flags = S.state_flags(merged).first().asDict()
    want = Q.quality_flags(whole).first().asDict()
    for name, value in want.items():
        assert flags[name] == (pytest.approx(value, rel=0.06) if isinstance(value, float) else value), name


def test_merging_in_steps(whole):
    """A merged state merges again, in any grouping."""
    parts = S.profile_states(whole, "day")
    first = S.merge_states(parts.where("part in ('day0', 'day1')"), "a")
    rest = S.merge_states(parts.where("part is null or part not in ('day0', 'day1')"), "b")
    check(S.state_summary(S.merge_states(first.unionByName(rest))), whole)


def test_stored_parts_are_replaced_and_never_read_again(spark, whole, tmp_path):
    path = str(tmp_path / "states")
    old = whole.where("day in ('day0', 'day1', 'day2')")
    S.write_states(S.profile_states(old, "day"), path)
    # A part comes again with other rows, and new ones arrive; the old rows are not at hand any more.
    corrected = whole.where("day = 'day1' and id % 2 = 0")
    S.write_states(S.profile_states(corrected.unionByName(whole.where("day = 'day5' or day is null")), "day"), path)
    now = old.where("day <> 'day1'").unionByName(corrected).unionByName(whole.where("day = 'day5' or day is null"))
    merged = S.merge_states(S.read_states(spark, path))
    check(S.state_summary(merged), now)
    assert "day1" in {r["part"] for r in S.read_states(whole, path).collect()}


def test_a_part_without_a_column(spark):
    a = S.profile_states(spark.createDataFrame([(1, "x"), (2, "y")], "n int, t string"), F.lit("a"))
    b = S.profile_states(spark.createDataFrame([(5,)], "n int"), F.lit("b"))
    got = {r["name"]: r for r in S.state_summary(S.merge_states(a.unionByName(b))).collect()}
    assert (got["n"]["non_null"], got["n"]["missing"], got["n"]["max"]) == (3, 0, 5.0)
    assert (got["t"]["non_null"], got["t"]["missing"], got["t"]["approx_unique"]) == (2, 1, 2)
    c = S.profile_states(spark.createDataFrame([("5",)], "n string"), F.lit("c"))
    with pytest.raises(Exception, match="disagree about the type of n"):
        S.merge_states(a.unionByName(c)).collect()


def test_empty_table(spark):
    empty = S.profile_states(spark.createDataFrame([], "n int"), F.lit("a"))
    assert empty.count() == 0 and S.state_summary(S.merge_states(empty)).count() == 0
