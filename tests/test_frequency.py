import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableprofile.functions import small
from tableprofile.operators import frequency as Fr


def test_top_categories_of_readings(readings):
    rows = [tuple(r) for r in Fr.top_categories(readings, top_k=2).collect()]
    assert [(r[0], r[1], r[2], r[3]) for r in rows] == [("place", 1, "hill", 3), ("place", 2, "coast", 1)]
    assert [r[4] for r in rows] == pytest.approx([0.75, 0.25])


def test_share_is_over_the_kept_values(mostly_distinct):
    rows = Fr.top_categories(mostly_distinct, top_k=2).collect()
    assert (rows[0]["value"], rows[0]["count"]) == ("code 7", 11)
    assert rows[1]["value"] == "code 0"
    assert sum(r["share"] for r in rows) == pytest.approx(1.0)


def test_empty_columns_use_up_a_place(spark):
    df = spark.createDataFrame([(None, "x", "y"), (None, "x", None)], "a string, b string, c string")
    assert [r["column"] for r in Fr.top_categories(df, max_columns=2).collect()] == ["b"]
    assert Fr.top_categories(df.select(F.lit(1).alias("n"))).count() == 0


def test_top_beyond_the_group_limit(spark):
    df = spark.range(5000).select(F.format_string("v%04d", F.col("id") % 2500).alias("word"))
    rows = Fr.top_categories(df, top_k=1500).collect()
    assert [r["value"] for r in rows] == [f"v{i:04d}" for i in range(1500)]
    assert all(r["count"] == 2 for r in rows)


def test_counts_and_shares(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in Fr.value_counts(df, "x").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [r["share"] for r in Fr.value_shares(df, "x", 100).collect()] == [50.0, 25.0, 25.0]
    numbers = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (1.0,)], "x double")
    assert [tuple(r) for r in Fr.value_counts(numbers, "x").collect()] == [(1.0, 2)]


def test_distinct_values(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "i int, x string")
    assert [r[0] for r in Fr.distinct_values(df, "x").collect()] == ["a", "b", None]
    assert [r[0] for r in Fr.distinct_values(df, "x", order_by="i").collect()] == ["b", "a", None]


def test_no_window_over_everything(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("x"))
    plan = Fr.value_shares(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("top_k", [2, 5])
def test_long_texts_with_equal_counts(spark, top_k):
    start = "same start " * 20
    texts = [start + "b", start + "a", start + "c", "short", start + "b", "short", "z" * 80, start, None]
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, other string")
    rows = [(r["value"], r["count"]) for r in Fr.top_categories(df, top_k=top_k).where("column = 'text'").orderBy("rank").collect()]
    expected = [(start + "b", 2), ("short", 2), (start, 1), (start + "a", 1), (start + "c", 1), ("z" * 80, 1)]
    assert rows == expected[:top_k]


START = "the same start of every text, longer than a key " * 3


def texts(n, length):
    """Short and long texts, some once, some often, a third of all rows one long text."""
    tail = "x" * length
    return ["hot" + START + tail if i % 3 == 0 else START + tail + str(i % 40) if i % 3 == 1 else START + tail + f"single {i}" if i % 6 == 2 else f"s{i % 7}" for i in range(n)] + [None, "", ""]


def by_count(values):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("limit", [50_000, 3])
def test_frequencies_of_long_texts(spark, monkeypatch, limit):
    """Also where more texts repeat than may be broadcast."""
    monkeypatch.setattr(Fr, "settle", lambda df, maybe_large=False: small.settle(df, limit, maybe_large))
    values = texts(600, 300)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(values)], "i int, t string").repartition(5)
    assert [tuple(r) for r in Fr.value_counts(df, "t").collect()] == by_count(values)
    shares = Fr.value_shares(df, "t").collect()
    assert [(r["value"], r["share"]) for r in shares] == [(v, n / 602) for v, n in by_count(values)]
    assert [r[0] for r in Fr.distinct_values(df, "t").collect()] == [*sorted({v for v in values if v is not None}), None]
    first = {}
    for i, t in enumerate(values):
        first.setdefault(t, i)
    assert [tuple(r) for r in Fr.distinct_values(df, "t", order_by="i", place="at").collect()] == list(first.items())


def exchanged(df):
    """Bytes that the exchanges of a plan have written, after it ran."""
    df.collect()
    total, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            open_.append(node.plan())
        elif name == "ShuffleExchangeExec":
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return total


def test_counting_moves_digests_only(spark):
    sizes = []
    for length in (100, 20_000):
        df = spark.createDataFrame([(t,) for t in texts(300, length)], "value string")
        sizes.append(exchanged(Fr._long_repeats(df, {"count": F.count(F.lit(1))})))
    assert 0 < sizes[0] == sizes[1]


def test_texts_that_occur_once_move_once(spark):
    """Only the order of the result moves them."""
    df = spark.createDataFrame([(START + "y" * 5000 + str(i),) for i in range(200)], "value string")
    assert exchanged(Fr.value_counts(df, "value")) < 1.3 * 200 * (5000 + len(START))


@pytest.mark.parametrize("counters", [8, 40, 4000])
def test_heavy_hitters(spark, counters):
    """Equal to the full count, whether the counters prove the answer or not."""
    rng = random.Random(counters)
    rows = [(f"w{int(rng.paretovariate(0.9))}", f"u{i}", rng.choice("abc"), None, START + str(int(rng.paretovariate(0.8)))) for i in range(4000)]
    df = spark.createDataFrame(rows, "skewed string, each string, few string, none string, long string").repartition(4)
    for k in (1, 5):
        want = [tuple(r) for r in Fr.top_categories(df, top_k=k).collect()]
        assert [tuple(r) for r in Fr.top_categories(df, top_k=k, counters=counters).collect()] == want
    assert Fr.top_categories(df.limit(0), counters=counters).count() == 0


def test_heavy_counters_are_bounded_and_never_too_high(spark):
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(1.0))}" for _ in range(20_000)]
    rows = spark.createDataFrame([(0, w, w) for w in words], "ordinal int, key string, start string").repartition(4)
    found = Fr.heavy_counters(rows, 50).collect()
    missed = sum(r["missed"] for r in found)
    true = Counter(words)
    assert len(found) <= 4 * 50 + 1 and 0 < missed <= 20_000 / 50 * 2
    got = {r["key"]: r["least"] for r in found if r["key"] is not None}
    assert all(true[k] - missed <= got.get(k, 0) <= true[k] for k in true)


def test_heavy_hitters_shuffle_little(spark):
    """Rows that reach the exchange: tasks times counters, not one per distinct value."""
    df = spark.range(30_000, numPartitions=4).select(F.lit(0).alias("ordinal"), F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), "id")).alias("key"), F.lit("").alias("start"))
    assert exchanged(Fr.heavy_counters(df, 20)) < 0.05 * exchanged(df.groupBy("ordinal", "key").count())
