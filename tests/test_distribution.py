import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprofile.operators import distribution as D
from tableprofile.operators import quantiles as Q


def numbers(spark, values, partitions=4):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(partitions)


SHAPES = {
    "uniform": lambda rng: rng.random(5000),
    "heavy_tail": lambda rng: np.exp(rng.normal(size=5000) * 20),
    "one_hot_value": lambda rng: np.where(rng.random(5000) < 0.4, 7.0, rng.normal(size=5000) * 100),
    "few_values": lambda rng: rng.integers(0, 4, size=5001).astype(float),
    "constant": lambda rng: np.full(3000, 2.5),
    "negative": lambda rng: -rng.random(4999) * 1e-12,
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_quantiles_with_brackets(spark, monkeypatch, shape):
    monkeypatch.setattr(Q, "SMALL_GROUP", 500)
    values = SHAPES[shape](np.random.default_rng(11))
    df = numbers(spark, values).withColumn("g", F.lit("only"))
    chances = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    names = [f"q{i}" for i in range(len(chances))]
    row = Q.exact_quantiles(df, ["g"], "x", chances, names).first()
    np.testing.assert_allclose([row[n] for n in names], np.percentile(values, [c * 100 for c in chances]), rtol=1e-12)
    assert row["n"] == len(values)


def watch_sorting(monkeypatch):
    """Collects the rows of the largest range that is sorted."""
    sizes, plain = [], Q._sorted
    monkeypatch.setattr(Q, "_sorted", lambda rows, few, keys: sizes.append(few.agg(F.max("n")).first()[0]) or plain(rows, few, keys))
    return sizes


CLUSTERED = {
    "two_far_clusters": lambda rng: np.where(rng.random(6000) < 0.5, rng.random(6000) * 1e-6, 1e9 + rng.random(6000)),
    "nested_scales": lambda rng: 2.0 ** -(rng.random(6000) * 900),
    "widest_range": lambda rng: np.concatenate([rng.random(3000), [-1.7e308, 1.7e308], 1e-300 * rng.random(3000)]),
    "hot_value_in_a_cluster": lambda rng: np.concatenate([np.full(3000, 5.0), 5 + 1e-9 * rng.random(2500), [1e12]]),
}


@pytest.mark.parametrize("shape", sorted(CLUSTERED))
def test_quantiles_of_clusters(spark, monkeypatch, shape):
    """Ranges are cut again until at most 50 rows, or one value, are left; nothing larger is sorted."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 10)
    sizes = watch_sorting(monkeypatch)
    values = CLUSTERED[shape](np.random.default_rng(4))
    df = numbers(spark, values).withColumn("g", F.lit(1))
    row = Q.exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.75], ["a", "b", "c"], few_groups=True, sorted_rows=50).first()
    np.testing.assert_allclose([row[n] for n in "abc"], np.percentile(values, [25, 50, 75]), rtol=1e-12)
    assert all(n <= 50 for n in sizes)


def test_quantiles_of_many_rows_in_two_clusters(spark, monkeypatch):
    """Five million rows in two far clusters: no task sorts more than 20,000 of them."""
    import duckdb

    sizes = watch_sorting(monkeypatch)
    side = F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.lit(1e7))
    spread = F.pmod(F.col("id") * 48271, F.lit(2147483647)).cast("double") / F.lit(2147483647.0)
    df = spark.range(5_000_000).select(F.lit(1).alias("g"), (side + spread * 1e-3).alias("x"))
    row = Q.exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.75], ["a", "b", "c"], few_groups=True).first()
    want = duckdb.sql("""SELECT quantile_cont(x, [0.25, 0.5, 0.75]) FROM (
      SELECT CASE WHEN i % 3 = 0 THEN 0e0 ELSE 1e7 END + (i * 48271 % 2147483647) / 2147483647e0 * 1e-3 AS x FROM range(5000000) t(i))""").fetchall()[0][0]
    assert [row[n] for n in "abc"] == pytest.approx(want, rel=1e-15)
    assert sizes and sizes[0] <= Q.SORTED_ROWS


def test_quantiles_of_infinities(spark):
    df = numbers(spark, [float("-inf")] * 30 + [1.0, 2.0, 3.0] + [float("inf")] * 30).withColumn("g", F.lit(1))
    row = Q.exact_quantiles(df, ["g"], "x", [0.1, 0.5, 0.9], ["a", "b", "c"], few_groups=True, sorted_rows=2).first()
    assert (row["b"], row["n"]) == (2.0, 63)


def test_quantiles_of_groups(spark, monkeypatch):
    monkeypatch.setattr(Q, "SMALL_GROUP", 1000)
    rng = np.random.default_rng(3)
    groups = rng.choice(["big", "mid", "one", None], p=[0.7, 0.2997, 0.0002, 0.0001], size=20000)
    values = rng.normal(size=20000)
    rows = [(None if g is None else str(g), float(v)) for g, v in zip(groups, values)] + [("big", float("nan")), ("big", None), ("gone", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {r["g"]: r for r in Q.exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.75], ["a", "b", "c"]).collect()}
    assert "gone" not in found
    for name in ("big", "mid", "one", None):
        mine = values[[g == name for g in groups]]
        if len(mine):
            np.testing.assert_allclose([found[name][n] for n in "abc"], np.percentile(mine, [25, 50, 75]), rtol=1e-12)


def test_unsettled_brackets(spark, monkeypatch):
    """More groups than the driver may hold: the helper tables are checkpointed and joined by shuffle."""
    from tableprofile.functions import small

    monkeypatch.setattr(Q, "settle", lambda df, maybe_large=False: small.settle(df, 3, maybe_large))
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), F.col("id").cast("double").alias("x"))
    found = {r["g"]: r["m"] for r in Q.exact_quantiles(df, ["g"], "x", [0.5], ["m"]).collect()}
    assert found == {g: 495.0 + g for g in range(10)}


def test_describe(spark):
    df = spark.createDataFrame([(1, 10.0, "a"), (2, None, "b"), (4, 20.0, "c"), (9, float("nan"), None)], "x int, y double, z string")
    rows = {r["column"]: r for r in D.describe_numeric(df.withColumn("none", F.lit(None).cast("double"))).collect()}
    assert list(rows) == ["x", "y", "none"]
    assert (rows["x"]["count"], rows["x"]["q25"], rows["x"]["q50"], rows["x"]["q75"]) == (4, 1.75, 3.0, 5.25)
    assert (rows["y"]["count"], rows["y"]["q50"], rows["y"]["max"]) == (2, 15.0, 20.0)
    assert (rows["none"]["count"], rows["none"]["mean"], rows["none"]["q50"]) == (0, None, None)
    assert D.describe_numeric(df.select("z")).count() == 0


@pytest.mark.parametrize("bins", [1, 7, 20])
def test_histogram_matches_numpy(spark, bins):
    rng = np.random.default_rng(2)
    columns = {
        "a": rng.normal(size=500), "b": rng.integers(0, 21, size=500) / 10.0, "c": np.full(500, 4.0),
    }
    df = spark.createDataFrame([tuple(float(columns[c][i]) for c in "abc") for i in range(500)], "a double, b double, c double")
    rows = D.histogram_bins(df, bins=bins).collect()
    for c in "abc":
        counts, edges = np.histogram(columns[c], bins=bins)
        mine = [r for r in rows if r["column"] == c]
        assert [r["count"] for r in mine] == counts.tolist()
        np.testing.assert_allclose([r["bin_low"] for r in mine] + [mine[-1]["bin_high"]], edges, rtol=1e-12, atol=1e-12)


def test_histogram_places(spark):
    df = spark.createDataFrame([(None, 1.0, "x", 2)], "a double, b double, w string, c int")
    rows = D.histogram_bins(df, bins=2, max_columns=2).collect()
    assert {(r["position"], r["column"]) for r in rows} == {(2, "b")}
    assert D.histogram_bins(df.select("w")).count() == 0
    assert D.histogram_bins(df.limit(0)).count() == 0


def test_boxplot(spark):
    values = {"a": [1, 2, 3, 4, 5, 100], "b": [5.0], "c": [1, 1, 1, 50], "d": [-80, 10, 11, 12, 13]}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r["k"]: r for r in D.boxplot_stats(df, "k", "v").collect()}
    assert list(found) == ["a", "b", "c", "d"]
    for k, vs in values.items():
        q1, median, q3 = np.percentile(vs, [25, 50, 75])
        high = max([x for x in vs if x <= q3 + 1.5 * (q3 - q1)], default=q3)
        low = min([x for x in vs if x >= q1 - 1.5 * (q3 - q1)], default=q1)
        high, low = max(high, q3), min(low, q1)
        expected = (len(vs), min(vs), q1, median, q3, max(vs), low, high, sum(x > high or x < low for x in vs))
        assert tuple(found[k])[1:] == pytest.approx(expected)


def test_boxplot_of_moments(spark):
    """Categories an hour apart that print alike when the clocks go back stay apart."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("""SELECT * FROM VALUES (timestamp'2021-10-31 00:30:00Z', 1.0D), (timestamp'2021-10-31 00:30:00Z', 3.0D),
            (timestamp'2021-10-31 01:30:00Z', 7.0D) AS t(k, v)""")
        assert [r["median"] for r in D.boxplot_stats(df, "k", "v").collect()] == [2.0, 7.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bins(spark):
    ages = [0, 1, 18, 19, 30, 45, 60, 61, 200, 201, None]
    df = spark.createDataFrame([(a, 10.0 * i) for i, a in enumerate(ages)], "age int, v double")
    from tableprofile.functions.binning import bin_column

    edges, labels = [0, 18, 30, 45, 60, 200], ["<18", "18-30", "31-45", "46-60", "60+"]
    got = [r[0] for r in df.select(bin_column(F.col("age"), edges, labels)).collect()]
    assert got == [None, "<18", "<18", "18-30", "18-30", "31-45", "46-60", "60+", "60+", None, None]
    means = [tuple(r) for r in D.bin_means(df.where("age <> 45"), "age", ["v"], edges, labels).collect()]
    assert means == [("<18", 15.0), ("18-30", 35.0), ("31-45", None), ("46-60", 60.0), ("60+", 75.0)]
    with pytest.raises(ValueError):
        bin_column(F.col("age"), [0, 1], ["a", "b"])


def test_missing_mask_patterns_and_blocks(spark, readings):
    mask = [tuple(r) for r in D.missing_mask(readings).collect()]
    assert mask == [(i == 2, False, i == 2) for i in range(5)]
    assert [tuple(r) for r in D.missing_patterns(readings).collect()] == [("000", 4), ("101", 1)]
    rows = spark.range(100).select(F.col("id").alias("i"), F.when(F.col("id") >= 50, F.col("id")).alias("v"))
    blocks = [tuple(r) for r in D.missing_blocks(rows, "i", 4).collect()]
    assert [(b, share) for b, _, _, share in blocks] == [(0, 1.0), (1, 1.0), (2, 0.0), (3, 0.0)]
    assert sum(b[2] for b in blocks) == 100


def brute_matrix(rows, blocks):
    """rows: (place, values...) as tuples; the matrix laid out row by row."""
    pattern = lambda r: "".join("1" if v is None or v != v else "0" for v in r[1:])
    lost = lambda r: r[0] is None or r[0] != r[0]
    laid = sorted(rows, key=lambda r: (lost(r), 0 if lost(r) else r[0], pattern(r)))
    out = {}
    for i, r in enumerate(laid):
        first, n, missing = out.setdefault(i * blocks // len(laid), (i, 0, [0] * (len(r) - 1)))
        out[i * blocks // len(laid)] = first, n + 1, [m + (p == "1") for m, p in zip(missing, pattern(r))]
    return [(b, first, n, j, m / n) for b, (first, n, missing) in sorted(out.items()) for j, m in enumerate(missing)]


@pytest.mark.parametrize("blocks", [1, 7, 100, 2500])
def test_missing_matrix(spark, blocks):
    """A third of all rows share one number, some have none, and there can be fewer rows than blocks."""
    rows = [
        (None if i % 11 == 0 else float("nan") if i % 11 == 1 else 5.0 if i % 3 == 0 else (i * 37 % 1000) / 8 - 20, None if i * 7919 % 10 < 3 else "x", float("nan") if i % 4 == 0 else 1.0)
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "place double, `a.b` string, c double").repartition(5)
    got = D.missing_matrix(df, "place", blocks).collect()
    names = ["a.b", "c"]
    assert [(r["block"], r["first_row"], r["n_rows"], names.index(r["column"]), r["missing_share"]) for r in got] == brute_matrix(rows, blocks)


def test_missing_matrix_edges(spark):
    df = spark.createDataFrame([(None, None), (None, 1)], "place double, v int")
    assert [tuple(r) for r in D.missing_matrix(df, "place", 2).collect()] == [(0, 0, 1, "v", 0.0), (1, 1, 1, "v", 1.0)]
    assert D.missing_matrix(df.limit(0), "place").count() == 0
    assert D.missing_matrix(df.select("place"), "place").count() == 0
