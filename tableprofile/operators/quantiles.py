"""Exact quantiles per group without gathering a group in one task.

Spark's exact `percentile` holds every distinct value of a group in one buffer. Here scans of the
value column do without any large shuffle: a quantile sketch brackets each quantile, the rows are
counted below each bracket and in equal sub-ranges inside it, and the sub-range that holds a wanted
rank is cut again, pass by pass, until it holds few rows or one value. Only such few rows are
sorted. The sketch decides how much is counted, never the answer.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.small import null_safe_on, settle

SKETCH_SIZE = 1600
# Rank error of a sketch of this size is 0.3 % with 99 % confidence; four times that on either
# side leaves no realistic chance of a miss, and a miss is detected.
MARGIN = 0.012
# A group up to this size is its own bracket.
SMALL_GROUP = 20_000
SUB_RANGES = 1024
# Ranges with more rows are cut again before their values are sorted.
SORTED_ROWS = 20_000
# Sketches of a group are merged in this many tasks before the last one.
MERGERS = 64


def group_brackets(
    rows: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], few_groups: bool = False
) -> DataFrame:
    """Per group: n, min, max and disjoint or equal (low, high) pairs around each quantile; computed now."""
    parts = rows.groupBy(*keys, F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")).agg(
        F.count(value).alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE)).alias("sketch"),
    )
    grouped = parts.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"),
    )
    points = [F.lit(min(max(p + side, 0.0), 1.0)) for p in probabilities for side in (-MARGIN, MARGIN)]
    grouped = grouped.withColumn("points", F.kll_sketch_get_quantile_double("sketch", F.array(*points)))
    small = F.col("n") <= SMALL_GROUP
    last = len(probabilities) - 1
    bounds = []
    for i, p in enumerate(probabilities):
        low = F.col("min") if p <= MARGIN else F.get("points", F.lit(2 * i))
        high = F.col("max") if p >= 1 - MARGIN else F.get("points", F.lit(2 * i + 1))
        bounds += [F.when(small, F.col("min")).otherwise(low).alias(f"low{i}")]
        bounds += [F.when(small, F.col("max")).otherwise(high).alias(f"high{i}")]
    bracketed = grouped.select(*keys, "n", "min", "max", *bounds)
    # Brackets that touch become one, so that a value lies in at most one of them.
    for i in range(1, last + 1):
        touching = F.col(f"low{i}") <= F.col(f"high{i - 1}")
        bracketed = bracketed.withColumn(f"low{i}", F.when(touching, F.col(f"low{i - 1}")).otherwise(F.col(f"low{i}")))
    for i in range(last - 1, -1, -1):
        same = F.col(f"low{i}") == F.col(f"low{i + 1}")
        bracketed = bracketed.withColumn(f"high{i}", F.when(same, F.col(f"high{i + 1}")).otherwise(F.col(f"high{i}")))
    return settle(bracketed, maybe_large=not few_groups)


def _sub(value: Column, low: Column, high: Column) -> Column:
    """Number of the equal sub-range of low .. high in which a value lies; 0 where the range has no width.

    Halves keep the width of the widest range finite; infinities count as the largest numbers.
    """
    most = F.lit(sys.float_info.max)
    v, a, b = (F.least(F.greatest(x, -most), most) / 2 for x in (value, low, high))
    place = F.floor((v - a) / F.nullif(b - a, F.lit(0.0)) * F.lit(float(SUB_RANGES)))
    return F.least(F.coalesce(place, F.lit(0)), F.lit(SUB_RANGES - 1)).cast("int")


def _wide(low: Column, high: Column) -> Column:
    """Whether `_sub` can tell values in low .. high apart."""
    most = F.lit(sys.float_info.max)
    return F.least(high, most) / 2 > F.greatest(low, -most) / 2


def _located(rows: DataFrame, brackets: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """Rows with their region and, inside a bracket, the sub-range; rows above all brackets are gone.

    Regions go in value order: 2 i lies below bracket i, 2 i + 1 inside it.
    """
    limits = brackets.select(
        *[F.col(k).alias(f"g_{k}") for k in keys], *[f"{side}{i}" for i in range(count) for side in ("low", "high")]
    )
    v = F.col("v")
    region, low, high = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i in reversed(range(count)):
        region = F.when(v < F.col(f"low{i}"), F.lit(2 * i)).when(v <= F.col(f"high{i}"), F.lit(2 * i + 1)).otherwise(region)
        inside = F.col("region") == 2 * i + 1
        low, high = F.when(inside, F.col(f"low{i}")).otherwise(low), F.when(inside, F.col(f"high{i}")).otherwise(high)
    return (
        rows.join(limits, null_safe_on(rows, limits, [(k, f"g_{k}") for k in keys]))
        .withColumn("region", region)
        .where("region is not null")
        .withColumns({"low": low, "high": high})
        .select(*keys, "region", F.when(F.col("region") % 2 == 1, _sub(v, F.col("low"), F.col("high"))).otherwise(0).alias("sub"), "v")
    )


def _inside(rows: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, v) with the range (r_keys, low, high, before) they lie in; the ranges of a group do not overlap."""
    on = null_safe_on(rows, ranges, [(k, f"r_{k}") for k in keys])
    return rows.join(ranges, on & rows["v"].between(ranges["low"], ranges["high"])).drop(*[f"r_{k}" for k in keys])


def _holding(counts: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per target the part that holds its rank: (r_keys, q, rank, before, n, low, high).

    counts: (keys, before, n, low, high), before being the rows below the part and low and high its outermost values.
    """
    joined = counts.join(targets, null_safe_on(counts, targets, [(k, f"r_{k}") for k in keys]))
    held = joined.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
    return held.select(*[f"r_{k}" for k in keys], "q", "rank", "before", "n", "low", "high")


def _sorted(rows: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(r_keys, q, rank, value) for the ranges that are small enough to sort their values."""
    names = [f"r_{k}" for k in keys]
    ranges = few.select(*names, "low", "high", "before").distinct()
    values = _inside(rows, ranges, keys).groupBy(*keys, "before", "v").agg(F.count(F.lit(1)).alias("c"))
    by_value = Window.partitionBy(*keys, "before").orderBy("v")
    values = values.withColumn("until", F.col("before") + F.sum("c").over(by_value)).withColumnRenamed("before", "at")
    joined = values.join(few, null_safe_on(values, few, [(k, f"r_{k}") for k in keys]) & (values["at"] == few["before"]))
    # The smallest value whose running count passes a rank has that rank.
    return joined.where(F.col("until") > F.col("rank")).groupBy(*names, "q", "rank").agg(F.min("v").alias("value"))


def select_ranks(rows: DataFrame, held: DataFrame, keys: Sequence[str], sorted_rows: int, maybe_large: bool) -> DataFrame:
    """(r_keys, q, rank, value): the value of every wanted rank.

    held: (r_keys, q, rank, before, n, low, high), the range that holds a rank, the number of rows
    below it and inside it. Every pass cuts the ranges with more than `sorted_rows` rows in
    SUB_RANGES parts between their outermost values, counts these in one scan and goes on with the
    parts that hold a rank. As the outermost values fall in different parts, every pass gets on,
    however the values are spread. What is left has few rows or one value.
    """
    names = [f"r_{k}" for k in keys]
    done = []
    while True:
        many = (F.col("n") > sorted_rows) & _wide(F.col("low"), F.col("high"))
        open_ = settle(held.where(many), maybe_large=maybe_large)
        done.append(settle(held.where(~many), maybe_large=maybe_large))
        if open_.isEmpty():
            break
        ranges = open_.select(*names, "low", "high", "before").distinct()
        placed = _inside(rows, ranges, keys).withColumn("sub", _sub(F.col("v"), F.col("low"), F.col("high")))
        parts = placed.groupBy(*keys, "before", "sub").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        # At most SUB_RANGES parts of a range.
        lower = Window.partitionBy(*keys, "before").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(lower), F.lit(0)))
        held = settle(_holding(parts, open_.select(*names, "q", "rank"), keys), maybe_large=maybe_large)
    found = reduce(DataFrame.unionByName, done)
    one = F.col("low") == F.col("high")
    few = settle(found.where(~one), maybe_large=maybe_large)
    known = found.where(one).select(*names, "q", "rank", F.col("low").alias("value"))
    if few.isEmpty():
        return known
    return known.unionByName(_sorted(rows, few, keys))


def _of(found: str, q: int) -> Column:
    """The values found for quantile q."""
    return F.transform(F.filter(found, lambda x: x["q"] == q), lambda x: x["value"])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    few_groups: bool = False,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """One row per group: keys, n, min, max and the linearly interpolated quantiles under `names`.

    Probabilities must increase. Rows with a missing value are left out; missing keys form a
    group, and `few_groups` tells that their number is bounded. Brackets and the ranges around the
    wanted ranks are computed when this is called; no task sorts more than `sorted_rows` values of a range.
    """
    keys = list(keys)
    number = F.nullif(F.col(value).cast("double"), F.lit(float("nan")))
    rows = df.select(*keys, (number + F.lit(0.0)).alias("v")).where("v is not null")
    brackets = group_brackets(rows, keys, "v", probabilities, few_groups)
    facts = brackets.select(*[F.col(k).alias(f"r_{k}") for k in keys], "n", "min", "max")
    located = _located(rows, brackets, keys, len(probabilities))

    # Ranks are 0-based; a quantile lies between ranks floor(h) and floor(h) + 1 of h = (n - 1) p.
    wanted = []
    for i, p in enumerate(probabilities):
        h = (F.col("n") - 1) * F.lit(float(p))
        rank = F.floor(h).cast("bigint")
        wanted += [F.struct(F.lit(i).alias("q"), (rank + F.when((h > rank) & (F.lit(side) == 1), 1).otherwise(0)).alias("rank")) for side in (0, 1)]
    targets = facts.select(*[f"r_{k}" for k in keys], F.explode(F.array_distinct(F.array(*wanted))).alias("t")).select(*[f"r_{k}" for k in keys], "t.*")
    lower = Window.partitionBy(*keys).orderBy("region", "sub").rowsBetween(Window.unboundedPreceding, -1)
    # At most 1025 counts per bracket and group.
    counts = located.groupBy(*keys, "region", "sub").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    held = settle(_holding(counts.where("region % 2 = 1"), targets, keys), maybe_large=not few_groups)
    ranked = select_ranks(rows, held, keys, sorted_rows, not few_groups)
    ranked = ranked.groupBy(*[F.col(f"r_{k}").alias(f"v_{k}") for k in keys]).agg(F.collect_list(F.struct("q", "rank", "value")).alias("found"))
    joined = facts.join(ranked, null_safe_on(facts, ranked, [(f"r_{k}", f"v_{k}") for k in keys]), "left")
    missed = F.raise_error(F.lit("quantile bracket does not hold the wanted rank")).cast("double")
    results: list[Column] = []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        h = (F.col("n") - 1) * F.lit(float(p))
        of_q = _of("found", i)
        lowest, beyond = F.array_min(of_q), F.array_max(of_q)
        part = h - F.floor(h)
        quantile = lowest + (F.when(part == 0, lowest).otherwise(beyond) - lowest) * part
        complete = F.size(of_q) == F.when(part == 0, 1).otherwise(2)
        results.append(F.when(F.coalesce(complete, F.lit(False)), quantile).otherwise(missed).alias(name))
    return joined.select(*[F.col(f"r_{k}").alias(k) for k in keys], "n", "min", "max", *results)
