"""Classification metrics, ROC curve and areas, all from label and prediction in one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.columns import col
from tableprofile.operators.ordered import MAX_BUCKETS, add_bucket, next_lower, totals_above


def _safe_ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(hits: Column, predicted: Column, actual: Column) -> Column:
    return _safe_ratio(2 * hits, predicted + actual)


def binary_metrics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, accuracy, precision, recall, f1) with 1 as the positive class; one aggregate."""
    y, p = col(label), col(prediction)
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("right"),
        F.count_if((y == 1) & (p == 1)).alias("hits"),
        F.count_if(p == 1).alias("predicted"),
        F.count_if(y == 1).alias("actual"),
    )
    hits, predicted, actual = F.col("hits"), F.col("predicted"), F.col("actual")
    return counts.select(
        *keys,
        "n",
        F.try_divide(F.col("right").cast("double"), F.col("n").cast("double")).alias("accuracy"),
        _safe_ratio(hits, predicted).alias("precision"),
        _safe_ratio(hits, actual).alias("recall"),
        _f1(hits, predicted, actual).alias("f1"),
    )


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n) for the pairs that occur."""
    pairs = df.groupBy(col(label).alias("label"), col(prediction).alias("prediction"))
    return pairs.agg(F.count(F.lit(1)).alias("n")).orderBy("label", "prediction")


def classification_report(
    df: DataFrame, label: str, prediction: str, names: Mapping[int, str] | None = None
) -> DataFrame:
    """(position, name, precision, recall, f1, support): classes, accuracy, macro and weighted averages.

    The accuracy row shows accuracy under f1 and leaves precision and recall empty.
    """
    pairs = df.groupBy(col(label).alias("y"), col(prediction).cast(df.schema[label].dataType).alias("p"))
    pairs = pairs.agg(F.count(F.lit(1)).alias("c"))
    n, hit = F.col("c"), F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    sides = F.stack(F.lit(2), F.col("y"), n, none, hit, F.col("p"), none, n, none)
    classes = (
        pairs.select(sides.alias("class", "support", "predicted", "hits"))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    named = F.col("class").cast("string")
    if names:
        listed = F.create_map(*[c for k, v in names.items() for c in (F.lit(k).cast(df.schema[label].dataType), F.lit(v))])
        named = F.coalesce(F.try_element_at(listed, F.col("class")), named)
    # One row per class: small, and numbered in class order.
    rows = classes.select(
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("class")).alias("position"),
        named.alias("name"),
        _safe_ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _safe_ratio(F.col("hits"), F.col("support")).alias("recall"),
        _f1(F.col("hits"), F.col("predicted"), F.col("support")).alias("f1"),
        "support",
        "hits",
    )
    parts = ["precision", "recall", "f1"]
    total = rows.agg(
        F.max("position").alias("last"),
        F.sum("support").alias("support"),
        _safe_ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(p).alias(f"macro_{p}") for p in parts],
        *[_safe_ratio(F.sum(F.col(p) * F.col("support")), F.sum("support")).alias(f"weighted_{p}") for p in parts],
    )
    empty = F.lit(None).cast("double")
    summary = total.select(
        "last",
        "support",
        F.stack(
            F.lit(3),
            F.lit(1), F.lit("accuracy"), empty, empty, F.col("accuracy"),
            F.lit(2), F.lit("macro avg"), *[F.col(f"macro_{p}") for p in parts],
            F.lit(3), F.lit("weighted avg"), *[F.col(f"weighted_{p}") for p in parts],
        ).alias("step", "name", *parts),
    ).select((F.col("last") + F.col("step")).alias("position"), "name", *parts, "support")
    return rows.drop("hits").unionByName(summary).orderBy("position")


def _scored(df: DataFrame, label: str, score: str, keys: Sequence[str]) -> DataFrame:
    """(key0, key1, ..., bucket, score, p, n): positives and negatives per distinct score."""
    number = F.nullif(col(score).cast("double"), F.lit(float("nan"))) + F.lit(0.0)
    rows = df.where(number.isNotNull() & col(label).isNotNull()).select(
        *[col(k).alias(f"key{i}") for i, k in enumerate(keys)],
        number.alias("score"),
        F.when(col(label) == 1, 1).otherwise(0).alias("p"),
        F.when(col(label) == 1, 0).otherwise(1).alias("n"),
    )
    grouped = add_bucket(rows, "score").groupBy(*[f"key{i}" for i in range(len(keys))], "bucket", "score")
    return grouped.agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, roc_auc): chance that a positive scores above a negative, ties counting half.

    NULL where a class is absent.
    """
    inner = [f"key{i}" for i in range(len(keys))]
    ranked = totals_above(_scored(df, label, score, keys), inner, "score", "bucket", ["p", "n"])
    below = F.col("n_total") - F.col("n_above") - F.col("n")
    won = F.col("p").cast("double") * (below.cast("double") + 0.5 * F.col("n"))
    pairs = F.max("p_total").cast("double") * F.max("n_total")
    areas = ranked.groupBy(*inner).agg(F.try_divide(F.sum(won), pairs).alias("roc_auc"))
    return areas.select(*[F.col(i).alias(k) for i, k in zip(inner, keys)], "roc_auc")


def roc_curve(df: DataFrame, label: str, score: str, drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) from the highest score down, after the start point (inf, 0, 0).

    Every distinct score is a point. With `drop_intermediate` a point goes if it lies on the straight
    line through equal steps: its score brought as many positives and negatives as the next lower
    score does. The highest and the lowest score stay; so does the area. Rates are NULL where their
    class is absent.
    """
    scored = _scored(df, label, score, [])
    if drop_intermediate:
        scored = next_lower(scored, "score", "bucket", ["p", "n"], "next")
    ranked = totals_above(scored, [], "score", "bucket", ["p", "n"])
    if drop_intermediate:
        highest = F.col("p_above") + F.col("n_above") == 0
        turns = (F.col("p") != F.col("next.p")) | (F.col("n") != F.col("next.n"))
        ranked = ranked.where(highest | F.col("next").isNull() | turns)
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide((F.col("n_above") + F.col("n")).cast("double"), F.col("n_total").cast("double")).alias("fpr"),
        F.try_divide((F.col("p_above") + F.col("p")).cast("double"), F.col("p_total").cast("double")).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return start.unionByName(points).orderBy(F.col("threshold").desc())


def trapezoid_auc(curve: DataFrame, x: str = "fpr", y: str = "tpr", low: float = 0.0, high: float = 1.0) -> DataFrame:
    """One row (auc): area under a rising curve by trapezoids between neighbouring points.

    Points with equal x enclose no area: each x keeps only where the curve enters and leaves it.
    The work is cut in equal ranges of x between low and high; points outside them count too.
    """
    points = (
        curve.groupBy(col(x).cast("double").alias("x"))
        .agg(F.min(col(y)).alias("enter"), F.max(col(y)).alias("leave"))
        .where("x is not null")
    )
    place = F.floor((F.col("x") - F.lit(low)) / F.lit(high - low) * F.lit(float(MAX_BUCKETS)))
    points = points.withColumn("bucket", F.greatest(F.lit(0), F.least(place, F.lit(MAX_BUCKETS - 1))).cast("int"))
    step = Window.partitionBy("bucket").orderBy("x")
    area = (F.col("x") - F.lag("x").over(step)) * (F.col("enter") + F.lag("leave").over(step)) / 2
    # One row per bucket: its own area, and its end points to connect it with its neighbours.
    buckets = points.withColumn("area", area).groupBy("bucket").agg(
        F.coalesce(F.sum("area"), F.lit(0.0)).alias("area"),
        F.min(F.struct("x", "enter")).alias("first"),
        F.max(F.struct("x", "leave")).alias("last"),
    )
    across = Window.partitionBy(F.lit(0)).orderBy("bucket")
    gap = (F.col("first.x") - F.lag("last.x").over(across)) * (F.col("first.enter") + F.lag("last.leave").over(across)) / 2
    joined = buckets.select((F.col("area") + F.coalesce(gap, F.lit(0.0))).alias("area"))
    return joined.agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("auc"))


def metric_gain(metrics: DataFrame, baseline: DataFrame, names: Sequence[str]) -> DataFrame:
    """(metric, value, baseline, gain_points) from two one-row tables; the gain is in percentage points."""
    cells = [c for i, m in enumerate(names) for c in (F.lit(i), F.lit(m), col(m).cast("double"))]
    ours = metrics.select(F.stack(F.lit(len(names)), *cells).alias("position", "metric", "value"))
    theirs = baseline.select(F.stack(F.lit(len(names)), *cells).alias("position", "metric", "baseline"))
    return (
        ours.join(F.broadcast(theirs), ["position", "metric"])
        .orderBy("position")
        .select("metric", "value", "baseline", ((F.col("value") - F.col("baseline")) * 100).alias("gain_points"))
    )
