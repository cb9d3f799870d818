"""Ordering a whole table in buckets, so that no task has to hold all of it.

Cut points from an approximate quantile summary split a number into ranges, and each range is cut
again in equal parts. The cut points come to the driver (at most MAX_RANGES numbers) and become
literals: where they lie changes the balance of the work, never its result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.small import null_safe_on

MAX_RANGES = 1024
PARTS_OF_RANGE = 64
MAX_BUCKETS = MAX_RANGES * PARTS_OF_RANGE


def add_bucket(df: DataFrame, value: str, bucket: str = "bucket") -> DataFrame:
    """Add an int column that grows with a non-missing double column; at most MAX_BUCKETS values."""
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranges = min(MAX_RANGES, max(4 * shuffles, 32))
    chances = [i / ranges for i in range(ranges + 1)]
    cuts = sorted(set(df.approxQuantile(value, chances, 1.0 / (2 * ranges))))
    cuts = [c for c in cuts if abs(c) != float("inf")]
    if not cuts:
        return df.withColumn(bucket, F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=value, outputCol="_range", handleInvalid="keep").transform(df)
    # The open ranges below the first cut and above the last are not cut again.
    place = F.col("_range").cast("int")
    low = F.array(*[F.lit(float(c)) for c in [0.0, *cuts]])
    width = F.array(*[F.lit(None).cast("double"), *[F.lit(b - a) for a, b in zip(cuts, cuts[1:])], F.lit(None).cast("double")])
    part = F.floor((F.col(value) - F.get(low, place)) / F.get(width, place) * F.lit(float(PARTS_OF_RANGE)))
    part = F.greatest(F.lit(0), F.least(F.coalesce(part, F.lit(0)), F.lit(PARTS_OF_RANGE - 1))).cast("int")
    return ranged.withColumn(bucket, place * PARTS_OF_RANGE + part).drop("_range")


def totals_above(
    df: DataFrame, keys: Sequence[str], value: str, bucket: str, sums: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """Add `<s>_above` and `<s>_total` for each s in sums, per group of keys.

    df has one row per (keys, value, ties) and a bucket column from `add_bucket`. Running totals go
    by bucket first (at most MAX_BUCKETS rows a group) and then inside each bucket.
    """
    keys = list(keys)
    group = keys or [F.lit(0)]
    higher = Window.partitionBy(*group).orderBy(F.col(bucket).desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*group)
    offsets = df.groupBy(*keys, bucket).agg(*[F.sum(s).alias(s) for s in sums])
    offsets = offsets.select(
        *[F.col(k).alias(f"o_{k}") for k in [*keys, bucket]],
        *[F.coalesce(F.sum(s).over(higher), F.lit(0)).alias(f"{s}_offset") for s in sums],
        *[F.sum(s).over(everything).alias(f"{s}_total") for s in sums],
    )
    falling = [F.col(c).desc() for c in [value, *ties]]
    inside = Window.partitionBy(*keys, bucket).orderBy(*falling).rowsBetween(Window.unboundedPreceding, -1)
    within = df.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"{s}_inside") for s in sums])
    # Without keys there are at most MAX_BUCKETS offsets.
    on = null_safe_on(within, offsets, [(k, f"o_{k}") for k in [*keys, bucket]])
    joined = within.join(offsets if keys else F.broadcast(offsets), on)
    return joined.select(
        *df.columns,
        *[(F.col(f"{s}_offset") + F.col(f"{s}_inside")).alias(f"{s}_above") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def next_lower(df: DataFrame, value: str, bucket: str, columns: Sequence[str], name: str) -> DataFrame:
    """Add `name`: struct of the columns of the row with the next lower value, NULL at the lowest.

    df has one row per value and a bucket column from `add_bucket`. Inside a bucket the neighbour
    is the next row; the lowest row of a bucket meets the highest one of the next bucket that has
    rows. Only these highest rows, at most MAX_BUCKETS, are ever ordered together.
    """
    own = F.struct(*columns)
    tops = df.groupBy(bucket).agg(F.max_by(own, F.col(value)).alias("_top"))
    across = Window.partitionBy(F.lit(0)).orderBy(F.col(bucket).desc())
    tops = tops.select(F.col(bucket).alias("_bucket"), F.lead("_top").over(across).alias("_beyond"))
    inside = Window.partitionBy(bucket).orderBy(F.col(value).desc())
    rows = df.withColumn("_inside", F.lead(own).over(inside))
    joined = rows.join(F.broadcast(tops), F.col(bucket) == F.col("_bucket"))
    return joined.withColumn(name, F.coalesce("_inside", "_beyond")).select(*df.columns, name)
