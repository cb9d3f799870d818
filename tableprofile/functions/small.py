"""Tables that are small by measurement, and top-n within groups."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_LOCAL_ROWS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`. Where it is unset a local session gets a temporary one, a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tableprofile-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS, maybe_large: bool = False) -> DataFrame:
    """Compute a helper table once, so that every later use sees the same rows.

    A small result (at most max_rows rows reach the driver, as Arrow batches) becomes a literal
    table that joins by broadcast. A larger one is checkpointed in the shared folder and joins by
    shuffle. `maybe_large` keeps the result for the moment, so that a large one is not computed
    twice.
    """
    spark = df.sparkSession
    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if maybe_large else df
    try:
        rows = kept.limit(max_rows + 1).toArrow()
        if rows.num_rows <= max_rows:
            return F.broadcast(spark.createDataFrame(rows, schema=df.schema))
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_folder(spark))
        return kept.checkpoint()
    finally:
        if maybe_large:
            df.unpersist()


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition in which missing keys match each other."""
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank", ties: bool = False) -> DataFrame:
    """First n rows of each group in the given order, numbered from 1; with `ties` also all rows equal to the n-th.

    Spark limits each group before the shuffle as long as n is within its group-limit threshold;
    for a larger n the group is first cut in 64 parts of which none can lose a row of the answer.
    """
    number = F.rank if ties else F.row_number
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(64))
        inner = Window.partitionBy(*group, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_place", number().over(inner))
            .where(F.col("_place") <= n)
            .drop("_part", "_place")
        )
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, number().over(window)).where(F.col(rank) <= n)
