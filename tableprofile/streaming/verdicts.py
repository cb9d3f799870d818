"""One verdict per table from a stream of its profiles, which may come late, out of order and more than once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tableprofile.operators.quality import PROFILE_SCHEMA, score_profiles, validate_profiles

TABLE, TIME = "table_name", "profiled_at"
#: What a stream of dated profiles holds.
DATED_SCHEMA = f"{TABLE} string, {TIME} timestamp, {PROFILE_SCHEMA}"


def newest_profiles(profiles: DataFrame, late: str = "1 day", forget_seconds: int = 30 * 86400) -> DataFrame:
    """The profile of each table whenever a newer one has come: (DATED_SCHEMA), for output mode update.

    A profile replaces the one before if it is dated later, whatever the order of arrival; of equal
    dates the larger one by its numbers counts, so a repeated profile changes nothing. Profiles
    outside the allowed ranges are left out. State is one profile per table; it goes when the
    watermark (`late` behind the newest date) is `forget_seconds` past it, and profiles dated before
    the watermark are no longer looked at.
    """
    valid = validate_profiles(profiles).where("is_valid").drop("is_valid").where(F.col(TABLE).isNotNull() & F.col(TIME).isNotNull())
    names = [f.name for f in T.StructType.fromDDL(DATED_SCHEMA)]
    held = ["micros", *names[2:]]
    dated = valid.select(TABLE, TIME, F.unix_micros(TIME).alias("micros"), *names[2:]).withWatermark(TIME, late)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = tuple(state.get) if state.exists else None
        new = old
        for frame in frames:
            if len(frame):
                best = max(frame[held].itertuples(index=False, name=None))
                new = best if new is None else max(new, best)
        if new is None:
            return
        new = tuple(v.item() if hasattr(v, "item") else v for v in new)
        state.update(new)
        state.setTimeoutTimestamp(max(new[0] // 1000 + 1000 * forget_seconds, state.getCurrentWatermarkMs() + 1))
        if new != old:
            yield pd.DataFrame([(*key, *new)], columns=[TABLE, *held])

    kept = "micros long, " + PROFILE_SCHEMA
    found = dated.groupBy(TABLE).applyInPandasWithState(update, f"{TABLE} string, {kept}", kept, "update", GroupStateTimeout.EventTimeTimeout)
    return found.select(TABLE, F.timestamp_micros("micros").alias(TIME), *names[2:])


def write_verdicts(newest: DataFrame, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Append the scored changes of every batch, working off what is there and then stopping; a batch that runs again replaces its own files."""

    def store(batch: DataFrame, number: int) -> None:
        score_profiles(batch).write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    writer = newest.writeStream.outputMode("update").trigger(availableNow=True).foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint_dir).start()


def current_verdicts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The last stored verdict of each table, without the number of its batch."""
    stored = spark.read.parquet(out_dir)
    order = Window.partitionBy(TABLE).orderBy(F.desc(TIME), F.desc("batch"))
    return stored.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place", "batch")
