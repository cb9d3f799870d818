"""Scoring a stream of dataset profiles as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tableprofile.operators.quality import PROFILE_SCHEMA, score_profiles, validate_profiles


def read_profile_stream(spark: SparkSession, path: str, file_format: str = "json", extra: str = "") -> DataFrame:
    """Profiles from files dropped in a folder; `extra` names further columns, as DDL."""
    schema = PROFILE_SCHEMA + (", " + extra if extra else "")
    return spark.readStream.schema(schema).format(file_format).load(path)


def scored_stream(profiles: DataFrame) -> DataFrame:
    """Valid profiles with score, verdict and flags. Stateless: no watermark, no shuffle."""
    return score_profiles(validate_profiles(profiles).where("is_valid").drop("is_valid"))


def rejected_stream(profiles: DataFrame) -> DataFrame:
    """Profiles outside the allowed ranges."""
    return validate_profiles(profiles).where(~F.col("is_valid")).drop("is_valid")


def write_scores(scored: DataFrame, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Append scores as Parquet, working off what is there and then stopping."""
    writer = scored.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint_dir).start(out_dir)
