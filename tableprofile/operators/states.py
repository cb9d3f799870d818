"""Profiles that merge: what a part of a table contributes is stored once and merged without reading the part again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import is_summary_numeric, present, share
from tableprofile.operators.profile import _as_double, _first_slot, _value_slots
from tableprofile.operators.quality import _flags_of

# Columns per aggregate: a group keeps two sketches, some 20 KB, of each.
COLUMNS_PER_STATE = 25
#: 2 ** 12 registers: 1.6 % relative standard error of a distinct count.
DISTINCT_LG = 12
#: Rank error of quantiles: 0.7 % with 99 % confidence.
QUANTILE_K = 400

STATE_SCHEMA = (
    "part string, ordinal int, name string, dtype string, is_numeric boolean, n_rows bigint, non_null bigint, low double, high double, "
    "mean double, m2 double, first_key string, last_key string, distinct_sketch binary, quantile_sketch binary"
)
_STORED = [f.split()[0] for f in STATE_SCHEMA.split(", ")]


def _key(field: T.StructField) -> Column:
    """A present value as text; equal exactly for equal values, digests for long ones."""
    whole, real, text = _value_slots(field, keep_long_text=False)
    return F.coalesce(whole.cast("string"), real.cast("string"), text)


def profile_states(df: DataFrame, part: Column | str) -> DataFrame:
    """One row per part and column (STATE_SCHEMA): counts, extremes, mean and summed squared deviations, sketches.

    `part` names the part of a row, as a day or a file would; parts may be profiled at different times.
    first_key and last_key are the smallest and the largest value as text, or of long texts as digest:
    equal if and only if the part holds one distinct value.
    """
    part = F.col(part) if isinstance(part, str) else part
    numbered = list(enumerate(df.schema.fields))
    chunks = [numbered[i : i + COLUMNS_PER_STATE] for i in range(0, len(numbered), COLUMNS_PER_STATE)]
    return reduce(DataFrame.unionByName, [_states_of(df, part, chunk) for chunk in chunks])


def _states_of(df: DataFrame, part: Column, numbered: Sequence[tuple[int, T.StructField]]) -> DataFrame:
    aggregates, rows = [F.count(F.lit(1)).alias("n_rows")], []
    nothing, no_sketch = F.lit(None).cast("double"), F.lit(None).cast("binary")
    for i, field in numbered:
        value, numeric = present(field), is_summary_numeric(field.dataType)
        aggregates += [
            F.count(value).alias(f"n{i}"), F.min(_key(field)).alias(f"first{i}"), F.max(_key(field)).alias(f"last{i}"),
            # Hashes enter the sketch: a value of any type is a number there.
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(_first_slot(field))), F.lit(DISTINCT_LG)).alias(f"u{i}"),
        ]
        cells = [nothing] * 4
        if numeric:
            number = _as_double(value, field.dataType)
            aggregates += [
                F.min(number).alias(f"min{i}"), F.max(number).alias(f"max{i}"), F.avg(number).alias(f"mean{i}"),
                (F.var_pop(number) * F.count(number)).alias(f"m2{i}"), F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias(f"q{i}"),
            ]
            cells = [F.col(f"{c}{i}") for c in ("min", "max", "mean", "m2")]
        rows += [F.lit(i), F.lit(field.name), F.lit(field.dataType.simpleString()), F.lit(numeric), F.col(f"n{i}"), *cells]
        rows += [F.col(f"first{i}"), F.col(f"last{i}"), F.col(f"u{i}"), F.col(f"q{i}") if numeric else no_sketch]
    names = [c for c in _STORED if c not in ("part", "n_rows")]
    grouped = df.groupBy(part.cast("string").alias("part")).agg(*aggregates)
    return grouped.select("part", "n_rows", F.stack(F.lit(len(numbered)), *rows).alias(*names)).select(*_STORED)


def write_states(states: DataFrame, path: str) -> None:
    """Store states by part. States of a part that is there already replace it; other parts are not touched."""
    placed = states.withColumn("stored_part", F.coalesce("part", F.lit("")))
    # One file per part: a few rows per column.
    files = placed.repartition("stored_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    files.partitionBy("stored_part").parquet(path)


def read_states(df_or_spark, path: str) -> DataFrame:
    """Stored states of all parts."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return spark.read.schema(STATE_SCHEMA).parquet(path).select(*_STORED)


def merge_states(states: DataFrame, part: str = "all") -> DataFrame:
    """The state of all parts together, one row per column, itself a state that merges further.

    Columns meet by name; a part without a column counts as missing all its values. Types must
    agree. Counts, extremes and constants are exact; mean and deviations follow from those of the
    parts around the common mean, so nothing cancels.
    """
    n_rows = states.groupBy("part").agg(F.max("n_rows").alias("n_rows")).agg(F.sum("n_rows")).scalar()
    weight = F.when(F.col("is_numeric"), F.col("non_null"))
    means = states.groupBy(F.col("name").alias("of")).agg((F.sum(F.col("mean") * weight) / F.nullif(F.sum(F.when(F.col("mean").isNotNull(), weight)), F.lit(0))).alias("common"))
    # One row per column of the table.
    around = states.join(F.broadcast(means), F.col("name") == F.col("of"))
    deviation = F.col("m2") + F.col("non_null") * (F.col("mean") - F.col("common")) ** 2
    types = F.when(F.min("dtype") == F.max("dtype"), F.min("dtype")).otherwise(F.raise_error(F.concat(F.lit("parts disagree about the type of "), F.min("name"))).cast("string"))
    merged = around.groupBy("name").agg(
        F.min("ordinal").alias("ordinal"), types.alias("dtype"), F.first("is_numeric").alias("is_numeric"), F.sum("non_null").alias("non_null"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("common").alias("mean"), F.sum(deviation).alias("m2"),
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch", F.lit(QUANTILE_K)).alias("quantile_sketch"),
    )
    merged = merged.withColumn("quantile_sketch", F.when(F.col("is_numeric"), F.col("quantile_sketch")))
    return merged.withColumn("part", F.lit(part)).withColumn("n_rows", n_rows).select(*_STORED)


def state_summary(merged: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column of a merged state, in schema order.

    (ordinal, name, dtype, non_null, missing, missing_share, is_constant, approx_unique, is_numeric,
    min, max, mean, std, approx_quantiles): std is the sample deviation. approx_unique is exact for
    no or one distinct value.
    """
    missing = F.col("n_rows") - F.col("non_null")
    constant = F.col("first_key").eqNullSafe(F.col("last_key"))
    estimate = F.greatest(F.hll_sketch_estimate("distinct_sketch"), F.lit(2))
    unique = F.when(F.col("non_null") == 0, F.lit(0)).when(constant, F.lit(1)).otherwise(estimate).cast("bigint")
    points = F.when(F.col("is_numeric") & (F.col("non_null") > 0), F.kll_sketch_get_quantile_double("quantile_sketch", F.array(*map(F.lit, probabilities))))
    return merged.orderBy("ordinal").select(
        "ordinal", "name", "dtype", "non_null", missing.alias("missing"), share(missing, F.col("n_rows")).alias("missing_share"), constant.alias("is_constant"),
        unique.alias("approx_unique"), "is_numeric", F.col("low").alias("min"), F.col("high").alias("max"), "mean",
        F.sqrt(F.try_divide(F.col("m2"), F.nullif(F.col("non_null") - 1, F.lit(0)))).alias("std"), points.alias("approx_quantiles"),
    )


def state_flags(merged: DataFrame) -> DataFrame:
    """The row of quality flags of a merged state; only the share of distinct texts rests on a sketch."""
    rows = state_summary(merged).select(
        "ordinal", "name", (F.col("non_null") + F.col("missing")).alias("n_rows"), "non_null", "is_numeric", "missing_share", "is_constant",
        F.least("approx_unique", "non_null").alias("unique"),
    )
    return _flags_of(rows)
