"""Data-quality flags, scores and verdicts, of one table or of a table of table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import clamp_unit, is_summary_numeric, share
from tableprofile.operators.profile import column_facts, distinct_counts

# Fixed values of the two scoring rules.
FEW_ROWS = 100
FEW_ROWS_OF_PROFILE = 1000
MANY_COLUMNS = 100
MANY_MISSING = 0.5
HIGH_CARDINALITY = 0.9
PASSING_SCORE = 0.7
FEW_ROWS_PENALTY = 0.2
MANY_COLUMNS_PENALTY = 0.1
CONSTANT_PENALTY = 0.1
HIGH_CARDINALITY_PENALTY = 0.15
ONLY_CATEGORICAL_PENALTY = 0.1
ONLY_NUMERIC_PENALTY = 0.05

READY = "Fit for training under the present rules."
NOT_READY = "Not yet fit for training under the present rules."


def quality_flags(df: DataFrame) -> DataFrame:
    """One row of flags and the score of a table.

    Only columns without numeric statistics need a distinct count; whether a numeric column is
    constant follows from its smallest and largest value.
    """
    facts = column_facts(df)
    texts = [f.name for f in df.schema.fields if not is_summary_numeric(f.dataType)]
    if texts:
        facts = facts.join(F.broadcast(distinct_counts(df, texts)), "ordinal", "left")
    else:
        facts = facts.withColumn("unique", F.lit(None).cast("bigint"))
    unique = F.coalesce(F.col("unique"), F.lit(0).cast("bigint"))
    missing = F.col("n_rows") - F.col("non_null")
    return _flags_of(
        facts.select(
            "ordinal", "name", "n_rows", "non_null", "is_numeric",
            share(missing, F.col("n_rows")).alias("missing_share"),
            F.coalesce("is_constant", unique <= 1).alias("is_constant"),
            unique.alias("unique"),
        )
    )


def quality_flags_from_summary(summary: DataFrame, further: Sequence[Column] = ()) -> DataFrame:
    """The same row of flags from a finished `column_summary`, with further aggregates if named."""
    return _flags_of(
        summary.select(
            "ordinal", "name", (F.col("non_null") + F.col("missing")).alias("n_rows"), "non_null", "is_numeric",
            "missing_share", (F.col("unique") <= 1).alias("is_constant"), "unique",
        ),
        further,
    )


def _names_where(condition: Column) -> Column:
    named = F.struct(F.col("ordinal"), F.col("name"))
    return F.array_sort(F.collect_list(F.when(condition, named)))["name"]


def _flags_of(columns: DataFrame, further: Sequence[Column] = ()) -> DataFrame:
    """Fold the per-column rows (as many as the table has columns) into one row of flags."""
    crowded = ~F.col("is_numeric") & (share(F.col("unique"), F.col("n_rows")) >= HIGH_CARDINALITY)
    totals = columns.agg(
        F.coalesce(F.max("n_rows"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.count(F.lit(1)).alias("n_cols"),
        F.coalesce(F.max("missing_share"), F.lit(0.0)).alias("max_missing_share"),
        _names_where(F.col("is_constant")).alias("constant_columns_list"),
        _names_where(crowded).alias("high_cardinality_categoricals"),
        *further,
    )
    extra = totals.columns[len(totals.columns) - len(further) :]
    few, wide = F.col("n_rows") < FEW_ROWS, F.col("n_cols") > MANY_COLUMNS
    constants, crowds = F.size("constant_columns_list"), F.size("high_cardinality_categoricals")
    # The verdict depends on the last digit, so the penalties are taken off in this order.
    score = (
        F.lit(1.0)
        - F.col("max_missing_share")
        - F.when(few, F.lit(FEW_ROWS_PENALTY)).otherwise(F.lit(0.0))
        - F.when(wide, F.lit(MANY_COLUMNS_PENALTY)).otherwise(F.lit(0.0))
        - F.lit(CONSTANT_PENALTY) * constants
        - F.lit(HIGH_CARDINALITY_PENALTY) * crowds
    )
    return totals.select(
        "n_rows",
        "n_cols",
        few.alias("too_few_rows"),
        wide.alias("too_many_columns"),
        "max_missing_share",
        (F.col("max_missing_share") > MANY_MISSING).alias("too_many_missing"),
        (constants > 0).alias("has_constant_columns"),
        "constant_columns_list",
        (crowds > 0).alias("has_high_cardinality_categoricals"),
        "high_cardinality_categoricals",
        clamp_unit(score).alias("quality_score"),
        *extra,
    )


def _flag_map(columns: list[str]) -> Column:
    return F.create_map(*[part for name in columns for part in (F.lit(name), F.col(name))])


def boolean_flags(flags: DataFrame) -> DataFrame:
    """Only the true-or-false flags, as one map column."""
    names = [f.name for f in flags.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return flags.select(_flag_map(names).alias("flags"))


def _verdict() -> list[Column]:
    passed = F.col("quality_score") >= PASSING_SCORE
    return [passed.alias("ok_for_model"), F.when(passed, F.lit(READY)).otherwise(F.lit(NOT_READY)).alias("message")]


def quality_verdict(flags: DataFrame) -> DataFrame:
    """Whether the score is high enough, and a message, added to a row of flags."""
    return flags.select("*", *_verdict())


def quality_report(df: DataFrame) -> DataFrame:
    """Full verdict of one table: (ok_for_model, quality_score, message, flags, n_rows, n_cols)."""
    flags = quality_flags(df)
    names = [f.name for f in flags.schema.fields if isinstance(f.dataType, T.BooleanType)]
    ok, message = _verdict()
    return flags.select(ok, "quality_score", message, _flag_map(names).alias("flags"), "n_rows", "n_cols")


PROFILE_SCHEMA = (
    "n_rows bigint, n_cols bigint, max_missing_share double, numeric_cols bigint, categorical_cols bigint"
)


def validate_profiles(profiles: DataFrame) -> DataFrame:
    """Add `is_valid`: all counts present and not negative, the share present and within 0..1."""
    counts = ["n_rows", "n_cols", "numeric_cols", "categorical_cols"]
    valid = F.col("max_missing_share").between(0.0, 1.0)
    for name in counts:
        valid = valid & (F.col(name) >= 0)
    return profiles.withColumn("is_valid", F.coalesce(valid, F.lit(False)))


def score_profiles(profiles: DataFrame) -> DataFrame:
    """Score every profile row from its five features; the rows may be a table or a stream."""
    few, wide = F.col("n_rows") < FEW_ROWS_OF_PROFILE, F.col("n_cols") > MANY_COLUMNS
    no_numbers, no_categories = F.col("numeric_cols") == 0, F.col("categorical_cols") == 0
    penalties = [
        (few, FEW_ROWS_PENALTY),
        (wide, MANY_COLUMNS_PENALTY),
        (no_numbers & (F.col("categorical_cols") > 0), ONLY_CATEGORICAL_PENALTY),
        (no_categories & (F.col("numeric_cols") > 0), ONLY_NUMERIC_PENALTY),
    ]
    score = F.lit(1.0) - F.col("max_missing_share")
    for condition, penalty in penalties:
        score = score - F.when(condition, F.lit(penalty)).otherwise(F.lit(0.0))
    flags = F.create_map(
        F.lit("too_few_rows"), few,
        F.lit("too_many_columns"), wide,
        F.lit("too_many_missing"), F.col("max_missing_share") > MANY_MISSING,
        F.lit("no_numeric_columns"), no_numbers,
        F.lit("no_categorical_columns"), no_categories,
    )
    scored = profiles.withColumn("quality_score", clamp_unit(score))
    ok, message = _verdict()
    return scored.select("*", ok, message, flags.alias("flags"))
