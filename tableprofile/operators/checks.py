"""Checks: duplicated rows, row rules, value ranges, column types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import col, fields, normalize_missing, present, text_key
from tableprofile.functions.small import settle


def _row_key(df: DataFrame) -> Column:
    """One struct that is equal exactly for equal rows; whole long texts stand behind digests."""
    keys = []
    for field in df.schema.fields:
        value = present(field)
        keys.append(text_key(value) if isinstance(field.dataType, T.StringType) else value)
    return F.struct(*[value.alias(f"k{i}") for i, value in enumerate(keys)])


def _repeated_keys(df: DataFrame) -> DataFrame:
    """(key, n_copies) of the rows that occur more than once."""
    copies = df.select(_row_key(df).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_copies"))
    return copies.where("n_copies > 1")


def has_duplicates(df: DataFrame) -> DataFrame:
    """One row: does any row occur twice, missing values being equal to each other."""
    return _repeated_keys(df).limit(1).agg((F.count(F.lit(1)) > 0).alias("has_duplicates"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Each row that occurs more than once, with its number of copies.

    Tables with text first count the rows by digest. While the repeated digests are few they join
    by broadcast, so that of the texts themselves only those of repeated rows are moved, once per
    task; more of them join by shuffle.
    """
    clean = normalize_missing(df)
    if not any(isinstance(f.dataType, T.StringType) for f in df.schema.fields):
        copies = clean.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("n_copies"))
        return copies.where("n_copies > 1")
    repeated = settle(_repeated_keys(df).withColumnRenamed("key", "repeated"))
    rows = clean.select(_row_key(clean).alias("key"), F.struct(*[col(c) for c in df.columns]).alias("row"))
    found = rows.join(repeated, F.col("key").eqNullSafe(F.col("repeated")))
    return found.groupBy("key").agg(F.first("row").alias("row"), F.first("n_copies").alias("n_copies")).select("row.*", "n_copies")


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break any rule, with the names of the broken rules in `violated_rules`.

    A rule is a condition that is true for a suspicious row; where it is NULL it did not fire.
    """
    fired = [F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    checked = df.withColumn("violated_rules", F.array_compact(F.array(*fired)))
    return checked.where(F.size("violated_rules") > 0)


@dataclass(frozen=True)
class Expected:
    """Expectation for one column: bounds (inclusive) or a set of allowed values."""

    column: str
    low: float | None = None
    high: float | None = None
    allowed: Sequence[Any] | None = None


def range_check(df: DataFrame, expectations: Sequence[Expected]) -> DataFrame:
    """(column, min, max, n_outside, ok) per expectation, all from one aggregate."""
    aggregates, cells = [], []
    for i, expected in enumerate(expectations):
        value = present(fields(df, [expected.column])[0])
        outside = F.lit(False)
        if expected.low is not None:
            outside = outside | (value < F.lit(expected.low))
        if expected.high is not None:
            outside = outside | (value > F.lit(expected.high))
        if expected.allowed is not None:
            outside = outside | ~value.isin(list(expected.allowed))
        aggregates += [
            F.min(value).try_cast("double").alias(f"min{i}"),
            F.max(value).try_cast("double").alias(f"max{i}"),
            F.count_if(outside).alias(f"n{i}"),
        ]
        cells += [F.lit(expected.column), F.col(f"min{i}"), F.col(f"max{i}"), F.col(f"n{i}"), F.col(f"n{i}") == 0]
    rows = F.stack(F.lit(len(expectations)), *cells).alias("column", "min", "max", "n_outside", "ok")
    return df.agg(*aggregates).select(rows)


def require_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    """ValueError naming the columns that are not numbers."""
    wrong = [f.name for f in fields(df, columns) if not isinstance(f.dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"not numeric: {', '.join(wrong)}")
