"""Column summaries: counts, missing values, distinct values, numeric statistics, examples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import (
    DIGEST_TAG,
    LONG_TEXT_BYTES,
    col,
    fields,
    is_fractional,
    is_long_text,
    is_summary_numeric,
    present,
    share,
    text_key,
)
from tableprofile.functions.small import top_n

# One aggregate or one reshaping of columns to rows holds this many columns; the next ones read
# other columns of the source.
COLUMNS_PER_AGGREGATE = 100

STATISTICS = ["min", "max", "mean", "std"]
SUMMARY_COLUMNS = [
    "name", "dtype", "non_null", "missing", "missing_share", "unique",
    "example_values", "is_numeric", *STATISTICS,
]


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: n_rows and n_cols."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """Column, type and number of present values, in schema order."""
    facts = column_facts(df)
    return facts.select("ordinal", F.col("name").alias("column"), "dtype", "non_null").orderBy("ordinal")


def column_facts(df: DataFrame) -> DataFrame:
    """One row per column: counts and numeric statistics, from one scan without a real shuffle.

    Columns: ordinal, name, dtype, is_numeric, n_rows, non_null, is_constant, min, max, mean, std.
    `is_constant` tells that the column has no more than one distinct present value; it is NULL
    for columns without numeric statistics.
    """
    numbered = list(enumerate(df.schema.fields))
    chunks = [numbered[i : i + COLUMNS_PER_AGGREGATE] for i in range(0, len(numbered), COLUMNS_PER_AGGREGATE)]
    return reduce(DataFrame.unionByName, [_facts_of(df, chunk) for chunk in chunks])


def _facts_of(df: DataFrame, numbered: list[tuple[int, T.StructField]]) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    rows: list[Column] = []
    nothing = F.lit(None).cast("double")
    for i, field in numbered:
        value = present(field)
        aggregates.append(F.count(value).alias(f"n{i}"))
        numeric = is_summary_numeric(field.dataType)
        if numeric:
            number = _as_double(value, field.dataType)
            aggregates += [
                F.min(number).alias(f"min{i}"),
                F.max(number).alias(f"max{i}"),
                F.avg(number).alias(f"mean{i}"),
                F.stddev_samp(number).alias(f"std{i}"),
                F.min(value).eqNullSafe(F.max(value)).alias(f"constant{i}"),
            ]
        rows += [F.lit(i), F.lit(field.name), F.lit(field.dataType.simpleString()), F.lit(numeric)]
        rows += [F.col(f"n{i}")]
        rows += [F.col(f"constant{i}") if numeric else F.lit(None).cast("boolean")]
        rows += [F.col(f"{s}{i}") if numeric else nothing for s in STATISTICS]
    names = ["ordinal", "name", "dtype", "is_numeric", "non_null", "is_constant", *STATISTICS]
    return df.agg(*aggregates).select("n_rows", F.stack(F.lit(len(numbered)), *rows).alias(*names))


def _as_double(value: Column, dtype: T.DataType) -> Column:
    return (value.cast("int") if isinstance(dtype, T.BooleanType) else value).cast("double")


def _value_slots(field: T.StructField, keep_long_text: bool) -> list[Column]:
    """A present value as (whole, real, text) with one slot used; equal values have equal slots."""
    value, dtype = present(field), field.dataType
    whole, real, text = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(dtype, T.BooleanType):
        whole = value.cast("int").cast("bigint")
    elif isinstance(dtype, T.IntegralType):
        whole = value.cast("bigint")
    elif isinstance(dtype, T.DateType):
        whole = F.unix_date(value).cast("bigint")
    elif isinstance(dtype, T.TimestampType):
        whole = F.unix_micros(value)
    elif is_fractional(dtype):
        real = value.cast("double")
    elif isinstance(dtype, T.BinaryType):
        text = F.hex(value)
    elif isinstance(dtype, T.MapType):
        text = F.when(value.isNotNull(), F.to_json(F.struct(F.array_sort(F.map_entries(value)).alias("v"))))
    elif isinstance(dtype, (T.ArrayType, T.StructType)):
        text = F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}))
    else:
        text = value.cast("string")
    return [whole, real, text if keep_long_text else text_key(text)]


def _slots_as_text(numbered: list[tuple[int, T.StructField]]) -> Column:
    """Printed form of a value held in slots."""
    result = F.coalesce(F.col("whole").cast("string"), F.col("real").cast("string"), F.col("text"))
    special = F.lit(None).cast("string")
    for i, field in numbered:
        printed = None
        if isinstance(field.dataType, T.BooleanType):
            printed = (F.col("whole") == 1).cast("string")
        elif isinstance(field.dataType, T.DateType):
            printed = F.date_from_unix_date(F.col("whole").cast("int")).cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            printed = F.timestamp_micros(F.col("whole")).cast("string")
        elif isinstance(field.dataType, T.FloatType):
            printed = F.col("real").cast("float").cast("string")
        if printed is not None:
            special = F.when(F.col("ordinal") == i, printed).otherwise(special)
    return F.coalesce(special, result)


def _long_values(
    df: DataFrame,
    numbered: list[tuple[int, T.StructField]],
    keep_long_text: bool = False,
    order_by: str | None = None,
) -> DataFrame:
    """Present values of many columns as rows (ordinal, whole, real, text [, place])."""
    kept = [] if order_by is None else [col(order_by).alias("place")]
    # The ordinal is never missing; saying so keeps later joins from adding that filter to some
    # uses of the rows only, which would cost the sharing of their shuffle.
    filled = "(whole is not null or real is not null or text is not null) and ordinal is not null"
    parts = []
    for start in range(0, len(numbered), COLUMNS_PER_AGGREGATE):
        chunk = numbered[start : start + COLUMNS_PER_AGGREGATE]
        cells = [cell for i, field in chunk for cell in (F.lit(i), *_value_slots(field, keep_long_text))]
        rows = F.stack(F.lit(len(chunk)), *cells).alias("ordinal", "whole", "real", "text")
        parts.append(df.select(*kept, rows).where(filled))
    return reduce(DataFrame.unionByName, parts)


def distinct_values_long(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """Distinct present values of many columns: (ordinal, whole, real, text [, place]).

    One scan; equal values merge within each task before the only shuffle, so a value held by a
    third of the rows costs one shuffled row per task. Long texts are shuffled as digests.
    `place` is the smallest order_by value at which a value is seen.
    """
    chosen = {f.name for f in fields(df, columns)}
    numbered = [(i, f) for i, f in enumerate(df.schema.fields) if f.name in chosen]
    values = _long_values(df, numbered, order_by=order_by)
    keys = ["ordinal", "whole", "real", "text"]
    if order_by is None:
        return values.select(*keys).distinct()
    return values.groupBy(*keys).agg(F.min("place").alias("place"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact number of distinct present values per column: (ordinal, unique)."""
    return _counts_of(distinct_values_long(df, columns))


def _counts_of(values: DataFrame) -> DataFrame:
    return values.groupBy("ordinal").agg(F.count(F.lit(1)).alias("unique"))


def _approximate_counts(df: DataFrame, rsd: float) -> DataFrame:
    numbered = list(enumerate(df.schema.fields))
    aggregates = [
        F.approx_count_distinct(_first_slot(field), rsd).alias(f"u{i}") for i, field in numbered
    ]
    rows = [cell for i, _ in numbered for cell in (F.lit(i), F.col(f"u{i}"))]
    return df.agg(*aggregates).select(F.stack(F.lit(len(numbered)), *rows).alias("ordinal", "unique"))


def _first_slot(field: T.StructField) -> Column:
    whole, real, text = _value_slots(field, keep_long_text=True)
    if isinstance(field.dataType, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType)):
        return whole
    return real if is_fractional(field.dataType) else text


def _examples_of(df: DataFrame, values: DataFrame, n: int, ordered: bool, repeated: bool = False) -> DataFrame:
    """(ordinal, rank, value) for the first n distinct values of each column; `repeated` tells that values may hold a value more than once.

    First means smallest `place` when there is one, else smallest number, or for texts smallest
    MD5 draw. The smallest value of each of 64 hash parts of a column bounds what can be among its
    first n, so that only a handful of values is ever sorted. The few long texts chosen are looked
    up by digest; without any, Spark drops that second scan at run time.
    """
    places = ["place"] if ordered else ["whole", "real", "draw"]
    if not ordered:
        values = values.withColumn("draw", F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("bigint"))
    order = [F.col(p).asc() for p in places]
    part = F.pmod(F.xxhash64("whole", "real", "text"), F.lit(64))
    # The count keeps Spark from dropping the distinct step below minima and reading the source again.
    firsts = values.groupBy("ordinal", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), *[F.min(p).alias(p) for p in places])
    firsts = firsts.where("n > 0")
    # One row per column that has n parts.
    bounds = top_n(firsts, ["ordinal"], order, n).where(F.col("rank") == n)
    bounds = bounds.select("ordinal", *[F.col(p).alias(f"{p}_bound") for p in places])
    close = reduce(lambda a, b: a & b, [F.coalesce(F.col(p) <= F.col(f"{p}_bound"), F.lit(True)) for p in places])
    near = values.join(F.broadcast(bounds), "ordinal", "left").where(close)
    if repeated:
        keys = ["ordinal", "whole", "real", "text"]
        near = near.groupBy(*keys).agg(F.min("place").alias("place")) if ordered else near.select(*keys, "draw").distinct()
    chosen =top_n(near, ["ordinal"], [*order, F.col("whole").asc(), F.col("real").asc(), F.col("text").asc()], n)
    digest = F.octet_length("text") > LONG_TEXT_BYTES
    numbered = list(enumerate(df.schema.fields))
    texts = [
        (i, f) for i, f in numbered
        if not is_summary_numeric(f.dataType) and not isinstance(f.dataType, (T.DateType, T.TimestampType))
    ]
    if not texts:
        return chosen.select("ordinal", "rank", _slots_as_text(numbered).alias("value"))
    # At most n digests per column, so the broadcast is bounded by the schema.
    wanted = chosen.where(digest).select("ordinal", F.col("text").alias("digest"))
    whole_texts = (
        _long_values(df, texts, keep_long_text=True)
        .where(is_long_text(F.col("text")))
        .select("ordinal", text_key(F.col("text")).alias("digest"), F.col("text").alias("whole_text"))
        .join(F.broadcast(wanted), ["ordinal", "digest"])
        .groupBy("ordinal", "digest")
        .agg(F.any_value("whole_text").alias("whole_text"))
    )
    return (
        chosen.withColumn("digest", F.when(digest, F.col("text")))
        .join(whole_texts, ["ordinal", "digest"], "left")
        .select("ordinal", "rank", F.coalesce("whole_text", _slots_as_text(numbered)).alias("value"))
    )


def example_values(df: DataFrame, n: int = 3, order_by: str | None = None) -> DataFrame:
    """First n distinct present values of each column as text: (column, rank, value).

    With `order_by` values count in the order in which they are first seen; without it numbers and
    times go by size and texts in a fixed order of their MD5 draws.
    """
    found = _examples_of(df, distinct_values_long(df, order_by=order_by), n, order_by is not None)
    names = F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("ordinal") + 1)
    return found.select(names.alias("column"), "rank", "value")


def column_summary(
    df: DataFrame,
    example_values: int = 3,
    order_by: str | None = None,
    approximate_unique: float | None = None,
) -> DataFrame:
    """One row per column, in schema order: type, counts, share missing, distinct, examples, statistics.

    `approximate_unique` is a relative error; given, the distinct count is a sketch, and only values
    small enough to be an example are shuffled.
    """
    facts = column_facts(df)
    exact = approximate_unique is None
    values = distinct_values_long(df, order_by=order_by) if exact else _long_values(df, list(enumerate(df.schema.fields)), order_by=order_by)
    counts = _counts_of(values) if exact else _approximate_counts(df, approximate_unique)
    result = facts.join(F.broadcast(counts), "ordinal", "left")
    if example_values > 0:
        examples = (
            _examples_of(df, values, example_values, order_by is not None, repeated=not exact)
            .groupBy("ordinal")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("ranked"))
        )
        result = result.join(F.broadcast(examples), "ordinal", "left")
        shown = F.coalesce(F.col("ranked.value"), F.array().cast("array<string>"))
    else:
        shown = F.array().cast("array<string>")
    missing = F.col("n_rows") - F.col("non_null")
    return (
        result.withColumn("missing", missing)
        .withColumn("missing_share", share(missing, F.col("n_rows")))
        .withColumn("unique", F.coalesce(F.col("unique"), F.lit(0).cast("bigint")))
        .withColumn("example_values", shown)
        .orderBy("ordinal")
        .select("ordinal", *SUMMARY_COLUMNS)
    )


def flatten_summary(summary: DataFrame) -> DataFrame:
    """The summary without its example values."""
    return summary.drop("example_values")


def _missing_counts(df: DataFrame) -> DataFrame:
    """(n_rows, ordinal, column, missing_count) from one aggregate per hundred columns."""
    numbered = list(enumerate(df.schema.fields))
    parts = []
    for start in range(0, len(numbered), COLUMNS_PER_AGGREGATE):
        chunk = numbered[start : start + COLUMNS_PER_AGGREGATE]
        aggregates = [F.count(present(field)).alias(f"n{i}") for i, field in chunk]
        rows = [c for i, f in chunk for c in (F.lit(i), F.lit(f.name), F.col("n_rows") - F.col(f"n{i}"))]
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows"), *aggregates).select(
                "n_rows", F.stack(F.lit(len(chunk)), *rows).alias("ordinal", "column", "missing_count")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def missing_table(df: DataFrame) -> DataFrame:
    """Missing count and share per column, largest share first; empty for an empty table."""
    return (
        _missing_counts(df)
        .where(F.col("n_rows") > 0)
        .withColumn("missing_share", share(F.col("missing_count"), F.col("n_rows")))
        .orderBy(F.col("missing_share").desc(), F.col("ordinal").asc())
        .select("column", "missing_count", "missing_share")
    )


def missing_share(df: DataFrame) -> DataFrame:
    """Share of missing values per column, in schema order; NULL for an empty table."""
    ratio = F.try_divide(F.col("missing_count").cast("double"), F.col("n_rows").cast("double"))
    return _missing_counts(df).orderBy("ordinal").select("column", ratio.alias("missing_share"))


def problem_columns(df: DataFrame, min_missing_share: float = 0.3) -> DataFrame:
    """Rows of the missing table whose share reaches the threshold."""
    return missing_table(df).where(F.col("missing_share") >= F.lit(min_missing_share))
