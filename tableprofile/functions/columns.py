"""Column classes, missing-value rules and value keys shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts longer than this many bytes travel through shuffles as a digest.
LONG_TEXT_BYTES = 64
DIGEST_TAG = "sha256:"


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fields(df: DataFrame, columns: Sequence[str] | None = None) -> list[T.StructField]:
    """Schema fields of the chosen columns, in schema order; unknown names are an error."""
    if columns is None:
        return list(df.schema.fields)
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {', '.join(missing)}")
    wanted = set(columns)
    return [field for field in df.schema.fields if field.name in wanted]


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_summary_numeric(dtype: T.DataType) -> bool:
    """Columns that get numeric statistics: numbers and booleans."""
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def is_categorical(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def summary_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_summary_numeric(f.dataType)]


def numeric_columns(df: DataFrame, max_columns: int | None = None) -> list[str]:
    """Columns for correlation and histograms: numbers, but not booleans."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return names[:max_columns]


def categorical_columns(df: DataFrame, max_columns: int | None = None) -> list[str]:
    names = [f.name for f in df.schema.fields if is_categorical(f.dataType)]
    return names[:max_columns]


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Every column but the excluded ones (identifier, target), in schema order."""
    dropped = set(exclude)
    return [name for name in df.columns if name not in dropped]


def present(field: T.StructField) -> Column:
    """The column with NaN turned into NULL, so that NULL is the only missing value."""
    column = col(field.name)
    if is_fractional(field.dataType):
        return F.nullif(column, F.lit(float("nan")).cast(field.dataType))
    return column


def is_missing(df: DataFrame, name: str) -> Column:
    """Boolean column: NULL, or NaN in a floating-point column."""
    return present(fields(df, [name])[0]).isNull()


def normalize_missing(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in all floating-point columns."""
    return df.select(*[present(f).alias(f.name) for f in df.schema.fields])


def is_long_text(column: Column) -> Column:
    return F.octet_length(column) > LONG_TEXT_BYTES


def text_key(column: Column) -> Column:
    """A short stand-in that is equal exactly when the whole texts are equal.

    Long texts become a tagged SHA-256 digest of the whole text; the tagged digest is longer
    than any text left as it is, so the two kinds never meet.
    """
    digest = F.concat(F.lit(DIGEST_TAG), F.sha2(column.cast("binary"), 256))
    return F.when(is_long_text(column), digest).otherwise(column)


def clamp(column: Column, low: float, high: float) -> Column:
    """The value moved into low..high; NULL and NaN stay as they are."""
    return F.when(column < low, F.lit(low)).when((column > high) & ~F.isnan(column), F.lit(high)).otherwise(column)


def clamp_unit(column: Column) -> Column:
    return clamp(column, 0.0, 1.0)


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
