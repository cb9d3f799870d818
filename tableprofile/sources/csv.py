"""CSV source with the missing-value tokens and type inference of a data-frame reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import col

# Texts that are read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MALFORMED = "_malformed_line"
BOOLEAN_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")
WHOLE_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
REAL_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_PATTERN = r"^\s*[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    schema: T.StructType | str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = False,
    file_order: str | None = None,
) -> DataFrame:
    """Read CSV files with a header line; ValueError if they are absent or unreadable.

    `file_order` adds a column of that name by which rows sort as in the files read one after the
    other in order of their paths; give it as `order_by` to the functions that look for first values.

    Without a schema the types are inferred in one aggregate over the whole input: int, bigint,
    double or boolean if every present value fits, else string; dates stay strings. Large inputs
    should come with a schema, which leaves a single lazy scan. `multi_line` admits line breaks
    in quoted values, at the price of unsplit files; charsets with wide line breaks (UTF-16, UTF-32)
    need it and get it. A charset outside Spark's own list needs
    `spark.sql.legacy.javaCharsets=true` in the session.
    """
    whole_files = multi_line or encoding.upper().startswith(("UTF-16", "UTF-32"))
    options = dict(header=True, sep=sep, encoding=encoding, quote='"', escape='"', multiLine=whole_files)
    try:
        lines = _checked_lines(spark, path, options)
        if file_order in lines.columns:
            raise ValueError(f"the files have a column {file_order}")
        cleaned = [_without_tokens(name, na_tokens) for name in lines.columns]
        texts = lines.select(*cleaned)
        types = _declared(texts, schema) if schema is not None else _inferred(texts)
        place = [] if file_order is None else [place_in_files().alias(file_order)]
        typed = [_typed(col(n), t).alias(n) for n, t in types.items()]
        return lines.select(*cleaned, *place).select(*typed, *([col(file_order)] if place else []))
    except PySparkException as error:
        raise ValueError(f"cannot read CSV {path}: {error}") from error


def place_in_files() -> Column:
    """Where a row of a file scan stands: path, start of its block, and a number that grows inside the block.

    Only for rows as they come from the scan, before any shuffle. Spark reads a block in one task from
    its start to its end, so the running number of the task orders the rows of a block; how blocks are
    dealt to tasks does not matter, and a task that runs again gives its rows the same order.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )


def _checked_lines(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """All columns as text; a line with more fields than the header stops the read.

    Missing fields at the end of a line are missing values. Only lines of the wrong length, which
    Spark hands over as they are, are looked at twice.
    """
    plain = spark.read.csv(path, inferSchema=False, **options).columns
    if not plain:
        raise ValueError(f"no header and no rows: {path}")
    # Spark renames headers that repeat or differ only in case, and then no header equals its name.
    header = spark.read.csv(path, **{**options, "header": False}).first()
    changed = header is not None and any(h is not None and h != n for h, n in zip(header, plain))
    names = _unlike(header, plain) if changed else plain
    texts = [T.StructField(name, T.StringType()) for name in names]
    schema = T.StructType([*texts, T.StructField(MALFORMED, T.StringType())])
    # With pruning, Spark looks at the length of no line.
    reader = spark.read.schema(schema).option("columnPruning", False)
    lines = reader.csv(path, columnNameOfCorruptRecord=MALFORMED, enforceSchema=changed, **options)
    widened = T.StructType([*texts, T.StructField("_further", T.StringType())])
    parts = F.from_csv(MALFORMED, widened.toDDL(), {k: options[k] for k in ("sep", "quote", "escape")})
    too_long = parts["_further"].isNotNull()
    stop = F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(MALFORMED))).cast("boolean")
    # Naming a data column too keeps Spark's parser at work when a query needs no other column.
    fine = F.when(F.col(MALFORMED).isNull(), F.lit(True)).when(too_long & col(names[0]).isNull(), stop).when(too_long, stop)
    return lines.where(fine.otherwise(F.lit(True))).select(*[col(name) for name in names])


def _unlike(header: Sequence[str | None], plain: Sequence[str]) -> list[str]:
    """The names of the header, those that came before (in any case) with a running number: id, ID.1."""
    names: list[str] = []
    for title, given in zip(header, plain):
        base = given if title is None else title
        name, n = base, 0
        while name.casefold() in {x.casefold() for x in names}:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return names


def _without_tokens(name: str, tokens: Sequence[str]) -> Column:
    return F.when(~col(name).isin(list(tokens)), col(name)).alias(name)


def _declared(texts: DataFrame, schema: T.StructType | str) -> dict[str, T.DataType]:
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if [f.name for f in wanted.fields] != texts.columns:
        raise ValueError(f"the header names {texts.columns} differ from the schema")
    return {f.name: f.dataType for f in wanted.fields}


def _inferred(texts: DataFrame) -> dict[str, T.DataType]:
    """Narrowest type that holds every present value of a column."""
    tests = []
    for i, name in enumerate(texts.columns):
        value = col(name)
        whole = value.rlike(WHOLE_PATTERN)
        real = value.rlike(REAL_PATTERN) | value.rlike(INFINITY_PATTERN)
        tests += [
            F.count(value).alias(f"n{i}"),
            F.count_if(whole & value.try_cast("int").isNotNull()).alias(f"int{i}"),
            F.count_if(whole & value.try_cast("bigint").isNotNull()).alias(f"bigint{i}"),
            F.count_if(real).alias(f"double{i}"),
            F.count_if(value.isin(*BOOLEAN_TOKENS)).alias(f"boolean{i}"),
        ]
    found = texts.agg(*tests).first()
    types = {}
    for i, name in enumerate(texts.columns):
        fitting = [t for t in ("int", "bigint", "double", "boolean") if found[f"{t}{i}"] == found[f"n{i}"] > 0]
        types[name] = T._parse_datatype_string(fitting[0]) if fitting else T.StringType()
    return types


def _typed(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        value = F.trim(value)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        endless = value.rlike(INFINITY_PATTERN)
        signed = F.when(value.startswith("-"), F.lit("-Infinity")).otherwise(F.lit("Infinity"))
        value = F.when(endless, signed).otherwise(value)
    return value.cast(dtype)


def require_rows(df: DataFrame) -> DataFrame:
    """The table itself; ValueError if it has no rows."""
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df
