"""The whole report of a table: its facts as rows and its tables as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.columns import categorical_columns, numeric_columns
from tableprofile.functions.small import settle
from tableprofile.operators.distribution import histogram_bins, missing_patterns
from tableprofile.operators.frequency import top_categories
from tableprofile.operators.profile import column_summary, flatten_summary
from tableprofile.operators.quality import quality_flags_from_summary
from tableprofile.operators.relations import correlation_long, correlation_matrix

TOP_K = 5
MIN_MISSING_SHARE = 0.3


def missing_from_summary(summary: DataFrame) -> DataFrame:
    """The missing table out of a finished summary."""
    return (
        summary.where((F.col("non_null") + F.col("missing")) > 0)
        .orderBy(F.col("missing_share").desc(), F.col("ordinal").asc())
        .select(F.col("name").alias("column"), F.col("missing").alias("missing_count"), "missing_share")
    )


def report_metrics(
    df: DataFrame,
    source: str = "",
    max_hist_columns: int | None = None,
    max_top_columns: int | None = None,
    top_k_categories: int = TOP_K,
    min_missing_share: float = MIN_MISSING_SHARE,
    summary: DataFrame | None = None,
) -> DataFrame:
    """(position, section, metric, value): shape, parameters, quality and which sections exist. No limit means all columns."""
    if summary is None:
        summary = column_summary(df, example_values=0)
    filled = F.col("non_null") > 0
    numbers = numeric_columns(df, max_hist_columns)
    texts = categorical_columns(df, max_top_columns)
    facts = quality_flags_from_summary(summary, [
        F.count_if(F.col("name").isin(texts) & filled).alias("tops"),
        F.count_if(F.col("name").isin(numbers) & filled).alias("histograms"),
        F.count_if(F.col("missing_share") >= F.lit(min_missing_share)).alias("problems"),
    ])
    rows_exist = F.col("n_rows") > 0
    entries: list[tuple[str, str, Column]] = [
        ("source", "name", F.lit(source)),
        ("shape", "n_rows", F.col("n_rows").cast("string")),
        ("shape", "n_cols", F.col("n_cols").cast("string")),
        ("parameters", "max_hist_columns", F.lit(str(max_hist_columns))),
        ("parameters", "top_k_categories", F.lit(str(top_k_categories))),
        ("parameters", "min_missing_share", F.format_string("%.1f%%", F.lit(min_missing_share * 100))),
        ("quality", "quality_score", F.format_string("%.2f", F.col("quality_score"))),
        ("quality", "max_missing_share", F.format_string("%.2f%%", F.col("max_missing_share") * 100)),
        *[
            ("quality", name, F.col(name).cast("string"))
            for name in (
                "too_few_rows", "too_many_columns", "too_many_missing",
                "has_constant_columns", "has_high_cardinality_categoricals",
            )
        ],
        ("missing", "problem_columns", F.col("problems").cast("string")),
        ("sections", "missing", rows_exist.cast("string")),
        ("sections", "correlation", (rows_exist & F.lit(bool(numeric_columns(df)))).cast("string")),
        ("sections", "top_categories", (F.col("tops") > 0).cast("string")),
        ("sections", "histograms", F.col("histograms").cast("string")),
    ]
    cells = [c for i, (section, metric, value) in enumerate(entries) for c in (F.lit(i), F.lit(section), F.lit(metric), value)]
    return facts.select(F.stack(F.lit(len(entries)), *cells).alias("position", "section", "metric", "value"))


def write_report(
    df: DataFrame,
    out_dir: str,
    source: str = "",
    max_hist_columns: int | None = None,
    max_top_columns: int | None = None,
    top_k_categories: int = TOP_K,
    min_missing_share: float = MIN_MISSING_SHARE,
    file_format: str = "csv",
    mode: str = "errorifexists",
) -> None:
    """Write summary, missing, correlation, top_categories, report, missing_patterns, heatmap and histograms under out_dir.

    The last three are the numbers behind drawings; histograms come at the end, as an infinity in a
    column is an error there. Sections without content are skipped. Top values lie in one folder per column. The summary is
    computed once and reused; it has a row per column.
    """

    def write(table: DataFrame, name: str, partition_by: str | None = None) -> None:
        writer = table.write.mode(mode).format(file_format)
        if file_format == "csv":
            writer = writer.option("header", True)
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.save(f"{out_dir.rstrip('/')}/{name}")

    summary = settle(column_summary(df, example_values=0))
    has_rows = not summary.where((F.col("non_null") + F.col("missing")) > 0).isEmpty()
    write(flatten_summary(summary).orderBy("ordinal").drop("ordinal"), "summary")
    if has_rows:
        write(missing_from_summary(summary), "missing")
        if numeric_columns(df):
            write(correlation_matrix(df), "correlation")
    tops = settle(top_categories(df, max_top_columns, top_k_categories))
    if not tops.isEmpty():
        write(tops.orderBy("column", "rank"), "top_categories", partition_by="column")
    facts = report_metrics(df, source, max_hist_columns, max_top_columns, top_k_categories, min_missing_share, summary)
    write(facts.orderBy("position"), "report")
    if has_rows:
        write(missing_patterns(df), "missing_patterns")
        if numeric_columns(df):
            write(correlation_long(df), "heatmap")
            write(histogram_bins(df, max_columns=max_hist_columns), "histograms")
