"""Descriptive statistics, histograms, box plots, binned means and missing-value patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.binning import bin_column, bin_edge, equal_width_bin
from tableprofile.functions.columns import col, fields, is_missing, numeric_columns, present
from tableprofile.functions.small import null_safe_on, settle
from tableprofile.operators.ordered import add_bucket, totals_above
from tableprofile.operators.profile import column_facts
from tableprofile.operators.quantiles import exact_quantiles

WHISKER = 1.5


def _cells(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Present values of numeric columns as rows (ordinal, value)."""
    cells = []
    for i, field in enumerate(df.schema.fields):
        if field.name in names:
            cells += [F.lit(i), present(field).cast("double")]
    return df.select(F.stack(F.lit(len(cells) // 2), *cells).alias("ordinal", "value")).where("value is not null")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) of numeric columns, exact quartiles.

    A column without values keeps its row, with count 0 and NULL statistics.
    """
    names = [n for n in numeric_columns(df) if columns is None or n in columns]
    if not names:
        schema = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
        return df.sparkSession.createDataFrame([], schema)
    chosen = df.select(*[col(n) for n in names])
    facts = column_facts(chosen).select("ordinal", "name", "non_null", *["mean", "std", "min", "max"])
    quarters = exact_quantiles(
        _cells(chosen, names), ["ordinal"], "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], few_groups=True
    )
    return (
        facts.join(quarters.select("ordinal", "q25", "q50", "q75"), "ordinal", "left")
        .orderBy("ordinal")
        .select(
            F.col("name").alias("column"), F.col("non_null").alias("count"),
            "mean", "std", "min", "q25", "q50", "q75", "max",
        )
    )


def histogram_bins(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 20,
    max_columns: int | None = None,
) -> DataFrame:
    """(position, column, bin, bin_low, bin_high, count): equal-width bins, empty bins included.

    All numeric columns, or the first max_columns if that is given. Columns without values have no
    rows but keep their position. A column with a single value is binned on value - 0.5 .. value +
    0.5. An infinity in a column is an error: no bins of equal width hold it.
    """
    names = [n for n in numeric_columns(df) if columns is None or n in columns][:max_columns]
    if not names:
        schema = "position int, column string, bin int, bin_low double, bin_high double, count bigint"
        return df.sparkSession.createDataFrame([], schema)
    chosen = df.select(*[col(n) for n in names])
    flat = F.col("min") == F.col("max")
    limits = column_facts(chosen).where("min is not null").select(
        "ordinal", "name",
        F.when((F.col("min") == float("-inf")) | (F.col("max") == float("inf")), F.raise_error(F.concat(F.lit("infinite values in "), F.col("name"))).cast("double"))
        .when(flat, F.col("min") - 0.5).otherwise(F.col("min")).alias("low"),
        F.when(flat, F.col("max") + 0.5).otherwise(F.col("max")).alias("high"),
    )
    # One row of limits per column: the broadcast is bounded by their number.
    counts = (
        _cells(chosen, names)
        .join(F.broadcast(limits), "ordinal")
        .groupBy("ordinal", equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .count()
    )
    frame = limits.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        frame.join(counts, ["ordinal", "bin"], "left")
        .orderBy("ordinal", "bin")
        .select(
            (F.col("ordinal") + 1).alias("position"),
            F.col("name").alias("column"),
            "bin",
            bin_edge(F.col("low"), F.col("high"), bins, F.col("bin")).alias("bin_low"),
            bin_edge(F.col("low"), F.col("high"), bins, F.col("bin") + 1).alias("bin_high"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        )
    )


def boxplot_stats(df: DataFrame, category: str, measure: str) -> DataFrame:
    """Box-plot numbers of a measure per category.

    (category, n, min, q1, median, q3, max, whisker_low, whisker_high, n_outliers). Whiskers end
    at the outermost values within 1.5 interquartile ranges of the box, and never inside the box.
    """
    rows = df.select(
        present(fields(df, [category])[0]).alias("category"),
        present(fields(df, [measure])[0]).cast("double").alias("value"),
    ).where("category is not null and value is not null")
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    boxes = settle(
        exact_quantiles(rows, ["category"], "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
        .withColumn("fence_low", F.col("q1") - reach)
        .withColumn("fence_high", F.col("q3") + reach)
    )
    value = F.col("value")
    stats = ["n", "min", "q1", "median", "q3", "max"]
    fences = boxes.select("category", "q1", "q3", "fence_low", "fence_high")
    ends = (
        rows.join(fences, "category")
        .groupBy("category", "q1", "q3")
        .agg(
            F.min(F.when(value >= F.col("fence_low"), value)).alias("low"),
            F.max(F.when(value <= F.col("fence_high"), value)).alias("high"),
            # The outermost values within the fences end the whiskers, so what lies beyond a
            # fence lies beyond its whisker.
            F.count_if((value < F.col("fence_low")) | (value > F.col("fence_high"))).alias("n_outliers"),
        )
        .select(
            "category",
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
            "n_outliers",
        )
    )
    return (
        ends.join(boxes.select("category", *stats), "category")
        .orderBy("category")
        .select(F.col("category").alias(category), *stats, "whisker_low", "whisker_high", "n_outliers")
    )


def bin_means(
    df: DataFrame,
    column: str,
    measures: Sequence[str],
    edges: Sequence[float],
    labels: Sequence[str],
) -> DataFrame:
    """(bin, mean_<measure>...) for each labelled bin in order, bins without rows included."""
    wanted = fields(df, measures)
    means = [F.avg(f"m{i}").alias(f"mean_{f.name}") for i, f in enumerate(wanted)]
    found = (
        df.select(bin_column(col(column), edges, labels).alias("bin"), *[present(f).cast("double").alias(f"m{i}") for i, f in enumerate(wanted)])
        .where("bin is not null")
        .groupBy("bin")
        .agg(*means)
    )
    frame = df.sparkSession.createDataFrame(list(enumerate(labels)), "bin_order int, bin string")
    # Both sides have at most one row per label.
    return frame.join(F.broadcast(found), "bin", "left").orderBy("bin_order").drop("bin_order")


def missing_mask(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every row as booleans, true where the value is missing; `keep` columns stay as they are."""
    kept = [col(name) for name in keep]
    return df.select(*kept, *[is_missing(df, name).alias(name) for name in df.columns if name not in keep])


def missing_patterns(df: DataFrame) -> DataFrame:
    """(pattern, n_rows): each combination of missing columns that occurs, most frequent first.

    The pattern has one character per column in schema order, 1 where the value is missing.
    """
    bits = [F.when(is_missing(df, name), F.lit("1")).otherwise(F.lit("0")) for name in df.columns]
    counted = df.groupBy(F.concat(*bits).alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.orderBy(F.col("n_rows").desc(), F.col("pattern").asc())


def missing_blocks(df: DataFrame, order_by: str, blocks: int = 100) -> DataFrame:
    """(block, column, n_rows, missing_share): the missing matrix condensed to equal ranges of a number.

    Rows are laid out by `order_by`, cut in `blocks` ranges of equal width; rows without it fall
    in block -1.
    """
    place = present(fields(df, [order_by])[0]).cast("double")
    low, high = df.agg(F.min(place)).scalar(), df.agg(F.max(place)).scalar()
    names = [n for n in df.columns if n != order_by]
    marks = [is_missing(df, name).cast("int").alias(f"m{i}") for i, name in enumerate(names)]
    block = F.when(F.col("place").isNull(), F.lit(-1)).when(F.col("low") == F.col("high"), F.lit(0)).otherwise(
        equal_width_bin(F.col("place"), F.col("low"), F.col("high"), blocks)
    )
    cells = [c for i, name in enumerate(names) for c in (F.lit(i), F.lit(name), F.col(f"s{i}"))]
    return (
        df.select(place.alias("place"), low.alias("low"), high.alias("high"), *marks)
        .groupBy(block.alias("block"))
        .agg(F.count(F.lit(1)).alias("n_rows"), *[F.avg(f"m{i}").alias(f"s{i}") for i in range(len(names))])
        .select("block", "n_rows", F.stack(F.lit(len(names)), *cells).alias("ordinal", "column", "missing_share"))
        .orderBy("block", "ordinal")
        .select("block", "column", "n_rows", "missing_share")
    )


def missing_matrix(df: DataFrame, order_by: str, blocks: int = 100) -> DataFrame:
    """(block, first_row, n_rows, column, missing_share): the missing matrix by row position, in blocks of equal row count.

    Rows are numbered from 0 in the order of a number, rows without it last, equal ones by their
    pattern of missing columns; row i of n lies in block floor(i * blocks / n). With fewer rows than
    blocks some blocks have no row and are left out.

    Rows never travel one by one: equal rows (same number, same pattern) are counted inside the
    tasks, and running totals of these counts, by bucket and then inside each bucket, tell which
    positions and so which blocks they fill. A number that very many rows share is one row per
    pattern.
    """
    names = [n for n in df.columns if n != order_by]
    place = present(fields(df, [order_by])[0]).cast("double")
    bits = [F.when(is_missing(df, name), F.lit("1")).otherwise(F.lit("0")) for name in names]
    rows = df.select(place.alias("place"), F.concat(F.lit(""), *bits).alias("pattern"))
    known = add_bucket(rows.where("place is not null"), "place").groupBy("bucket", "place", "pattern").agg(F.count(F.lit(1)).alias("c"))
    ranked = totals_above(known, [], "place", "bucket", ["c"], ties=["pattern"])
    ranked = ranked.select("pattern", "c", (F.col("c_total") - F.col("c_above") - F.col("c")).alias("before"))
    # Rows without a place follow, one running total over as many rows as there are patterns of them.
    lost = rows.where("place is null").groupBy("pattern").agg(F.count(F.lit(1)).alias("c"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("pattern").rowsBetween(Window.unboundedPreceding, -1)
    n_known = df.select(place.alias("place")).agg(F.count("place")).scalar()
    lost = lost.select("pattern", "c", (n_known + F.coalesce(F.sum("c").over(earlier), F.lit(0))).alias("before"))
    n = df.agg(F.count(F.lit(1))).scalar()
    runs = ranked.unionByName(lost).withColumn("n", n).withColumn("until", F.col("before") + F.col("c"))
    filled = runs.withColumn("block", F.explode(F.expr(f"sequence(before * {blocks} div n, (until - 1) * {blocks} div n)")))
    # Block b holds the rows from ceil(b n / blocks) on.
    start, stop = (F.expr(f"(({b}) * n + {blocks - 1}) div {blocks}") for b in ("block", "block + 1"))
    share = F.least("until", stop) - F.greatest("before", start)
    counted = filled.where(share > 0).groupBy("block", start.alias("first_row"), "pattern").agg(F.sum(share).alias("rows"))
    marks = [F.sum(F.when(F.substring("pattern", i + 1, 1) == "1", F.col("rows")).otherwise(0)).alias(f"s{i}") for i in range(len(names))]
    sums = counted.groupBy("block", "first_row").agg(F.sum("rows").alias("n_rows"), *marks)
    cells = [c for i, name in enumerate(names) for c in (F.lit(i), F.lit(name), F.col(f"s{i}") / F.col("n_rows"))]
    if not names:
        return df.sparkSession.createDataFrame([], "block bigint, first_row bigint, n_rows bigint, column string, missing_share double")
    shares = sums.select("block", "first_row", "n_rows", F.stack(F.lit(len(names)), *cells).alias("ordinal", "column", "missing_share"))
    return shares.orderBy("block", "ordinal").select("block", "first_row", "n_rows", "column", "missing_share")
