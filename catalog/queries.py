"""One query per operator: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableprofile.functions import arrays as A
from tableprofile.functions.binning import bin_column
from tableprofile.functions.columns import feature_columns, numeric_columns
from tableprofile.functions.small import shared_folder
from tableprofile.operators import checks, distribution, frequency, grouping, metrics, modeling, profile, quality, relations, states
from tableprofile.plans.report import missing_from_summary, report_metrics, write_report
from tableprofile.sources.csv import read_csv, require_rows
from tableprofile.streaming import verdicts
from tableprofile.streaming.scoring import scored_stream, write_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder every executor can reach."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


# The test tables have no missing values; these put some in, as NULL and as NaN.


def orders_with_gaps(spark, folder):
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    return table(spark, folder, "orders").withColumn("o_totalprice", price)


def lineitem_with_gaps(spark, folder):
    return table(spark, folder, "lineitem").withColumns({
        "l_discount": F.nullif("l_discount", F.lit(0.0)),
        "l_tax": F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")),
    })


def customer_with_constant(spark, folder):
    return table(spark, folder, "customer").withColumns({
        "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
        "c_source": F.lit("crm"),
    })


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- profile -----------------------------------------------------------------------------


@query
def column_summary(spark, folder):
    summary = profile.column_summary(orders_with_gaps(spark, folder))
    summary = summary.withColumn("example_values", F.array_join("example_values", "|"))
    return rounded(summary, 6, "missing_share", "mean", "std")


@query
def column_summary_texts(spark, folder):
    summary = profile.column_summary(table(spark, folder, "documents"))
    summary = summary.withColumn("example_values", F.md5(F.array_join("example_values", "|")))
    return rounded(summary, 6, "missing_share", "mean", "std")


@query
def flatten_summary(spark, folder):
    summary = profile.column_summary(table(spark, folder, "supplier"), example_values=0)
    return rounded(profile.flatten_summary(summary), 6, "mean", "std")


@query
def example_values(spark, folder):
    return profile.example_values(table(spark, folder, "events").drop("ts", "value"), n=3, order_by="event_id")


@query
def dataset_profile(spark, folder):
    return profile.dataset_profile(table(spark, folder, "lineitem"))


@query
def schema_table(spark, folder):
    return profile.schema_table(orders_with_gaps(spark, folder))


@query
def missing_table(spark, folder):
    return rounded(profile.missing_table(lineitem_with_gaps(spark, folder)), 9, "missing_share")


@query
def missing_share(spark, folder):
    return rounded(profile.missing_share(lineitem_with_gaps(spark, folder)), 9, "missing_share")


@query
def problem_columns(spark, folder):
    return rounded(profile.problem_columns(lineitem_with_gaps(spark, folder), 0.05), 9, "missing_share")


# --- frequency ---------------------------------------------------------------------------


@query
def value_counts(spark, folder):
    return frequency.value_counts(table(spark, folder, "events"), "event_type")


@query
def value_counts_numbers(spark, folder):
    return frequency.value_counts(lineitem_with_gaps(spark, folder), "l_tax")


@query
def value_shares(spark, folder):
    return rounded(frequency.value_shares(table(spark, folder, "customer"), "c_mktsegment", scale=100), 9, "share")


@query
def top_categories(spark, folder):
    return rounded(frequency.top_categories(table(spark, folder, "part"), max_columns=5), 9, "share")


@query
def top_categories_texts(spark, folder):
    """Whole texts of documents among the columns, many with equal counts."""
    tops = frequency.top_categories(table(spark, folder, "documents").select("text", "lang", "source"))
    return rounded(tops, 9, "share")


@query
def top_categories_heavy(spark, folder):
    """Heavy-hitter counters: proven for the few brands, counted in full for names that hardly repeat."""
    parts = table(spark, folder, "part").select("p_name", "p_brand", "p_type")
    return rounded(frequency.top_categories(parts, counters=64), 9, "share")


@query
def value_counts_texts(spark, folder):
    return frequency.value_counts(table(spark, folder, "documents"), "text")


@query
def distinct_values_texts(spark, folder):
    return frequency.distinct_values(table(spark, folder, "documents"), "text")


@query
def distinct_values(spark, folder):
    return frequency.distinct_values(table(spark, folder, "part"), "p_brand")


@query
def distinct_values_first_seen(spark, folder):
    return frequency.distinct_values(table(spark, folder, "events"), "user_id", order_by="event_id", place="first_event")


# --- quality -----------------------------------------------------------------------------


def _lists_as_text(flags: DataFrame) -> DataFrame:
    lists = ["constant_columns_list", "high_cardinality_categoricals"]
    return flags.withColumns({n: F.array_join(n, "|") for n in lists})


@query
def quality_flags(spark, folder):
    return _lists_as_text(quality.quality_flags(customer_with_constant(spark, folder)))


@query
def quality_flags_from_summary(spark, folder):
    summary = profile.column_summary(customer_with_constant(spark, folder), example_values=0)
    return _lists_as_text(quality.quality_flags_from_summary(summary))


def line_states(spark, folder):
    """States of the line items by line number: some stored, read back and merged, then merged with the rest."""
    path = scratch(spark)
    lines = lineitem_with_gaps(spark, folder)
    states.write_states(states.profile_states(lines.where("l_linenumber <= 3"), F.col("l_linenumber")), path)
    stored = states.merge_states(states.read_states(spark, path), "stored")
    return states.merge_states(stored.unionByName(states.profile_states(lines.where("l_linenumber > 3"), F.col("l_linenumber"))))


@query
def merged_summary(spark, folder):
    """Everything of a merged profile that is exact."""
    found = states.state_summary(line_states(spark, folder)).drop("approx_unique", "approx_quantiles")
    return rounded(found, 6, "missing_share", "mean", "std")


@query
def merged_quality_flags(spark, folder):
    return _lists_as_text(states.state_flags(line_states(spark, folder)))


@query
def quality_verdict(spark, folder):
    return _lists_as_text(quality.quality_verdict(quality.quality_flags(lineitem_with_gaps(spark, folder))))


@query
def boolean_flags(spark, folder):
    flags = quality.boolean_flags(quality.quality_flags(customer_with_constant(spark, folder)))
    return flags.select(F.explode("flags").alias("flag", "value"))


REPORT_FLAGS = [
    "too_few_rows", "too_many_columns", "too_many_missing", "has_constant_columns",
    "has_high_cardinality_categoricals",
]


@query
def quality_report(spark, folder):
    report = quality.quality_report(require_rows(lineitem_with_gaps(spark, folder)))
    return report.select("ok_for_model", "quality_score", "message", "n_rows", "n_cols", *[F.col("flags")[f].alias(f) for f in REPORT_FLAGS])


def supplier_profiles(spark, folder):
    """One profile per supplier, some of them wide, one-sided or invalid."""
    key = F.col("l_suppkey")
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        (F.count(F.lit(1)) * 2 - F.when(key % 9 == 0, 5000).otherwise(0)).alias("n_rows"),
        (95 + key % 12).alias("n_cols"),
        (F.avg((F.col("l_tax") == 0).cast("int")) * (1 + key % 10)).alias("max_missing_share"),
        (key % 4).alias("numeric_cols"),
        (key % 3).alias("categorical_cols"),
    )


PROFILE_FLAGS = ["too_few_rows", "too_many_columns", "too_many_missing", "no_numeric_columns", "no_categorical_columns"]


@query
def validate_profiles(spark, folder):
    return rounded(quality.validate_profiles(supplier_profiles(spark, folder)), 9, "max_missing_share")


@query
def rejected_profiles(spark, folder):
    checked = quality.validate_profiles(supplier_profiles(spark, folder)).where("not is_valid")
    return rounded(checked, 9, "max_missing_share")


@query
def score_profiles(spark, folder):
    valid = quality.validate_profiles(supplier_profiles(spark, folder)).where("is_valid").drop("is_valid")
    scored = quality.score_profiles(valid)
    scored = scored.select("*", *[F.col("flags")[f].alias(f) for f in PROFILE_FLAGS]).drop("flags")
    return rounded(scored, 9, "max_missing_share", "quality_score")


def customer_profiles(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("c_custkey"),
        F.col("c_custkey").alias("n_rows"),
        (F.col("c_nationkey") * 10).cast("bigint").alias("n_cols"),
        (F.col("c_acctbal") / 10000).alias("max_missing_share"),
        (F.col("c_custkey") % 3).alias("numeric_cols"),
        (F.col("c_custkey") % 2).alias("categorical_cols"),
    )


@query
def score_profiles_stream(spark, folder):
    schema = table(spark, folder, "customer").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/customer*.parquet")
    base = scratch(spark)
    write_scores(scored_stream(customer_profiles(stream)), f"{base}/scores", f"{base}/progress").awaitTermination()
    scores = spark.read.parquet(f"{base}/scores")
    return rounded(scores.select("c_custkey", "quality_score", "ok_for_model", *[F.col("flags")[f].alias(f) for f in PROFILE_FLAGS]), 9, "quality_score")


@query
def latest_verdicts_stream(spark, folder):
    """Profiles of every nation in two drops, the second one partly older than the first, worked off in two runs."""
    base = scratch(spark)
    profiles = customer_profiles(table(spark, folder, "customer")).select(
        F.concat(F.lit("nation "), (F.col("n_cols") / 10).cast("int")).alias("table_name"), F.timestamp_seconds("c_custkey").alias("profiled_at"),
        "n_rows", "n_cols", "max_missing_share", "numeric_cols", "categorical_cols",
    )
    for drop in (0, 1):
        profiles.where(F.unix_seconds("profiled_at") % 2 == drop).write.mode("append").parquet(f"{base}/drops")
        arrived = spark.readStream.schema(verdicts.DATED_SCHEMA).parquet(f"{base}/drops")
        verdicts.write_verdicts(verdicts.newest_profiles(arrived, late="36500 days"), f"{base}/verdicts", f"{base}/progress").awaitTermination()
    found = verdicts.current_verdicts(spark, f"{base}/verdicts")
    return rounded(found.select("table_name", F.unix_seconds("profiled_at").alias("at_second"), "quality_score", "ok_for_model"), 9, "quality_score")


# --- relations and distributions ---------------------------------------------------------


@query
def correlation_long(spark, folder):
    lines = lineitem_with_gaps(spark, folder).withColumn("l_constant", F.lit(1.0))
    return rounded(relations.correlation_long(lines), 9, "correlation")


WIDE_COLUMNS = 64


@query
def correlation_wide(spark, folder):
    vectors = table(spark, folder, "embeddings")
    wide = vectors.select(*[
        F.when(F.col("vec_id") % (i + 2) != 0, F.col("embedding")[i].cast("double") + 5).alias(f"d{i}")
        for i in range(WIDE_COLUMNS)
    ])
    return rounded(relations.correlation_long(wide), 9, "correlation")


@query
def correlation_offset(spark, folder):
    """One column far from its other values in the few rows in which its partner is present."""
    few = F.col("l_orderkey") % 50 == 0
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_quantity") + F.when(few, 1e7).otherwise(0.0)).alias("moved"), F.when(few, F.col("l_extendedprice")).alias("seldom"),
        "l_quantity", "l_discount", "l_tax", "l_linenumber",
    )
    return rounded(relations.correlation_long(lines), 6, "correlation")


MATRIX_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def correlation_matrix(spark, folder):
    matrix = relations.correlation_matrix(lineitem_with_gaps(spark, folder), MATRIX_COLUMNS)
    return rounded(matrix, 9, *MATRIX_COLUMNS)


@query
def correlation_heatmap(spark, folder):
    return rounded(relations.correlation_long(table(spark, folder, "part"), min_columns=2), 9, "correlation")


@query
def scatter_points(spark, folder):
    return relations.scatter_points(orders_with_gaps(spark, folder), "o_custkey", "o_totalprice", "o_orderpriority")


@query
def describe_numeric(spark, folder):
    described = distribution.describe_numeric(lineitem_with_gaps(spark, folder))
    return rounded(described, 4, "mean", "std", "q25", "q50", "q75")


@query
def histogram_bins(spark, folder):
    return rounded(distribution.histogram_bins(orders_with_gaps(spark, folder), max_columns=6), 6, "bin_low", "bin_high")


@query
def histogram_age_bins(spark, folder):
    lines = lineitem_with_gaps(spark, folder)
    return rounded(distribution.histogram_bins(lines, ["l_discount", "l_quantity"], bins=10), 6, "bin_low", "bin_high")


@query
def boxplot_stats(spark, folder):
    boxes = distribution.boxplot_stats(orders_with_gaps(spark, folder), "o_orderpriority", "o_totalprice")
    return rounded(boxes, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def boxplot_stats_skewed(spark, folder):
    value = (F.col("l_extendedprice") * F.col("l_extendedprice") * F.col("l_quantity") / 1e6).alias("weight")
    boxes = distribution.boxplot_stats(table(spark, folder, "lineitem").select("l_returnflag", value), "l_returnflag", "weight")
    return rounded(boxes, 4, "min", "max", "q1", "median", "q3", "whisker_low", "whisker_high")


SIZE_EDGES = [0, 10, 20, 35, 50, 200]
SIZE_LABELS = ["<=10", "11-20", "21-35", "36-50", "50+"]


@query
def bin_column_counts(spark, folder):
    parts = table(spark, folder, "part")
    return parts.select("p_partkey", "p_size", bin_column(F.col("p_size") - 5, SIZE_EDGES, SIZE_LABELS).alias("size_bin"))


@query
def bin_means(spark, folder):
    means = distribution.bin_means(table(spark, folder, "part"), "p_size", ["p_retailprice", "p_size"], SIZE_EDGES, SIZE_LABELS)
    return rounded(means, 6, "mean_p_retailprice", "mean_p_size")


@query
def missing_mask(spark, folder):
    return distribution.missing_mask(orders_with_gaps(spark, folder), keep=["o_orderkey"])


@query
def missing_patterns(spark, folder):
    return distribution.missing_patterns(lineitem_with_gaps(spark, folder))


@query
def missing_blocks(spark, folder):
    blocks = distribution.missing_blocks(lineitem_with_gaps(spark, folder), "l_orderkey", 10)
    return rounded(blocks, 9, "missing_share")


@query
def missing_matrix(spark, folder):
    return rounded(distribution.missing_matrix(lineitem_with_gaps(spark, folder), "l_extendedprice", 40), 9, "missing_share")


@query
def missing_matrix_ties(spark, folder):
    """Few different numbers, some of them missing: blocks cut through rows that are equal."""
    lines = lineitem_with_gaps(spark, folder).select("l_discount", "l_tax", "l_linenumber")
    return rounded(distribution.missing_matrix(lines, "l_discount", 17), 9, "missing_share")


# --- checks and grouping -----------------------------------------------------------------


@query
def duplicate_rows(spark, folder):
    return checks.duplicate_rows(table(spark, folder, "documents").select("text", "lang"))


@query
def duplicate_rows_numbers(spark, folder):
    return checks.duplicate_rows(lineitem_with_gaps(spark, folder).select("l_linenumber", "l_quantity", "l_discount", "l_tax"))


@query
def has_duplicates(spark, folder):
    return checks.has_duplicates(table(spark, folder, "documents").select("text", "lang"))


@query
def rule_violations(spark, folder):
    customers = customer_with_constant(spark, folder)
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    found = checks.rule_violations(customers, {
        "low_balance": balance < 500,
        "odd_nation": (nation > 22) | (nation < 2),
        "empty_household": (F.col("c_mktsegment") == "HOUSEHOLD") & (balance < 1000),
    })
    return found.select("c_custkey", F.array_join("violated_rules", "|").alias("violated_rules"))


@query
def range_check(spark, folder):
    return checks.range_check(lineitem_with_gaps(spark, folder), [
        checks.Expected("l_discount", 0.0, 0.05),
        checks.Expected("l_quantity", 1, 50),
        checks.Expected("l_tax", low=0.03),
        checks.Expected("l_linenumber", allowed=[1, 2, 3, 4]),
    ])


@query
def group_stats(spark, folder):
    stats = grouping.group_stats(orders_with_gaps(spark, folder), "o_orderpriority", ["o_totalprice", "o_custkey"])
    return rounded(stats, 2, "sum_o_totalprice", "mean_o_totalprice", "mean_o_custkey")


@query
def category_rows(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_totalprice")


@query
def head_rows(spark, folder):
    return grouping.head_rows(table(spark, folder, "orders"), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


# --- sources and report ------------------------------------------------------------------


@query
def csv_round_trip(spark, folder):
    path = scratch(spark)
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise("NA")
    customers = customer_with_constant(spark, folder).withColumn("c_mktsegment", segment)
    customers.write.csv(path, header=True, sep=";")
    return read_csv(spark, path, sep=";")


@query
def first_seen_in_files(spark, folder):
    """Examples and distinct values in the order of the files, which follow the customer number."""
    path = scratch(spark)
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    customers.repartitionByRange(6, "c_custkey").sortWithinPartitions("c_custkey").write.csv(path, header=True)
    lines = read_csv(spark, path, schema="c_custkey int, c_nationkey int, c_mktsegment string", file_order="place")
    examples = profile.example_values(lines, 3, order_by="place").where("column <> 'place'")
    segments = frequency.distinct_values(lines, "c_mktsegment", order_by="place", place="at")
    # As many rows as there are segments.
    order = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at"))
    return examples.unionByName(segments.select(F.lit("all segments").alias("column"), order.alias("rank"), F.col("c_mktsegment").alias("value")))


@query
def report_metrics_facts(spark, folder):
    return report_metrics(customer_with_constant(spark, folder), source="customer", max_hist_columns=6, max_top_columns=5)


@query
def missing_from_summary_rows(spark, folder):
    summary = profile.column_summary(lineitem_with_gaps(spark, folder), example_values=0, approximate_unique=0.05)
    return rounded(missing_from_summary(summary), 9, "missing_share")


@query
def report_summary_file(spark, folder):
    path = scratch(spark)
    write_report(customer_with_constant(spark, folder), path, source="customer", max_hist_columns=6, max_top_columns=5)
    summary = read_csv(spark, f"{path}/summary")
    return rounded(summary, 6, "missing_share", "min", "max", "mean", "std")


@query
def report_top_files(spark, folder):
    path = scratch(spark)
    write_report(table(spark, folder, "part"), path, file_format="parquet")
    tops = spark.read.parquet(f"{path}/top_categories")
    return rounded(tops.withColumn("column", F.col("column").cast("string")), 9, "share")


@query
def report_missing_file(spark, folder):
    path = scratch(spark)
    write_report(lineitem_with_gaps(spark, folder), path, file_format="parquet")
    return rounded(spark.read.parquet(f"{path}/missing"), 9, "missing_share")


@query
def report_correlation_file(spark, folder):
    path = scratch(spark)
    write_report(lineitem_with_gaps(spark, folder).select(*MATRIX_COLUMNS), path, file_format="parquet")
    matrix = spark.read.parquet(f"{path}/correlation")
    return rounded(matrix, 9, *MATRIX_COLUMNS)


@query
def report_histogram_file(spark, folder):
    path = scratch(spark)
    write_report(orders_with_gaps(spark, folder), path, max_hist_columns=6, file_format="parquet")
    return rounded(spark.read.parquet(f"{path}/histograms"), 6, "bin_low", "bin_high")


@query
def report_patterns_file(spark, folder):
    path = scratch(spark)
    write_report(lineitem_with_gaps(spark, folder), path, file_format="parquet")
    return spark.read.parquet(f"{path}/missing_patterns")


@query
def csv_quality_report(spark, folder):
    """From a CSV file to the verdict."""
    path = scratch(spark)
    lineitem_with_gaps(spark, folder).write.csv(path, header=True)
    report = quality.quality_report(require_rows(read_csv(spark, path)))
    return report.select("ok_for_model", "quality_score", "message", "n_rows", "n_cols", *[F.col("flags")[f].alias(f) for f in REPORT_FLAGS])


# --- arrays ------------------------------------------------------------------------------


@query
def array_features(spark, folder):
    vector = F.col("embedding")
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.array_join(A.array_zeros(6).cast("array<string>"), ",").alias("zeros"),
        F.array_join(A.array_ones(6).cast("array<string>"), ",").alias("ones"),
        F.array_join(A.array_range(0, 6).cast("array<string>"), ",").alias("numbers"),
        A.array_item(vector, 2).cast("double").alias("third"),
        A.array_item(A.array_reshape(vector, 8, 8), 1, 3).cast("double").alias("second_row_fourth"),
        F.round(F.aggregate(A.array_slice(vector, 3, 6), F.lit(0.0), lambda a, x: a + x.cast("double")), 9).alias("slice_sum"),
    )


@query
def array_reshape(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode(A.array_reshape(F.col("embedding"), 4, 16)).alias("row", "items"))
    return rows.select("vec_id", "row", F.posexplode("items").alias("column", "item")).withColumn("item", F.col("item").cast("double"))


@query
def array_shape(spark, folder):
    vectors = table(spark, folder, "embeddings")
    shape = A.array_shape(A.array_reshape(F.col("embedding"), 4, 16), 2)
    return vectors.select("vec_id", shape[0].alias("rows"), shape[1].alias("columns"), F.typeof(F.col("embedding")[0]).alias("item_type"))


@query
def array_elementwise(spark, folder):
    vector, other = F.col("embedding").cast("array<double>"), F.reverse(F.col("embedding")).cast("array<double>")
    pairs = F.arrays_zip(A.array_sum(vector, other).alias("total"), A.array_product(vector, other).alias("product"))
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode(pairs).alias("position", "pair"))
    return rows.select("vec_id", "position", F.round("pair.total", 9).alias("total"), F.round("pair.product", 9).alias("product"))


@query
def array_stats(spark, folder):
    vector = F.col("embedding")
    return table(spark, folder, "embeddings").select(
        "vec_id", F.round(A.array_mean(vector), 9).alias("mean"), F.round(A.array_std(vector), 9).alias("std")
    )


# --- models and metrics ------------------------------------------------------------------


@query
def stratified_split(spark, folder):
    return modeling.stratified_split(table(spark, folder, "labels"), "quality", "doc_id")


@query
def stratified_split_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return modeling.stratified_split(orders, "o_orderpriority", "o_orderkey")


@query
def split_balance(spark, folder):
    split = modeling.stratified_split(table(spark, folder, "labels"), "quality", "doc_id")
    return rounded(modeling.split_balance(split, "quality"), 9, "share")


@query
def prior_baseline(spark, folder):
    split = modeling.stratified_split(table(spark, folder, "labels"), "quality", "doc_id")
    guessed = modeling.prior_baseline(split, split.where("split = 'train'"), "quality", "doc_id")
    return guessed.select("doc_id", "split", "baseline_prediction")


def scored_documents(spark, folder):
    """Labelled documents with a score from their length alone, and a guess from the score."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    score = F.col("n_chars") / (F.col("n_chars") + 1000)
    joined = table(spark, folder, "labels").join(documents, "doc_id").withColumn("score", score)
    return joined.withColumn("guess", (F.col("score") > 0.5).cast("int"))


def scored_lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.col("l_linestatus"),
        (F.col("l_extendedprice") * (F.lit(1) + F.col("l_discount"))).alias("score"),
        (F.col("l_extendedprice") > 50000).cast("int").alias("guess"),
    )


@query
def binary_metrics(spark, folder):
    found = metrics.binary_metrics(scored_documents(spark, folder), "quality", "guess")
    return rounded(found, 9, "accuracy", "precision", "recall", "f1")


@query
def binary_metrics_grouped(spark, folder):
    found = metrics.binary_metrics(scored_lines(spark, folder), "returned", "guess", ["l_linestatus"])
    return rounded(found, 9, "accuracy", "precision", "recall", "f1")


@query
def confusion_counts(spark, folder):
    return metrics.confusion_counts(scored_lines(spark, folder), "returned", "guess")


@query
def classification_report(spark, folder):
    report = metrics.classification_report(scored_documents(spark, folder), "quality", "guess", {0: "low", 1: "high"})
    return rounded(report, 9, "precision", "recall", "f1")


@query
def metric_gain(spark, folder):
    split = modeling.stratified_split(scored_documents(spark, folder), "quality", "doc_id")
    guessed = modeling.prior_baseline(split, split.where("split = 'train'"), "quality", "doc_id").where("split = 'test'")
    ours = metrics.binary_metrics(guessed, "quality", "guess")
    theirs = metrics.binary_metrics(guessed, "quality", "baseline_prediction")
    gain = metrics.metric_gain(ours, theirs, ["accuracy", "precision", "recall", "f1"])
    areas = [metrics.roc_auc(guessed, "quality", score) for score in ("score", "baseline_prediction")]
    return rounded(gain.union(metrics.metric_gain(*areas, ["roc_auc"])), 9, "value", "baseline", "gain_points")


@query
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(scored_documents(spark, folder), "quality", "score"), 9, "roc_auc")


@query
def roc_auc_grouped(spark, folder):
    return rounded(metrics.roc_auc(scored_lines(spark, folder), "returned", "score", ["l_linestatus"]), 9, "roc_auc")


@query
def best_model(spark, folder):
    """The line number whose prices tell returned lines apart best, in the place of the best C."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("c"), (F.col("l_returnflag") == "R").cast("int").alias("returned"), "l_extendedprice"
    )
    areas = metrics.roc_auc(lines, "returned", "l_extendedprice", ["c"])
    return rounded(modeling.best_model(areas), 9, "roc_auc")


@query
def roc_curve(spark, folder):
    curve = metrics.roc_curve(scored_lines(spark, folder), "returned", "score")
    return rounded(curve, 9, "threshold", "fpr", "tpr")


@query
def roc_curve_thinned(spark, folder):
    curve = metrics.roc_curve(scored_lines(spark, folder), "returned", "score", drop_intermediate=True)
    return rounded(curve, 9, "threshold", "fpr", "tpr")


@query
def roc_curve_guess(spark, folder):
    """The curve of hard predictions, as of the baseline: two scores and the start."""
    curve = metrics.roc_curve(scored_lines(spark, folder), "returned", "guess", drop_intermediate=True)
    return rounded(curve, 9, "fpr", "tpr")


@query
def trapezoid_auc(spark, folder):
    curve = metrics.roc_curve(scored_lines(spark, folder), "returned", "score")
    return rounded(metrics.trapezoid_auc(curve), 9, "auc")


@query
def feature_table(spark, folder):
    lines = table(spark, folder, "lineitem").drop("l_shipdate", "l_returnflag", "l_linestatus")
    names = feature_columns(lines, ["l_orderkey", "l_partkey", "l_suppkey", "l_tax"])
    checks.require_numeric(lines, names)
    return lines.select(*names)


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query
def fit_scaler(spark, folder):
    return rounded(modeling.fit_scaler(table(spark, folder, "lineitem"), SCALED), 6, "mean", "std")


@query
def apply_scaler(spark, folder):
    lines = table(spark, folder, "lineitem")
    scaled = modeling.apply_scaler(lines, modeling.fit_scaler(lines, SCALED))
    return rounded(scaled.select("l_orderkey", "l_linenumber", *SCALED), 6, *SCALED)


FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_upper", "is_toxic"]


def labelled_features(spark, folder):
    """Numeric features of every labelled document, from its whole text."""
    text = F.col("text")
    documents = table(spark, folder, "documents").select(
        "doc_id",
        "n_chars",
        F.size(F.split(text, r"\s+")).alias("n_words"),
        F.size(F.split(text, "\n")).alias("n_lines"),
        F.length(F.regexp_replace(text, "[^0-9]", "")).alias("n_digits"),
        F.length(F.regexp_replace(text, "[^A-Z]", "")).alias("n_upper"),
    )
    labels = table(spark, folder, "labels").select("doc_id", "quality", F.col("toxic").alias("is_toxic"))
    return documents.join(labels, "doc_id")


def fitted_grid(spark, folder):
    path = scratch(spark)
    modeling.stratified_split(labelled_features(spark, folder), "quality", "doc_id").write.parquet(path)
    split = spark.read.parquet(path)
    train, validation = split.where("split = 'train'"), split.where("split = 'validation'")
    found, fitted = modeling.grid_search(train, validation, FEATURES, "quality")
    return split, found, fitted


@query
def logistic_grid(spark, folder):
    return rounded(fitted_grid(spark, folder)[1], 9, "accuracy", "roc_auc", "precision", "recall", "f1")


@query
def logistic_predict(spark, folder):
    split, found, fitted = fitted_grid(spark, folder)
    best = modeling.best_model(found).first()["c"]
    test = split.where("split = 'test'")
    predicted = modeling.predict(test, fitted, best).select("doc_id", "quality", "prediction", "probability")
    return rounded(predicted, 6, "probability")
