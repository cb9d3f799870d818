"""Stratified split, prior baseline, scaling, logistic regression, grid of C values, prediction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.columns import col, fields, present
from tableprofile.functions.small import null_safe_on, settle
from tableprofile.operators.logistic import LogisticModel, fit_penalties
from tableprofile.operators.metrics import binary_metrics, roc_auc

# Fixed values of the experiment.
SEED = 42
TEST_SHARE = 0.2
VALIDATION_SHARE_OF_REST = 0.25
C_GRID = (0.001, 0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0)
MAX_ITERATIONS = 1000


def row_digest(key: str, seed: int = SEED) -> Column:
    """Hex digest of seed and key: a draw per row that no repeat of the work can change."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), col(key).cast("string")))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_share: float = TEST_SHARE,
    validation_share: float = VALIDATION_SHARE_OF_REST,
    seed: int = SEED,
) -> DataFrame:
    """Add `split`: test, validation or train, with exact sizes per class and a unique row key.

    Of each class the round(test_share * n) rows with the smallest digests are the test rows and
    the next round(validation_share * rest) the validation rows. Counts per digest prefix locate
    both cuts; only rows with the prefix of a cut are ordered, so a class of any size is never
    gathered in one task. Equal keys at a cut are an error, as no exact split of them exists.
    """
    digest = row_digest(key, seed)
    rows = df.select(col(label).alias("y"), digest.alias("digest"))
    prefixed = rows.withColumn("prefix", F.conv(F.substring("digest", 1, 4), 16, 10).cast("int"))
    counts = prefixed.groupBy("y", "prefix").agg(F.count(F.lit(1)).alias("c"))
    # At most 65536 prefixes per class.
    running = Window.partitionBy("y").orderBy("prefix")
    located = (
        counts.withColumn("until", F.sum("c").over(running))
        .withColumn("before", F.col("until") - F.col("c"))
        .withColumn("total", F.sum("c").over(Window.partitionBy("y")))
        .withColumn("test_cut", F.round(F.col("total") * F.lit(test_share)).cast("bigint"))
        .withColumn(
            "validation_cut",
            F.col("test_cut")
            + F.round((F.col("total") - F.col("test_cut")) * F.lit(validation_share)).cast("bigint"),
        )
        .select(
            "y", "prefix", "until", "before",
            F.stack(F.lit(2), F.lit(0), F.col("test_cut"), F.lit(1), F.col("validation_cut")).alias("cut", "place"),
        )
        .where((F.col("before") < F.col("place")) & (F.col("place") <= F.col("until")))
        .select(F.col("y").alias("cut_y"), F.col("prefix").alias("cut_prefix"), "cut", (F.col("place") - F.col("before")).alias("nth"))
    )
    cuts = settle(located)
    near = prefixed.join(cuts, null_safe_on(prefixed, cuts, [("y", "cut_y"), ("prefix", "cut_prefix")]))
    order = Window.partitionBy("y", "prefix", "cut").orderBy("digest")
    borders = settle(
        near.withColumn("place", F.row_number().over(order))
        .withColumn("tied", F.coalesce(F.lead("digest").over(order) == F.col("digest"), F.lit(False)))
        .where(F.col("place") == F.col("nth"))
        .withColumn("digest", F.when(F.col("tied"), F.raise_error(f"the values of {key} are not unique").cast("string")).otherwise(F.col("digest")))
        .groupBy("y")
        .agg(
            F.max(F.when(F.col("cut") == 0, F.col("digest"))).alias("test_border"),
            F.max(F.when(F.col("cut") == 1, F.col("digest"))).alias("validation_border"),
        )
        .withColumnRenamed("y", "border_y")
    )
    whole = df.select(F.struct("*").alias("row"), col(label).alias("y"), digest.alias("digest"))
    joined = whole.join(borders, F.col("y").eqNullSafe(F.col("border_y")), "left")
    split = (
        F.when(F.col("digest") <= F.col("test_border"), "test")
        .when(F.col("digest") <= F.col("validation_border"), "validation")
        .otherwise("train")
    )
    return joined.select("row.*", split.alias("split"))


def split_balance(split: DataFrame, label: str) -> DataFrame:
    """(split, label, n, share) of each class within its split."""
    counts = split.groupBy("split", col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # One row per split and class.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("split"))).orderBy("split", "label")


def prior_baseline(df: DataFrame, train: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Add `baseline_prediction`: 1 with the share of ones among the training labels.

    The draw of a row is a number in [0, 1) from its digest.
    """
    prior = train.agg(F.avg(col(label).cast("double"))).scalar()
    draw = F.conv(F.substring(row_digest(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn("baseline_prediction", (draw < prior).cast("int"))


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean, std) with the population standard deviation; one aggregate."""
    aggregates, cells = [], []
    for i, name in enumerate(features):
        value = present(fields(df, [name])[0]).cast("double")
        aggregates += [F.avg(value).alias(f"mean{i}"), F.stddev_pop(value).alias(f"std{i}")]
        cells += [F.lit(name), F.col(f"mean{i}"), F.col(f"std{i}")]
    return df.agg(*aggregates).select(F.stack(F.lit(len(features)), *cells).alias("feature", "mean", "std"))


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Replace each feature by (value - mean) / std; a constant feature is only shifted.

    The scaler has one row per feature; its numbers become literals of the projection.
    """
    scaled = {
        row["feature"]: (col(row["feature"]).cast("double") - F.lit(row["mean"])) / F.lit(row["std"] or 1.0)
        for row in scaler.collect()
    }
    return df.withColumns(scaled)


def fit_logistic(train: DataFrame, label: str, features: Sequence[str], c: float, max_iterations: int = MAX_ITERATIONS) -> LogisticModel:
    """L2 logistic regression on features as they are, intercept not penalised; C weighs the summed loss against the penalty."""
    return _fitted(train, label, features, [c], max_iterations)[float(c)]


def _fitted(train: DataFrame, label: str, features: Sequence[str], grid: Sequence[float], max_iterations: int) -> dict[float, LogisticModel]:
    rows = train.select(col(label).cast("double").alias("y"), *[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    # Every pass reads these rows; lost blocks are recomputed.
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_penalties(rows, grid, max_iterations)
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class Fitted:
    """A scaler and the models of a grid, by C."""

    features: tuple[str, ...]
    scaler: DataFrame
    models: dict[float, LogisticModel]


def fit_grid(
    train: DataFrame, features: Sequence[str], label: str, grid: Sequence[float] = C_GRID, max_iterations: int = MAX_ITERATIONS
) -> Fitted:
    """Scale on the training rows and fit one model per C, all of them in the same passes."""
    scaler = settle(fit_scaler(train, features))
    return Fitted(tuple(features), scaler, _fitted(apply_scaler(train, scaler), label, features, grid, max_iterations))


def predict_all(df: DataFrame, fitted: Fitted, keep: Sequence[str]) -> DataFrame:
    """(keep..., c, prediction, probability): every row scored by every model, in one pass.

    Prediction and probability (of class 1) are NULL where a feature is missing.
    """
    scaled = apply_scaler(df.withColumns({f"_keep_{k}": col(k) for k in keep}), fitted.scaler)
    cells: list[Column] = []
    for c, model in fitted.models.items():
        score = F.lit(model.intercept)
        for name, weight in zip(fitted.features, model.coefficients):
            score = score + F.nullif(col(name), F.lit(float("nan"))) * F.lit(weight)
        cells.append(F.struct(F.lit(c).alias("c"), score.alias("score")))
    kept = [F.col(f"`_keep_{k}`").alias(f"k{i}") for i, k in enumerate(keep)]
    # A score that is computed once per row and model is all that prediction and probability need.
    scored = scaled.select(*kept, F.explode(F.array(*cells)).alias("m")).select(
        *[f"k{i}" for i in range(len(keep))], "m.c", (F.col("m.score") > 0).cast("int"), 1 / (1 + F.exp(-F.col("m.score")))
    )
    return scored.toDF(*keep, "c", "prediction", "probability")


def predict(df: DataFrame, fitted: Fitted, c: float) -> DataFrame:
    """Add `prediction` and `probability` (of class 1) by the model of one C."""
    chosen = Fitted(fitted.features, fitted.scaler, {c: fitted.models[c]})
    scored = predict_all(df, chosen, df.columns)
    # The model's C comes last before the prediction; a column of df may have its name.
    names = [*df.columns, "_c", "prediction", "probability"]
    return scored.toDF(*[f"_{i}" for i in range(len(names))]).select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names) if n != "_c"])


def grid_metrics(validation: DataFrame, fitted: Fitted, label: str) -> DataFrame:
    """(c, accuracy, roc_auc, precision, recall, f1) per model on the validation rows."""
    scored = predict_all(validation, fitted, [label])
    counts = binary_metrics(scored, label, "prediction", ["c"])
    areas = roc_auc(scored, label, "probability", ["c"]).withColumnRenamed("c", "area_c")
    # A null-safe join pushes no filter into either side, which keeps their common shuffle shared.
    joined = counts.join(areas, counts["c"].eqNullSafe(areas["area_c"]))
    return joined.orderBy("c").select("c", "accuracy", "roc_auc", "precision", "recall", "f1")


def grid_search(
    train: DataFrame, validation: DataFrame, features: Sequence[str], label: str, grid: Sequence[float] = C_GRID
) -> tuple[DataFrame, Fitted]:
    """Fit the grid on train and measure it on validation."""
    fitted = fit_grid(train, features, label, grid)
    return grid_metrics(validation, fitted, label), fitted


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the largest ROC-AUC, the smallest C among equals."""
    return metrics.orderBy(F.col("roc_auc").desc(), F.col("c").asc()).limit(1)
