"""Relations between numeric columns: Pearson correlation and scatter points."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.columns import clamp, col, fields, numeric_columns, present

LONG_SCHEMA = "x_order int, column_x string, y_order int, column_y string, correlation double"
# Columns on one side of a tile: a task holds ten numbers per pair of a tile, 5 MB, however wide the table is.
TILE = 256
MOMENTS = ["n", "mx", "my", "sxx", "syy", "sxy", "low_x", "high_x", "low_y", "high_y"]


def correlation_long(df: DataFrame, columns: Sequence[str] | None = None, min_columns: int = 1) -> DataFrame:
    """(column_x, column_y, correlation) for every ordered pair of numeric columns.

    Each pair uses the rows in which both values are present, and no other pair or column changes
    its result. NULL where a side is constant or not finite in those rows.
    Empty for an empty table or with fewer than min_columns numeric columns.
    """
    names = [n for n in numeric_columns(df) if columns is None or n in columns]
    if len(names) < max(min_columns, 1):
        return df.sparkSession.createDataFrame([], LONG_SCHEMA).select("column_x", "column_y", "correlation")
    upper = _pairs(df, names)
    label = F.array(*[F.lit(n) for n in names])
    there, back = F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    both = F.when(F.col("i") < F.col("j"), F.array(there, back)).otherwise(F.array(there))
    return (
        upper.select("correlation", F.explode(both).alias("pair"))
        .select("correlation", "pair.*")
        .orderBy("i", "j")
        .select(
            F.element_at(label, F.col("i") + 1).alias("column_x"),
            F.element_at(label, F.col("j") + 1).alias("column_y"),
            "correlation",
        )
    )


def _moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """MOMENTS by columns of x by columns of y: counts, means, squares and products of deviations, and extremes, each over the rows of the pair."""
    there, there_y = ~np.isnan(x), ~np.isnan(y)
    out = np.zeros((len(MOMENTS), x.shape[1], y.shape[1]))
    n, mx, my, sxx, syy, sxy, low, high, low_y, high_y = out
    for j in range(y.shape[1]):
        rows = there_y[:, j]
        mask, part, other = there[rows], np.where(there[rows], x[rows], 0.0), y[rows, j][:, None]
        count = mask.sum(axis=0)
        some = np.maximum(count, 1)
        mean, mean_y = part.sum(axis=0) / some, np.where(mask, other, 0.0).sum(axis=0) / some
        off, off_y = np.where(mask, part - mean, 0.0), np.where(mask, other - mean_y, 0.0)
        n[:, j], mx[:, j], my[:, j] = count, mean, mean_y
        sxx[:, j], syy[:, j], sxy[:, j] = (off * off).sum(axis=0), (off_y * off_y).sum(axis=0), (off * off_y).sum(axis=0)
        for values, lows, highs in ((part, low, high), (other, low_y, high_y)):
            lows[:, j] = np.where(mask, values, np.inf).min(axis=0, initial=np.inf)
            highs[:, j] = np.where(mask, values, -np.inf).max(axis=0, initial=-np.inf)
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    part = b[0] / np.maximum(n, 1)
    dx, dy = b[1] - a[1], b[2] - a[2]
    both = a[0] * part
    return np.stack([
        n, a[1] + dx * part, a[2] + dy * part, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both,
        np.minimum(a[6], b[6]), np.maximum(a[7], b[7]), np.minimum(a[8], b[8]), np.maximum(a[9], b[9]),
    ])


def _tile(values: DataFrame, first: range, second: range) -> DataFrame:
    """(i, j, MOMENTS) for i in first, j in second, i <= j: one row per task and pair. Reads the columns of the tile only."""
    same = first == second
    chosen = values.select(*[f"v{i}" for i in [*first, *([] if same else second)]])

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if len(batch):
                    x = batch.to_numpy(dtype="float64", na_value=np.nan)
                    found = _moments(x[:, : len(first)], x if same else x[:, len(first) :])
                    total = found if total is None else _merged(total, found)
        if total is not None:
            i, j = np.triu_indices(len(first)) if same else (k.ravel() for k in np.indices(total.shape[1:]))
            yield pd.DataFrame({"i": i + first.start, "j": j + second.start, **{m: total[k][i, j] for k, m in enumerate(MOMENTS)}})

    return chosen.mapInPandas(moments, "i int, j int, " + ", ".join(f"{m} double" for m in MOMENTS))


def _pairs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(i, j, correlation) for i <= j, in one scan per tile of TILE by TILE columns.

    Deviations are taken from the means of the pair's own rows, batch by batch, and merged by the
    parallel variance formula, first in the task and then over tasks: a task hands over one row per
    pair, whatever its number of input rows. A wide table is cut in blocks of columns; each pair of
    blocks is a tile with tasks of its own, which read these columns only.
    """
    columns = [present(f).cast("double").alias(f"v{i}") for i, f in enumerate(fields(df, names))]
    values, width = df.select(*columns), len(names)
    blocks = [range(i, min(i + TILE, width)) for i in range(0, width, TILE)]
    tiles = [_tile(values, a, b) for i, a in enumerate(blocks) for b in blocks[i:]]
    parts = reduce(DataFrame.unionByName, tiles)
    # As many rows per pair as there are tasks.
    w = Window.partitionBy("i", "j")
    dx, dy = (F.col(m) - F.try_divide(F.sum(F.col("n") * F.col(m)).over(w), F.sum("n").over(w)) for m in ("mx", "my"))
    off = parts.withColumn("dx", F.when(F.col("n") > 0, dx).otherwise(0.0)).withColumn("dy", F.when(F.col("n") > 0, dy).otherwise(0.0))
    total = off.groupBy("i", "j").agg(
        F.sum(F.col("sxx") + F.col("n") * F.col("dx") * F.col("dx")).alias("sxx"), F.sum(F.col("syy") + F.col("n") * F.col("dy") * F.col("dy")).alias("syy"),
        F.sum(F.col("sxy") + F.col("n") * F.col("dx") * F.col("dy")).alias("sxy"), F.min("low_x").alias("low_x"), F.max("high_x").alias("high_x"),
        F.min("low_y").alias("low_y"), F.max("high_y").alias("high_y"),
    )
    finite = F.coalesce(F.abs("sxx") < float("inf"), F.lit(False)) & F.coalesce(F.abs("syy") < float("inf"), F.lit(False))
    varies = finite & (F.col("low_x") < F.col("high_x")) & (F.col("low_y") < F.col("high_y"))
    ratio = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(clamp(F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy")), -1.0, 1.0))
    return total.select("i", "j", F.when(varies, ratio).alias("correlation"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The correlations as a square table: `column` and one column per numeric column."""
    names = [n for n in numeric_columns(df) if columns is None or n in columns]
    order = F.element_at(F.create_map(*[c for i, n in enumerate(names) for c in (F.lit(n), F.lit(i))]), F.col("column_x"))
    long = correlation_long(df, columns)
    if not names:
        return long.select(F.col("column_x").alias("column"))
    return (
        long.groupBy("column_x")
        .pivot("column_y", names)
        .agg(F.first("correlation"))
        .orderBy(order)
        .withColumnRenamed("column_x", "column")
    )


def scatter_points(df: DataFrame, x: str, y: str, category: str) -> DataFrame:
    """(x, y, category) of every row that has all three."""
    parts = {f.name: present(f) for f in fields(df, [x, y, category])}
    return df.select(parts[x].alias("x"), parts[y].alias("y"), parts[category].alias("category")).dropna()
