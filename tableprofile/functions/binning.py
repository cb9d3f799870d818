"""Right-closed labelled bins and equal-width histogram bins as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_column(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (edges[i], edges[i+1]] holding the value; NULL outside all bins."""
    if len(labels) != len(edges) - 1:
        raise ValueError("there must be one label fewer than edges")
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError("edges must increase")
    result = F.when(column <= F.lit(edges[0]), F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        result = result.when(column <= F.lit(high), F.lit(label))
    return result


def bin_edge(low: Column, high: Column, bins: int, index: Column) -> Column:
    """Edge number `index` of `bins` equal bins on [low, high]; the last edge is high itself."""
    step = (high - low) / F.lit(float(bins))
    return F.when(index >= F.lit(bins), high).otherwise(index.cast("double") * step + low)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of a value in [low, high]: half-open bins, the last one closed.

    The quotient can be off by one next to an edge, so the edges themselves have the last word.
    """
    guess = F.least(F.floor((value - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    return (
        F.when(value < bin_edge(low, high, bins, guess), guess - 1)
        .when((guess < bins - 1) & (value >= bin_edge(low, high, bins, guess + 1)), guess + 1)
        .otherwise(guess)
    )
