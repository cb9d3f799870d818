"""Group statistics and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.columns import col, fields, present


def group_stats(df: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """(key, sum_<measure>, mean_<measure>, ...) per present key, in key order."""
    aggregates = []
    for field in fields(df, measures):
        value = present(field)
        aggregates += [
            # Like a sum over nothing, a group without present values sums to 0.
            F.coalesce(F.sum(value), F.lit(0)).alias(f"sum_{field.name}"),
            F.avg(value.cast("double")).alias(f"mean_{field.name}"),
        ]
    group = present(fields(df, [key])[0])
    return df.where(group.isNotNull()).groupBy(group.alias(key)).agg(*aggregates).orderBy(col(key))


def head_rows(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """First n rows in a stated order."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[col(k) for k in keys]).limit(n)
