"""Value frequencies, top values and distinct values."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tableprofile.functions.columns import LONG_TEXT_BYTES, categorical_columns, col, fields, is_long_text, present, text_key
from tableprofile.functions.small import settle, top_n


def _long_repeats(rows: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """(key, aggregates...) of the long texts that occur more than once; only digests are shuffled."""
    long = rows.where(is_long_text(F.col("value"))).withColumn("key", text_key(F.col("value"))).drop("value")
    counted = long.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"), *[a.alias(n) for n, a in aggregates.items()])
    return counted.where(F.col("_rows") > 1).drop("_rows")


def _per_value(rows: DataFrame, aggregates: Mapping[str, Column], alone: Mapping[str, Column]) -> DataFrame:
    """One row per distinct value: (value, aggregates...); alone: what an aggregate is for a single row.

    Long texts are counted by digest first, when this is called. A text that occurs once goes
    straight from the scan into the result, and of a repeated one each task sends a single copy, so
    texts are not shuffled to be counted.
    """
    plain = [a.alias(n) for n, a in aggregates.items()]
    long = is_long_text(F.col("value"))
    if not isinstance(rows.schema["value"].dataType, StringType) or rows.where(long).isEmpty():
        return rows.groupBy("value").agg(*plain)
    repeats = settle(_long_repeats(rows, aggregates), maybe_large=True)
    short = rows.where(F.coalesce(~long, F.lit(True))).groupBy("value").agg(*plain)
    keyed = rows.where(long).withColumn("key", text_key(F.col("value")))
    single = keyed.join(repeats, "key", "left_anti").select("value", *[e.alias(n) for n, e in alone.items()])
    again = keyed.select("key", "value").join(repeats, "key").groupBy("value").agg(*[F.min(n).alias(n) for n in aggregates])
    return short.unionByName(single).unionByName(again)


def _counted(df: DataFrame, column: str) -> DataFrame:
    value = present(fields(df, [column])[0])
    rows = df.select(value.alias("value")).where(F.col("value").isNotNull())
    return _per_value(rows, {"count": F.count(F.lit(1))}, {"count": F.lit(1).cast("long")})


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) of the present values, most frequent first, ties by value."""
    return _counted(df, column).orderBy(F.col("count").desc(), F.col("value").asc())


def value_shares(df: DataFrame, column: str, scale: float = 1.0) -> DataFrame:
    """(value, count, share) with shares of all present values, times `scale`."""
    counts = _counted(df, column)
    # A scalar subquery over the rows, without a shuffle: a window over everything would pull all
    # values into one task.
    total = df.agg(F.count(present(fields(df, [column])[0]))).scalar()
    return counts.withColumn("share", F.col("count") / total * F.lit(float(scale))).orderBy(
        F.col("count").desc(), F.col("value").asc()
    )


def heavy_counters(rows: DataFrame, counters: int) -> DataFrame:
    """(ordinal, key, least, missed): mergeable heavy-hitter counters of (ordinal, key, start) rows, `counters` per task and ordinal.

    A task that would hold more keys keeps the most frequent ones and takes the count of the next one
    off all of them, so a key is undercounted by at most what was taken off in total. Per task and
    ordinal one row without a key tells that total in `missed`. Counters of tasks merge by adding up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}
        missed: Counter = Counter()
        for b in batches:
            for ordinal, key, n in _batch_counts(b):
                held.setdefault(ordinal, Counter())[key] += n
            for ordinal, c in held.items():
                if len(c) > counters:
                    kept = c.most_common(counters + 1)
                    off = kept[-1][1]
                    missed[ordinal] += off
                    held[ordinal] = Counter({k: n - off for k, n in kept[:-1] if n > off})
        rows = [(o, k, n, 0) for o, c in held.items() for k, n in c.items()] + [(o, None, 0, n) for o, n in missed.items()]
        ordinals, keys, least, off = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_pydict({
            "ordinal": pa.array(ordinals, pa.int32()), "key": pa.array(keys, pa.string()), "least": pa.array(least, pa.int64()), "missed": pa.array(off, pa.int64()),
        })

    parts = rows.select("ordinal", "key").mapInArrow(count, "ordinal int, key string, least long, missed long")
    return parts.groupBy("ordinal", "key").agg(F.sum("least").alias("least"), F.sum("missed").alias("missed"))


def _batch_counts(batch: pa.RecordBatch) -> Iterator[tuple[int, str, int]]:
    counted = pa.Table.from_batches([batch]).group_by(["ordinal", "key"]).aggregate([([], "count_all")])
    return zip(*(counted.column(c).to_pylist() for c in ("ordinal", "key", "count_all")))


def _heavy_counts(rows: DataFrame, top_k: int, counters: int) -> DataFrame:
    """(ordinal, key, start, count) of all values that can be among the top_k of their column.

    rows: (ordinal, key, start). Where the counters prove that no other value can be, the candidates
    are counted in a second scan; of the other columns everything is counted.
    """
    merged = settle(heavy_counters(rows, counters), maybe_large=True)
    limit = merged.groupBy(F.col("ordinal").alias("o")).agg(F.sum("missed").alias("missed"))
    order = Window.partitionBy("ordinal").orderBy(F.col("least").desc(), "key")
    kth = merged.where("key is not null").withColumn("place", F.row_number().over(order)).where(F.col("place") <= top_k)
    kth = kth.groupBy(F.col("ordinal").alias("k")).agg(F.min("least").alias("kth"), F.max("place").alias("places"))
    known = limit.join(kth, F.col("o") == F.col("k"))
    # A value without a counter occurs at most `missed` times; with nothing missed all are there.
    proven = settle(known.where((F.col("missed") == 0) | ((F.col("places") == top_k) & (F.col("missed") < F.col("kth")))))
    tracked = merged.where("key is not null").select("ordinal", "key", "least")
    may_be = tracked.join(proven, F.col("ordinal") == F.col("o")).where((F.col("least") + F.col("missed") >= F.col("kth")) | (F.col("places") < top_k))
    candidates = settle(may_be.select(F.col("ordinal").alias("o"), F.col("key").alias("k")), maybe_large=True)
    counted = [rows.join(candidates, (F.col("ordinal") == F.col("o")) & (F.col("key") == F.col("k")), "left_semi")]
    if proven.count() < limit.count():
        counted.append(rows.join(proven.select("o"), F.col("ordinal") == F.col("o"), "left_anti"))
    frames = [c.groupBy("ordinal", "key", "start").count() for c in counted]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def top_categories(df: DataFrame, max_columns: int | None = None, top_k: int = 5, counters: int | None = None) -> DataFrame:
    """(column, rank, value, count, share): top_k values of every text column, or of the first max_columns.

    Shares are of the kept values of the column, not of all its rows. A column without any
    present value has no rows, yet still takes a place among the first. Long texts are counted by
    digest when this is called; a second scan fetches the few that can be among the first.

    With `counters` a task keeps at most so many counts per column instead of sending each of its
    distinct values; see `heavy_counters`. The result is the same.
    """
    names = categorical_columns(df, max_columns)
    if not names:
        schema = "column string, rank int, value string, count bigint, share double"
        return df.sparkSession.createDataFrame([], schema)
    cells = [cell for i, name in enumerate(names) for cell in (F.lit(i), col(name).cast("string"))]
    values = df.select(F.stack(F.lit(len(names)), *cells).alias("ordinal", "value")).where(F.col("value").isNotNull())
    key, start = text_key(F.col("value")).alias("key"), F.substring("value", 1, LONG_TEXT_BYTES).alias("start")
    keyed = values.select("ordinal", key, start)
    counts = _heavy_counts(keyed, top_k, counters) if counters else keyed.groupBy("ordinal", "key", "start").count()
    # Equal counts go by value, of which the start decides all but equal starts; those all stay for now.
    near = settle(top_n(counts, ["ordinal"], [F.col("count").desc(), F.col("start").asc()], top_k, ties=True).drop("rank"), maybe_large=True)
    digests = near.where(is_long_text(F.col("key"))).select("ordinal", "key")
    if digests.isEmpty():
        found = near.withColumn("value", F.col("key"))
    else:
        texts = values.where(is_long_text(F.col("value"))).select("ordinal", key, F.col("value").alias("text"))
        texts = texts.join(digests, ["ordinal", "key"], "left_semi").groupBy("ordinal", "key").agg(F.any_value("text").alias("text"))
        found = near.join(texts, ["ordinal", "key"], "left").withColumn("value", F.coalesce("text", "key"))
    found = found.select("ordinal", "value", "count")
    kept = top_n(found, ["ordinal"], [F.col("count").desc(), F.col("value").asc()], top_k)
    # At most top_k rows per column are left here.
    return (
        kept.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("ordinal")))
        .orderBy("ordinal", "rank")
        .select(
            F.element_at(F.array(*[F.lit(n) for n in names]), F.col("ordinal") + 1).alias("column"),
            "rank", "value", "count", "share",
        )
    )


def distinct_values(df: DataFrame, column: str, order_by: str | None = None, place: str | None = None) -> DataFrame:
    """Distinct values, missing included: sorted, or in the order in which order_by first meets them.

    place: name of a further column with the value of order_by at which a value is first met.
    """
    value = present(fields(df, [column])[0]).alias("value")
    if order_by is None:
        found = _per_value(df.select(value), {"count": F.count(F.lit(1))}, {"count": F.lit(1).cast("long")})
        return found.select(F.col("value").alias(column)).orderBy(col(column).asc_nulls_last())
    rows = df.select(value, col(order_by).alias("_place"))
    found = _per_value(rows, {"_place": F.min("_place")}, {"_place": F.col("_place")})
    return found.orderBy("_place").select(F.col("value").alias(column), *([F.col("_place").alias(place)] if place else []))
