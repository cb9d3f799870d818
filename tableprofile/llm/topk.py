"""Exact top-k search by integer inner product: histogram selection."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.llm.common import shared_folder

BINS = 1024
EXACT = 2**53


def integer_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v array<double>): floor(scale * x) of each component. Vectors that are null, hold a null or a number that is not finite, and rows without an id are left out."""
    v = F.col(f"`{vector}`")
    good = v.isNotNull() & F.col(f"`{id}`").isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return df.where(good).select(F.col(f"`{id}`").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


def matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Rows padded with zeros, or cut, to the width."""
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : min(len(r), width)] = r[:width]
    return out


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles, limited to the range of a long.

    While no partial sum can reach 2 ** 53 doubles are exact; beyond that Python integers are used.
    """
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < EXACT:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in c], object).T
    return np.array([[max(-(2**63), min(2**63 - 1, x)) for x in r] for r in exact], np.int64)


def _scored(batches: Iterator[pa.RecordBatch], queries: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of candidates: ids, scores against all queries of the block, and which of them count (a row is no candidate of its own query)."""
    ids, q = queries
    step = max(1, (4 << 20) // max(len(ids), 1))
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            mine = part.column(0).to_numpy()
            offsets, flat = part.column(1).offsets.to_numpy(), part.column(1).values.to_numpy()
            c = matrix([flat[offsets[i] : offsets[i + 1]] for i in range(len(mine))], q.shape[1])
            yield mine, products(q, c), ids[:, None] != mine[None, :]


def _kth(rows: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """The k-th largest score of every query of a block (the smallest, with fewer than k candidates).

    Every pass counts, per query, the scores in 1,024 bins of its range and goes on with the bin that
    holds the k-th. A task sends the bins down to the one that holds its own k-th score; the rest
    cannot hold the k-th of all. So a task sends at most k counts per query, and the driver gets one
    row per query, the bin that holds its k-th score.
    """
    ids, q = queries
    n = len(ids)
    ends = rows.mapInArrow(lambda b: _extent(b, queries), "query int, low long, high long").groupBy("query").agg(F.min("low"), F.max("high")).collect()
    low, high, want = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, k, np.int64)
    for i, a, b in ends:
        low[i], high[i] = a, b
    open_ = high > low
    while open_.any():
        span = high.astype(object) - low.astype(object)
        width = np.array([max(1, -(-(int(s) + 1) // BINS)) for s in span], np.int64)
        state = (low.copy(), high.copy(), width, want.copy(), open_.copy())
        found = rows.mapInArrow(lambda b, s=state: _histogram(b, queries, s), "query int, bin int, n long, want long")
        found = found.groupBy("query", "bin").agg(F.sum("n").alias("n"), F.min("want").alias("want"))
        w = Window.partitionBy("query").orderBy(F.desc("bin"))
        found = found.withColumn("above", F.sum("n").over(w) - F.col("n")).where("above < want")
        for i, b, m, above in found.groupBy("query").agg(F.min("bin"), F.min_by("n", "bin"), F.min_by("above", "bin")).collect():
            top = min(int(high[i]), int(low[i]) + (b + 1) * int(width[i]) - 1)
            low[i], high[i] = int(low[i]) + b * int(width[i]), top
            want[i] = min(want[i] - above, m)
        open_ &= high > low
    return low


def _extent(batches, queries):
    n = len(queries[0])
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    for _, s, counts in _scored(batches, queries):
        low = np.minimum(low, np.where(counts, s, np.iinfo(np.int64).max).min(axis=1))
        high = np.maximum(high, np.where(counts, s, np.iinfo(np.int64).min).max(axis=1))
    some = np.flatnonzero(low <= high)
    yield pa.RecordBatch.from_pydict({"query": pa.array(some, pa.int32()), "low": pa.array(low[some]), "high": pa.array(high[some])})


def _histogram(batches, queries, state):
    low, high, width, want, open_ = state
    rows = np.flatnonzero(open_)
    ids, q = queries[0][rows], queries[1][rows]
    low, high, width, want = low[rows], high[rows], width[rows], want[rows]
    total = np.zeros(len(rows) * BINS, np.int64)
    for _, s, counts in _scored(batches, (ids, q)):
        counts &= (s >= low[:, None]) & (s <= high[:, None])
        i, j = np.nonzero(counts)
        bins = ((s[i, j] - low[i]).view(np.uint64) // width[i].astype(np.uint64)).astype(np.int64)
        total += np.bincount(i * BINS + bins, minlength=len(total))
    total = total.reshape(len(rows), BINS)
    from_top = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total  # scores in higher bins
    i, j = np.nonzero((total > 0) & (from_top < want[:, None]))
    yield pa.RecordBatch.from_pydict({"query": pa.array(rows[i], pa.int32()), "bin": pa.array(j, pa.int32()), "n": pa.array(total[i, j]), "want": pa.array(want[i])})


def _best(batches, queries, least, k):
    """Candidates that reach the k-th score: all above it, and of those that equal it the k smallest ids of the task."""
    ids = queries[0]
    above: list[tuple[np.ndarray, ...]] = []
    equal = [np.zeros(0, np.int64) for _ in ids]
    for mine, s, counts in _scored(batches, queries):
        i, j = np.nonzero(counts & (s > least[:, None]))
        above.append((i, mine[j], s[i, j]))
        i, j = np.nonzero(counts & (s == least[:, None]))
        for query in np.unique(i):
            equal[query] = np.sort(np.concatenate([equal[query], mine[j[i == query]]]))[:k]
    for i, e in enumerate(equal):
        above.append((np.full(len(e), i), e, np.full(len(e), least[i])))
    if above:
        i, c, s = (np.concatenate(x) for x in zip(*above))
        yield pa.RecordBatch.from_pydict({"query_id": pa.array(ids[i], pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.int64())})


def top_k(df: DataFrame, every: int = 100, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: int = 1024, block_bytes: int = 64 << 20) -> DataFrame:
    """The k best rows for every row whose id is divisible by `every`.

    Score: inner product of floor(scale * x); a shorter vector counts as padded with zeros. Returns
    query_id, rank (from 1), vec_id, score; ties go to the smaller id; fewer rows where there are
    fewer candidates. Vectors that are null or hold a null, NaN or infinity take no part; of repeated
    ids each row is a candidate, the one of longest, then largest vector is the query. Components and
    scores beyond a long are held at its limits. An empty table gives no rows.

    Queries are taken in blocks by a hash of the id, so that their vectors and histograms take some
    block_bytes in a task; one block at a time travels to all candidates, which are never shuffled. Per block: the range of scores, then histograms that
    close in on the k-th score of each query, then a filter and the order of what passed.
    """
    spark = df.sparkSession
    rows = integer_vectors(df, id, vector, scale)
    stated = rows.where(F.col("id") % every == 0)
    n = stated.count()
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    schema = "query_id long, vec_id long, score long"
    blocks = max(1, min(n, -(-n * 8 * (longest + 3 * BINS) // block_bytes)))  # the histogram, its running totals and what is left out
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks if n else 0):
        mine = stated.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).groupBy("id").agg(F.max_by("v", F.struct(F.size("v"), "v")).alias("v"))
        found = mine.orderBy("id").collect()
        if not found:
            continue
        queries = (np.array([r[0] for r in found], np.int64), matrix([np.array(r[1], float) for r in found], longest))
        least = _kth(rows, queries, k)
        rows.mapInArrow(lambda b, q=queries, m=least: _best(b, q, m, k), schema).write.mode("append").parquet(path)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
