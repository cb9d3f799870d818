"""Product codes of vectors: small codebooks per part, equal-average search for the nearest entry."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tableprofile.llm.common import saved, small

#: Integer components are held within these limits, so that sums of squares stay exact in 64 bits.
LIMIT = 1 << 24


def kept_vectors(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there, without null, NaN or infinite components."""
    v = F.col(f"`{vector}`")
    return df.where(v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))))


def integers(column: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, one row per vector, filled with zeros up to the width."""
    at = column.offsets.to_numpy().astype(np.int64)
    flat = np.floor(column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].astype(np.float64) * scale)
    flat, at = np.clip(flat, -LIMIT, LIMIT).astype(np.int64), at - at[0]
    sizes = np.diff(at)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(at[:-1], sizes)] = flat
    return out


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of and squared distance to the nearest entry for every point, ties to the lower index; and how many distances were computed.

    Entries are sorted by the sum of their components. A point starts where its own sum belongs and
    takes the entries outward, always the one with the smaller gap of sums. As gap * gap / dimension
    is never above the squared distance, a point is finished when that bound strictly exceeds its
    best distance; at equality the entry might still tie with a lower index.
    """
    n, dim = points.shape
    index, best = np.full(n, len(entries), np.int64), np.full(n, np.iinfo(np.int64).max)
    order = np.argsort(entries.sum(axis=1), kind="stable")
    sums = entries.sum(axis=1)[order]
    own = points.sum(axis=1)
    high = np.searchsorted(sums, own)
    low = high - 1
    open_, tried = np.arange(n), 0
    far = np.iinfo(np.int64).max
    while len(open_):
        mine, lo, hi = own[open_], low[open_], high[open_]
        below = np.where(lo >= 0, mine - sums[np.maximum(lo, 0)], far)
        above = np.where(hi < len(sums), sums[np.minimum(hi, len(sums) - 1)] - mine, far)
        gap = np.minimum(below, above)
        go = gap < far
        fresh = best[open_] == far
        near, limit = np.where(go, gap, 0), np.where(fresh, 0, best[open_]) * dim
        go &= fresh | (near * near <= limit)
        open_, down = open_[go], (below <= above)[go]
        at = np.where(down, lo[go], hi[go])
        low[open_] -= down
        high[open_] += ~down
        entry = order[at]
        distance = ((points[open_] - entries[entry]) ** 2).sum(axis=1)
        tried += len(open_)
        better = (distance < best[open_]) | ((distance == best[open_]) & (entry < index[open_]))
        best[open_[better]], index[open_[better]] = distance[better], entry[better]
    return index, best, tried


@dataclass(frozen=True)
class Codebooks:
    """entries: (part, entry, position) integers; all parts have equally many entries."""

    entries: np.ndarray
    scale: int

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def parts(self, column: pa.ListArray) -> Iterator[np.ndarray]:
        rows = integers(column, self.width, self.scale)
        dim = self.entries.shape[2]
        for p in range(len(self.entries)):
            yield rows[:, p * dim : (p + 1) * dim]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the componentwise floor of the mean of the parts nearest to it; unused entries stay.

    A task sends one row per part, entry and position; as many reach the driver.
    """
    parts, size, dim = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, size, dim), np.int64), np.zeros((parts, size), np.int64)
        for b in batches:
            for p, points in enumerate(books.parts(b.column(0))):
                entry = nearest(points, books.entries[p])[0]
                for i in range(dim):
                    np.add.at(total[p, :, i], entry, points[:, i])
                count[p] += np.bincount(entry, minlength=size)
        p, e, i = (x.ravel() for x in np.indices(total.shape))
        used = np.repeat(count.ravel(), dim)
        some = used > 0
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p[some], pa.int32()), "entry": pa.array(e[some], pa.int32()), "place": pa.array(i[some], pa.int32()),
            "total": total.ravel()[some], "n": used[some],
        })

    found = vectors.select("v").mapInArrow(sums, "part int, entry int, place int, total long, n long")
    # Sums over all rows can pass 64 bits, their mean cannot.
    found = found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    entries = books.entries.copy()
    for part, entry, place, total, n in found.collect():
        entries[part, entry, place] = int(total) // n
    return Codebooks(entries, books.scale)


def learned(vectors: DataFrame, parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """Codebooks that start as the parts of the `size` rows of (id, v) with the smallest ids and are improved `rounds` times; None without rows.

    Width: that of the longest vector, rounded up to a multiple of `parts`.
    """
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    dim = -(-longest // parts)
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(size).toArrow().column("v").combine_chunks()
    rows = integers(first, parts * dim, scale)
    books = Codebooks(np.ascontiguousarray(rows.reshape(len(rows), parts, dim).transpose(1, 0, 2)), scale)
    for _ in range(rounds):
        books = improved(vectors, books)
    return books


def vector_codes(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256,
) -> DataFrame:
    """Codes of vectors cut in `parts` equal parts, with codebooks of `size` entries learnt from all rows.

    Components are floor(scale * x), held within 2 ** 24 on either side. Returns vec_id, code (index
    of the nearest entry per part, two hex digits each), error (squared distances summed over the
    parts), label_error (errors summed over rows of equal label, null labels together),
    codebooks_sha256 (all components as decimals, by part, entry and position, joined by commas).

    Vectors that are null or hold a null, NaN or infinite component are left out. Shorter vectors
    count as filled with zeros, also the last part of all if the width is no multiple of `parts`;
    empty vectors have error 0. Distances that tie go to the lower entry. With fewer rows than
    `size` the codebooks are smaller. Repeated rows count once each; rows without an id come last
    among the first entries; rows of equal id go by their vector. An empty table gives no rows;
    other columns are not read.
    """
    if not 0 < size <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    rows = kept_vectors(df, vector).select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), F.col(f"`{label}`").alias("label"))
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    books = learned(rows, parts, size, rounds, scale)
    if books is None:
        return df.sparkSession.createDataFrame([], schema)
    digits = np.array([f"{i:02x}" for i in range(size)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            error, code = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, "U1")
            for p, points in enumerate(books.parts(b.column(1))):
                entry, distance, _ = nearest(points, books.entries[p])
                error += distance
                code = digits[entry] if p == 0 else np.char.add(code, digits[entry])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(code.tolist(), pa.string()), pa.array(error), b.column(2)], names=["vec_id", "code", "error", "label"])

    kinds = StructType([StructField("vec_id", LongType()), StructField("code", StringType()), StructField("error", LongType()), StructField("label", df.schema[label].dataType)])
    coded = saved(rows.mapInArrow(encode, kinds))
    # One row per label: while these are few they travel, and no label is gathered in a task.
    errors = saved(coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")))
    joined = coded.join(small(errors), F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
