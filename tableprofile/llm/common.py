"""What several operators share: tables in the shared folder, checked broadcasts, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of (long, long) that may be broadcast: 16 bytes each, so at most about 32 MB.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset a local session gets a temporary one; a cluster gets an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Rows of a few longs in a file of a saved table whose count is known.
FILE_ROWS = 50_000


def saved(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of df, written once to the shared folder: lineage ends here and every later use reads the same rows.

    rows: their number, if it is known and a row is a few longs. The files are then as many as the
    rows need; without it, as many as df has partitions.
    """
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Ask for a broadcast of a saved table of (long, long) rows if its count is within BROADCAST_ROWS; beyond that Spark joins by shuffle."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, after limiting the session's Arrow batches to 1,000 rows: whole texts go to Python, and a batch must stay small."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df


def values(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each value of a binary column, without copies; a null is empty."""
    wide = pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if at else np.zeros(len(column) + 1, int)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    for i in range(len(column)):
        yield data[at[i] : at[i + 1]]


def lists(items: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    at = np.zeros(len(items) + 1, np.int32)
    np.cumsum([len(x) for x in items], out=at[1:])
    flat = np.concatenate(items) if items else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False), kind))


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over edges (a, b), for every id that has an edge.

    Smallest labels travel along edges, then every label is replaced by the label of its label, so
    long chains shorten by halves. Labels and edges stay tables; only counts reach the driver.
    """
    both = saved(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a"))).distinct())
    labels = saved(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")))
    rows = labels.count()
    while True:
        near = both.join(small(labels, rows), F.col("b") == F.col("id")).groupBy(F.col("a").alias("to")).agg(F.min("component").alias("least"))
        met = labels.join(small(near, rows), F.col("id") == F.col("to"), "left").select("id", "component", F.least("component", "least").alias("new"))
        met = saved(met, rows)
        jump = met.select(F.col("id").alias("of"), F.col("new").alias("newer"))
        new = saved(
            met.join(small(jump, rows), F.col("new") == F.col("of"), "left")
            .select("id", F.least("new", "newer").alias("component"), (F.least("new", "newer") != F.col("component")).alias("moved")),
            rows,
        )
        labels = new.select("id", "component")
        if new.where("moved").isEmpty():
            return labels
