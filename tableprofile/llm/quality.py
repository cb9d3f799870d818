"""Quality classifier: ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.llm import textbytes as T
from tableprofile.llm.common import in_small_batches, lists, values

BUCKETS = 1 << 18
U = np.uint64

#: Byte classes whose shares are features: upper case, lower case, digits, white space, other ASCII, beyond ASCII.
CLASS = np.array([
    0 if 65 <= i <= 90 else 1 if 97 <= i <= 122 else 2 if 48 <= i <= 57 else 3 if T.WHITE[i] else 4 if i < 128 else 5 for i in range(256)
])


def features(data: np.ndarray) -> np.ndarray:
    """Sorted hashed features of a whole text: its words, and levels of a few shares of bytes and words.

    A level counts as present with every level below it, so that a weight belongs to a step.
    """
    w = T.word_hashes(data, gaps=T.MARKS)
    unique = np.unique(w)
    n = max(len(w), 1)
    shares = list(np.bincount(CLASS[data], minlength=6) / max(len(data), 1))
    shares += [len(unique) / n, np.count_nonzero(w[1:] == w[:-1]) / n]
    start, end = T.words(data)
    marked = np.count_nonzero(T.MARKS[data[start]] & T.MARKS[data[end - 1]]) if len(start) else 0
    shares += [marked / max(len(start), 1), min(len(data) / max(len(start), 1), 64) / 64, min(np.log2(len(data) + 1), 32) / 32]
    levels = [U(1 + 64 * i) + np.arange(1 + int(32 * share**0.5), dtype=U) for i, share in enumerate(shares)]
    return np.unique(np.concatenate([unique, T.draw(np.concatenate(levels), 3)]) % U(BUCKETS)).astype(np.int32)


def rated_features(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """(id, grade, items) of the rated documents; ratings: (id, grade), few enough to be broadcast."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists([features(x) for x in values(b.column(2))], pa.int32())], names=["id", "grade", "items"])

    rated = docs.join(F.broadcast(ratings), "id").select("id", "grade", "text")
    return rated.mapInArrow(found, "id long, grade int, items array<int>")


class Model:
    """weights by bucket and ordered thresholds: P(grade <= c) = 1 / (1 + exp(score - thresholds[c]))."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.weights, self.thresholds = weights, thresholds

    def tails(self, items: np.ndarray) -> np.ndarray:
        """P(grade > c) for every threshold c."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[items].sum(), -500, 500)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int, ridge: float, seldom: int) -> Model:
    """Maximise the penalised likelihood with Adam over all rows; items in fewer than `seldom` rows get no weight."""
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])[:-1]
    flat = np.concatenate(rows)
    counts = np.bincount(flat, minlength=BUCKETS)
    used = np.flatnonzero(counts >= seldom)
    to = np.full(BUCKETS, -1)
    to[used] = np.arange(len(used))
    column = to[flat]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[column >= 0]
    column = column[column >= 0]
    y, n, c = grades, len(rows), n_grades - 1
    below = np.array([np.clip(np.mean(y <= i), 0.5 / n, 1 - 0.5 / n) for i in range(c)])
    start = np.log(below / (1 - below))
    p = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, rounds + 1):
        score = np.bincount(row, p[column], minlength=n) if len(used) else np.zeros(n)
        gaps = np.exp(np.clip(p[len(used) + 1 :], -20, 20))
        cut = np.concatenate([[-np.inf], p[len(used)] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        up, low = (1 / (1 + np.exp(-np.clip(cut[y + k] - score, -500, 500))) for k in (1, 0))
        mass = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / mass, low * (1 - low) / mass  # of log mass, by the upper and the lower cut
        d_score = (d_up - d_low) / n  # of the loss, by the score
        by_cut = (np.bincount(y, -d_up / n, c + 1)[:c]) + np.bincount(y, d_low / n, c + 1)[1:]
        gradient = np.concatenate([
            np.bincount(column, d_score[row], minlength=len(used)) + ridge * p[: len(used)],
            [by_cut.sum()], gaps * np.cumsum(by_cut[::-1])[::-1][1:],
        ])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = p[: len(used)]
    gaps = np.exp(np.clip(p[len(used) + 1 :], -20, 20))
    return Model(weights, p[len(used)] + np.concatenate([[0], np.cumsum(gaps)]))


def train(
    docs: DataFrame, ratings: DataFrame, n_grades: int = 3, max_rated: int = 10_000, rounds: int = 150, ridge: float = 1e-4, seldom: int = 5,
) -> Model | None:
    """Fit on at most `max_rated` rated documents: those whose ids hash lowest, all if fewer.

    docs: (id long, text binary), ratings: (id long, grade int from 0). Rows with a null id or grade
    or a grade out of range are left out; of several ratings of a document the lowest counts. The
    bound keeps the fit a single task of fixed size; scoring is not bounded. None without ratings.
    """
    good = ratings.where(f"id is not null and grade between 0 and {n_grades - 1}").groupBy("id").agg(F.min("grade").cast("int").alias("grade"))
    chosen = good.orderBy(F.xxhash64("id"), "id").limit(max_rated)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(i, g, x) for b in batches for i, g, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (values_of(b.column(2))))]
        if rows:
            rows.sort(key=lambda r: (r[0], len(r[2]), r[2].tobytes()))
            model = fit([r[2] for r in rows], np.array([r[1] for r in rows]), n_grades, rounds, ridge, seldom)
            yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tobytes()]}, schema=pa.schema([("weights", pa.binary()), ("thresholds", pa.binary())]))

    found = rated_features(docs, chosen).repartition(1).mapInArrow(fitted, "weights binary, thresholds binary").collect()
    return Model(np.frombuffer(found[0][0], np.float32), np.frombuffer(found[0][1])) if found else None


def values_of(column: pa.ListArray) -> Iterator[np.ndarray]:
    at, flat = column.offsets.to_numpy(), column.values.to_numpy()
    for i in range(len(column)):
        yield flat[at[i] : at[i + 1]]


def judged(model: Model | None, text: Column, least: int) -> Column:
    """struct(expected_grade, tail) of each text: the mean of the grade, and the probability of a grade of at least `least`."""
    if model is None:
        return F.struct(F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail"))

    @F.pandas_udf("expected_grade double, tail double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        tails = [model.tails(features(np.frombuffer(x, np.uint8))) for x in texts]
        return pd.DataFrame({"expected_grade": [t.sum() for t in tails], "tail": [t[least - 1] for t in tails]})

    return judge(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def quality_grades(
    docs: DataFrame, ratings: DataFrame, id: str = "doc_id", text: str = "text", n_grades: int = 3, least: int = 2, tail: float = 0.5, **settings,
) -> DataFrame:
    """Grade every text by a model of the rated ones.

    ratings: (id, grade), grades 0 .. n_grades - 1, see `train`. Returns the columns of docs and
    `quality`: struct(expected_grade, tail, kept), tail = P(grade >= least), kept = tail reaches the
    given one. A null text counts as empty and is graded by its shape; without any rating the grades
    are null and everything is kept. Repeated rows get equal grades; a column of docs that is already
    called quality is replaced; an empty table gives no rows.
    """
    model = train(docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8").alias("text")), ratings, n_grades, **settings)
    grade = judged(model, F.col(f"`{text}`"), least)
    out = in_small_batches(docs).withColumn("quality", grade)
    return out.withColumn("quality", F.struct("quality.expected_grade", "quality.tail", F.coalesce(F.col("quality.tail") >= tail, F.lit(True)).alias("kept")))


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from the labels table: 0 bad quality, 1 good quality but toxic, 2 good and clean; null where a label is missing."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(F.col("doc_id").cast("long").alias("id"), grade.alias("grade"))
