"""Logistic regression for many penalties at once: Newton steps whose sums come from one pass over the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LogisticModel:
    """Weights of scaled features, intercept, and how many passes over the rows they took."""

    coefficients: tuple[float, ...]
    intercept: float
    passes: int


@dataclass
class _Search:
    """Where the search for one C stands: the best weights so far, the step from there, and the weights to be tried next."""

    tried: np.ndarray
    weights: np.ndarray | None = None
    loss: float = np.inf
    step: np.ndarray | None = None
    done: bool = False


def _sums(rows: DataFrame, points: np.ndarray) -> np.ndarray:
    """For every point (weights, intercept last) the summed loss, its gradient and its curvature, as one array per point.

    A task adds up its rows and sends one number per point and cell; Spark adds the tasks.
    """
    n, q = points.shape
    width = 1 + q + q * q

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, width))
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = np.ones((b.num_rows, q))
            for j in range(q - 1):
                x[:, j] = b.column(j + 1).to_numpy(zero_copy_only=False)
            if np.isnan(x).any() or np.isnan(y).any():
                raise ValueError("a feature or label of the training rows is missing")
            for i, w in enumerate(points):
                z = x @ w
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-z))
                total[i, 0] += (np.logaddexp(0, z) - y * z).sum()
                total[i, 1 : q + 1] += x.T @ (p - y)
                total[i, q + 1 :] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
        point, cell = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"point": pa.array(point.ravel(), pa.int32()), "cell": pa.array(cell.ravel(), pa.int32()), "value": total.ravel()})

    parts = rows.mapInArrow(add, "point int, cell int, value double")
    found = parts.groupBy("point", "cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((n, width))
    out[found.column("point").to_numpy(), found.column("cell").to_numpy()] = found.column("value").to_numpy()
    return out


def fit_penalties(rows: DataFrame, cs: Sequence[float], max_passes: int, tolerance: float = 1e-8) -> dict[float, LogisticModel]:
    """A model per C, the minimum of half the squared weights plus C times the summed loss; the intercept is not penalised.

    rows: label (0 or 1) first, then the features, all doubles. Every pass serves all values of C
    that are still searched: it gives loss, gradient and curvature at their next weights. A loss that
    rose halves the step; a Newton step below `tolerance` ends the search. The driver solves one
    system of (features + 1) equations per C and pass, nothing else. Memory and what a task sends
    grow with the square of the number of features.
    """
    q = len(rows.columns)
    penalty = np.array([1.0] * (q - 1) + [0.0])
    share = rows.agg(F.avg(rows.columns[0])).first()[0]
    if share is None or not 0 < share < 1:
        raise ValueError("the training rows need labels 0 and 1")
    start = np.zeros(q)
    start[-1] = np.log(share / (1 - share))
    searches = {float(c): _Search(start) for c in cs}
    passes = 0
    while (open_ := {c: s for c, s in searches.items() if not s.done}) and passes < max_passes:
        sums = _sums(rows, np.array([s.tried for s in open_.values()]))
        passes += 1
        for (c, s), found in zip(open_.items(), sums):
            loss = 0.5 * float(penalty @ s.tried**2) + c * found[0]
            if s.step is not None and not loss <= s.loss + 1e-10 * abs(s.loss):
                s.step = s.step / 2
                s.tried = s.weights + s.step
                s.done = np.abs(s.step).max() <= tolerance * max(1.0, np.abs(s.weights).max())
                continue
            gradient = penalty * s.tried + c * found[1 : q + 1]
            curvature = np.diag(penalty) + c * found[q + 1 :].reshape(q, q)
            s.weights, s.loss, s.step = s.tried, loss, -np.linalg.lstsq(curvature, gradient, rcond=None)[0]
            s.tried = s.weights + s.step
            # Near the minimum a step squares the distance to it, so the last one is taken unseen.
            s.done = np.abs(s.step).max() <= tolerance * max(1.0, np.abs(s.weights).max())
    return {c: LogisticModel(tuple(map(float, s.tried[:-1])), float(s.tried[-1]), passes) for c, s in searches.items()}
