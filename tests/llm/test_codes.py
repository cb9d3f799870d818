"""Vector codes against a search that computes every distance."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from tableprofile.llm import codes


def all_distances(points, entries):
    d = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


@pytest.mark.parametrize("span, dim", [(3, 4), (50, 4), (1000, 7), (1, 1), (codes.LIMIT, 4)])
def test_equal_average_search(span, dim):
    """Small spans make ties of sums and of distances; the lower index wins."""
    rng = np.random.default_rng(span)
    points, entries = rng.integers(-span, span + 1, (500, dim)), rng.integers(-span, span + 1, (64, dim))
    entries[40] = entries[3]
    index, distance, tried = codes.nearest(points, entries)
    want = all_distances(points, entries)
    assert (index == want[0]).all() and (distance == want[1]).all()
    assert tried <= len(points) * len(entries)


def test_search_skips_entries():
    """Far sums are never compared: on spread-out sums only a few entries are."""
    entries = np.arange(64)[:, None] * np.full((1, 4), 1000)
    points = entries[np.arange(200) % 64] + 3
    index, _, tried = codes.nearest(points, entries)
    assert (index == np.arange(200) % 64).all() and tried <= 2 * 200


def brute(rows, parts=16, size=64, rounds=2):
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = -(-max(len(r[1]) for r in good) // parts)
    whole = np.zeros((len(good), parts * dim), np.int64)
    for i, r in enumerate(good):
        whole[i, : len(r[1])] = [math.floor(256 * x) for x in r[1]]
    cut = whole.reshape(len(good), parts, dim)
    books = cut[:size].transpose(1, 0, 2).copy()
    for turn in range(rounds + 1):
        entry, error = zip(*(all_distances(cut[:, p], books[p]) for p in range(parts)))
        for p in range(parts if turn < rounds else 0):
            for e in range(books.shape[1]):
                mine = cut[entry[p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(axis=0) // len(mine)
    errors = np.sum(error, axis=0)
    by_label = {}
    for r, e in zip(good, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{entry[p][i]:02x}" for p in range(parts)), int(errors[i]), by_label[r[2]], digest) for i, r in enumerate(good)), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, id long, v long, l long, code long, error long"


def coded(spark, rows, **settings):
    df = spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in codes.vector_codes(df, **settings).collect()), key=str)


def test_codes(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 32)], int(i) % 3 or None) for i in rng.permutation(400)]
    rows += [(900, None, 1), (901, [1.0, None] * 16, 1), (902, [float("nan")] * 32, 1), (903, [float("inf")] * 32, None), (5, rows[0][1], 2), (None, [0.5] * 32, 2)]
    assert coded(spark, rows) == brute(rows)


def test_edges(spark):
    short = [(1, [1.0, -2.0, 0.001], 1), (1, [1.0, -2.0, 0.001], 1), (2, [], None), (3, [0.25] * 17, None)]
    assert coded(spark, short) == brute(short)
    assert coded(spark, [(2, [], 4)]) == [(2, "00" * 16, 0, 0, hashlib.sha256(b"").hexdigest())]
    assert coded(spark, [(1, None, 1)]) == [] and coded(spark, []) == []
    with pytest.raises(ValueError):
        coded(spark, short, size=300)


def test_large_components_are_held():
    column = pa.array([[1e30, -1e30, 0.5]], pa.list_(pa.float64()))
    assert codes.integers(column, 4, 256).tolist() == [[codes.LIMIT, -codes.LIMIT, 128, 0]]
