import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprofile.operators import metrics as M
from tableprofile.operators import modeling as L
from tableprofile.operators import ordered


def scores(spark, n=3000, seed=1, ties=True):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.4).astype(int)
    s = rng.normal(size=n) + y
    if ties:
        s = np.round(s, 1)
    return y, s, spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double").repartition(5)


def brute_auc(y, s):
    wins = (s[y == 1][:, None] > s[y == 0][None, :]).sum() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).sum()
    return wins / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize("ties", [True, False])
def test_auc_and_curve(spark, ties):
    y, s, df = scores(spark, ties=ties)
    area = M.roc_auc(df, "y", "s").first()["roc_auc"]
    assert area == pytest.approx(brute_auc(y, s), abs=1e-12)
    curve = M.roc_curve(df, "y", "s")
    rows = curve.collect()
    assert tuple(rows[0]) == (float("inf"), 0.0, 0.0)
    assert [r["threshold"] for r in rows[1:]] == sorted(set(s.tolist()), reverse=True)
    for row in rows[1:: max(1, len(rows) // 20)]:
        assert row["fpr"] == pytest.approx(((s >= row["threshold"]) & (y == 0)).sum() / (y == 0).sum())
        assert row["tpr"] == pytest.approx(((s >= row["threshold"]) & (y == 1)).sum() / (y == 1).sum())
    assert (rows[-1]["fpr"], rows[-1]["tpr"]) == (1.0, 1.0)
    assert M.trapezoid_auc(curve).first()["auc"] == pytest.approx(area, abs=1e-12)


def brute_thinned(y, s):
    """Points of the curve whose cumulative counts have a second difference, besides the first and the last."""
    cuts = np.unique(s)[::-1]
    tps = np.array([((s >= c) & (y == 1)).sum() for c in cuts])
    fps = np.array([((s >= c) & (y == 0)).sum() for c in cuts])
    keep = np.ones(len(cuts), bool)
    keep[1:-1] = (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0)
    return [(float("inf"), 0.0, 0.0), *zip(cuts[keep].tolist(), (fps[keep] / (y == 0).sum()).tolist(), (tps[keep] / (y == 1).sum()).tolist())]


@pytest.mark.parametrize("ties", [True, False])
def test_thinned_curve(spark, ties):
    """Neighbours are found across buckets too, and the area stays."""
    y, s, df = scores(spark, 4000, ties=ties)
    whole, thin = M.roc_curve(df, "y", "s"), M.roc_curve(df, "y", "s", drop_intermediate=True)
    rows = [tuple(r) for r in thin.collect()]
    np.testing.assert_allclose(np.array(rows), np.array(brute_thinned(y, s)), rtol=1e-12)
    assert ties or len(rows) < whole.count()
    assert M.trapezoid_auc(thin).first()["auc"] == pytest.approx(M.trapezoid_auc(whole).first()["auc"], abs=1e-12)


def test_thinned_runs(spark):
    """Long straight runs keep their ends only; one score, two scores and no row at all."""
    n = 3000
    y, s = np.array([1] * n + [0] * n + [1]), np.arange(2 * n + 1)[::-1] / 7.0
    df = spark.createDataFrame(list(zip(y.tolist(), s.tolist())), "y int, s double")
    rows = [tuple(r) for r in M.roc_curve(df, "y", "s", drop_intermediate=True).collect()]
    np.testing.assert_allclose(np.array(rows), np.array(brute_thinned(y, s)), rtol=1e-12)
    assert len(rows) == 5
    one = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert [tuple(r) for r in M.roc_curve(one, "y", "s", drop_intermediate=True).collect()] == [(float("inf"), 0.0, 0.0), (0.5, 1.0, 1.0)]
    assert M.roc_curve(one.limit(0), "y", "s", drop_intermediate=True).count() == 1


def test_auc_edges(spark):
    one_class = spark.createDataFrame([(1, 0.1), (1, 0.2)], "y int, s double")
    assert M.roc_auc(one_class, "y", "s").first()["roc_auc"] is None
    same = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "y int, s double")
    assert M.roc_auc(same, "y", "s").first()["roc_auc"] == 0.5
    gaps = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5), (1, None), (0, float("nan"))], "y int, s double")
    assert M.roc_auc(gaps, "y", "s").first()["roc_auc"] == 1.0
    zero = spark.createDataFrame([(1, 0.0), (0, -0.0)], "y int, s double")
    assert M.roc_auc(zero, "y", "s").first()["roc_auc"] == 0.5


def test_auc_of_groups(spark):
    parts = [scores(spark, 500, seed) for seed in (1, 2)]
    df = parts[0][2].withColumn("g", F.lit(0)).unionByName(parts[1][2].withColumn("g", F.lit(1)))
    found = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, "y", "s", ["g"]).collect()}
    for g, (y, s, _) in enumerate(parts):
        assert found[g] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_trapezoid_outside_the_unit_range(spark):
    points = [(-5.0, 1.0), (0.0, 2.0), (0.0, 3.0), (2.5, 4.0), (40.0, 4.0)]
    df = spark.createDataFrame(points, "fpr double, tpr double").repartition(3)
    expected = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert M.trapezoid_auc(df).first()["auc"] == pytest.approx(expected)
    assert M.trapezoid_auc(df.limit(0)).first()["auc"] == 0.0


def test_buckets_follow_the_order(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).cast("double").alias("x"))
    rows = ordered.add_bucket(df, "x").orderBy("x").collect()
    buckets = [r["bucket"] for r in rows]
    assert buckets == sorted(buckets) and len(set(buckets)) > 8
    flat = df.select(F.lit(1.0).alias("x"))
    assert len({r["bucket"] for r in ordered.add_bucket(flat, "x").collect()}) == 1


def test_metrics_by_hand(spark):
    rows = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 9
    df = spark.createDataFrame(rows, "y int, p int")
    m = M.binary_metrics(df, "y", "p").first()
    assert (m["n"], m["accuracy"], m["precision"], m["recall"]) == (20, 0.75, 6 / 9, 0.75)
    assert m["f1"] == pytest.approx(12 / 17)
    assert [tuple(r) for r in M.confusion_counts(df, "y", "p").collect()] == [(0, 0, 9), (0, 1, 3), (1, 0, 2), (1, 1, 6)]
    report = {r["name"]: r for r in M.classification_report(df, "y", "p", {0: "No", 1: "Yes"}).collect()}
    assert list(report) == ["No", "Yes", "accuracy", "macro avg", "weighted avg"]
    assert report["Yes"]["f1"] == pytest.approx(12 / 17) and report["No"]["support"] == 12
    assert (report["accuracy"]["f1"], report["accuracy"]["precision"], report["accuracy"]["support"]) == (0.75, None, 20)
    assert report["macro avg"]["recall"] == pytest.approx((0.75 + 9 / 12) / 2)
    assert report["weighted avg"]["precision"] == pytest.approx((9 / 11 * 12 + 6 / 9 * 8) / 20)


def test_nothing_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    m = M.binary_metrics(df, "y", "p").first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_gain(spark):
    ours = spark.createDataFrame([(0.75, 0.8)], "accuracy double, f1 double")
    theirs = spark.createDataFrame([(0.40, 0.5)], "accuracy double, f1 double")
    rows = M.metric_gain(ours, theirs, ["accuracy", "f1"]).collect()
    assert [r["metric"] for r in rows] == ["accuracy", "f1"]
    assert [r["gain_points"] for r in rows] == pytest.approx([35.0, 30.0])


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(5003).select(F.col("id"), F.when(F.col("id") % 10 < 4, 1).when(F.col("id") % 97 == 5, None).otherwise(0).alias("y"))
    rows = L.stratified_split(df, "y", "id").collect()
    assert len(rows) == 5003
    for label in (0, 1, None):
        mine = sorted((r for r in rows if r["y"] == label), key=lambda r: hashlib.md5(f"42:{r['id']}".encode()).hexdigest())
        n = len(mine)
        test = int(0.2 * n + 0.5)
        validation = int(0.25 * (n - test) + 0.5)
        expected = ["test"] * test + ["validation"] * validation + ["train"] * (n - test - validation)
        assert [r["split"] for r in mine] == expected
    again = L.stratified_split(df.repartition(7), "y", "id").collect()
    assert sorted(map(tuple, map(str, rows))) == sorted(map(tuple, map(str, again)))
    balance = L.split_balance(spark.createDataFrame(rows, "id long, y int, split string").where("y is not null"), "y").collect()
    shares = {r["share"] for r in balance if r["label"] == 1}
    assert max(shares) - min(shares) < 0.01


def test_tiny_classes_split(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, y string")
    assert sorted(r["split"] for r in L.stratified_split(df, "y", "id").collect()) == ["train", "train", "validation"]
    assert L.stratified_split(df.limit(0), "y", "id").count() == 0


def test_split_with_more_classes_than_the_driver_holds(spark, monkeypatch):
    from tableprofile.functions import small

    df = spark.range(2000).select(F.col("id"), (F.col("id") % 20).alias("y"))
    plain = {r["id"]: r["split"] for r in L.stratified_split(df, "y", "id").collect()}
    monkeypatch.setattr(L, "settle", lambda table: small.settle(table, 3))
    assert {r["id"]: r["split"] for r in L.stratified_split(df, "y", "id").collect()} == plain


def test_baseline_follows_the_prior(spark):
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    share = L.prior_baseline(df, df, "y", "id").agg(F.avg("baseline_prediction")).first()[0]
    assert abs(share - 0.3) < 0.03


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    scaler = L.fit_scaler(df, ["a", "b"])
    row = scaler.first()
    assert (row["feature"], row["mean"]) == ("a", 3.0) and row["std"] == pytest.approx(np.std([1, 2, 6]))
    scaled = np.array([tuple(r) for r in L.apply_scaler(df, scaler).collect()])
    np.testing.assert_allclose(scaled[:, 0].std(), 1.0)
    np.testing.assert_array_equal(scaled[:, 1], 0.0)


def newton(x, y, c, steps=60):
    """L2 logistic regression with a free intercept, by Newton steps on the summed loss."""
    design = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(design.shape[1])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = penalty @ w + c * design.T @ (p - y)
        hessian = penalty + c * (design * (p * (1 - p))[:, None]).T @ design
        w = w - np.linalg.solve(hessian, gradient)
    return w


def test_grid_against_newton(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 2)) * [3.0, 0.2] + [10, -4]
    y = (rng.random(600) < 1 / (1 + np.exp(-(x[:, 0] - 10) + 5 * (x[:, 1] + 4)))).astype(int)
    rows = [(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    split = L.stratified_split(df, "y", "id")
    train, validation = split.where("split = 'train'"), split.where("split = 'validation'")
    grid = [0.001, 1.0, 100.0]
    found, fitted = L.grid_search(train, validation, ["a", "b"], "y", grid)
    found = found.collect()
    assert [r["c"] for r in found] == grid
    ids = [r["id"] for r in train.collect()]
    mean, std = x[ids].mean(axis=0), x[ids].std(axis=0)
    held = [r["id"] for r in validation.collect()]
    for row in found:
        w = newton((x[ids] - mean) / std, y[ids], row["c"])
        model = fitted.models[row["c"]]
        np.testing.assert_allclose(model.coefficients, w[:2], rtol=1e-6, atol=1e-9)
        assert model.intercept == pytest.approx(w[2], rel=1e-6, abs=1e-9) and model.passes < 30
        probability = 1 / (1 + np.exp(-(((x[held] - mean) / std) @ w[:2] + w[2])))
        assert row["roc_auc"] == pytest.approx(brute_auc(y[held], probability), abs=1e-9)
        assert row["accuracy"] == pytest.approx(((probability > 0.5) == y[held]).mean())
    best = L.best_model(spark.createDataFrame(found)).first()
    assert best["roc_auc"] == max(r["roc_auc"] for r in found)
    predicted = L.predict(split.where("split = 'test'"), fitted, best["c"])
    assert set(predicted.columns) == {"id", "a", "b", "y", "split", "prediction", "probability"}
    assert all((r["probability"] > 0.5) == (r["prediction"] == 1) for r in predicted.collect())


def test_one_pass_serves_all_penalties(spark, monkeypatch):
    """Passes over the rows do not grow with the grid, and no thread is needed."""
    from tableprofile.operators import logistic

    passes = []
    plain = logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda rows, points: passes.append(len(points)) or plain(rows, points))
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame([(float(t), *map(float, r)) for t, r in zip(y, x)], "y double, a double, b double, c double")
    grid = [0.001, 0.1, 1.0, 10.0, 1000.0]
    models = logistic.fit_penalties(df, grid, 100)
    assert passes[0] == len(grid) and len(passes) == models[1.0].passes < 30
    for c in grid:
        np.testing.assert_allclose([*models[c].coefficients, models[c].intercept], newton(x, y, c), rtol=1e-6, atol=1e-9)


def test_steps_that_overshoot_are_halved(spark):
    """Nearly separable rows with outliers, where plain Newton steps from the start raise the loss."""
    from tableprofile.operators import logistic

    x = [-20.0] * 50 + [20.0] * 50 + [400.0, -400.0]
    y = [0.0] * 50 + [1.0] * 50 + [0.0, 1.0]
    df = spark.createDataFrame(list(zip(y, x)), "y double, a double")
    model = logistic.fit_penalties(df, [100.0], 200)[100.0]
    z = np.array(x) * model.coefficients[0] + model.intercept
    residual = 1 / (1 + np.exp(-z)) - np.array(y)
    assert abs(model.coefficients[0] + 100 * (residual * x).sum()) < 1e-4 and abs(residual.sum()) < 1e-6


def test_rows_that_cannot_be_fitted(spark):
    from pyspark.errors import PythonException

    from tableprofile.operators import logistic

    one = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "y double, a double")
    for rows in (one, one.limit(0)):
        with pytest.raises(ValueError, match="labels 0 and 1"):
            logistic.fit_penalties(rows, [1.0], 10)
    gap = spark.createDataFrame([(1.0, 2.0), (0.0, None)], "y double, a double")
    with pytest.raises(PythonException, match="missing"):
        logistic.fit_penalties(gap, [1.0], 10)


def test_missing_feature_has_no_prediction(spark):
    fitted = L.Fitted(("a",), spark.createDataFrame([("a", 0.0, 1.0)], "feature string, mean double, std double"), {1.0: L.LogisticModel((2.0,), -1.0, 1)})
    df = spark.createDataFrame([(0.5,), (1.0,), (None,), (float("nan"),), (-1e6,)], "a double")
    got = [(r["prediction"], r["probability"]) for r in L.predict(df, fitted, 1.0).collect()]
    assert got[0] == (0, 0.5) and got[1][0] == 1 and got[2] == got[3] == (None, None) and got[4] == (0, 0.0)
