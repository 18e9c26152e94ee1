import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import curves, thresholds


def frame(spark, n=400, seed=2, levels=60):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(draw.random() < 0.25)
        rows.append((i, y, min(1.0, max(0.0, round((draw.gauss(0.35 + 0.25 * y, 0.2)) * levels) / levels))))
    return spark.createDataFrame(rows, "TransactionID bigint, isFraud int, prob double"), rows


def by_hand(rows):
    y, s = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    cuts = sorted(set(s), reverse=True)
    tp = np.array([(y[s >= c] == 1).sum() for c in cuts])
    fp = np.array([(y[s >= c] == 0).sum() for c in cuts])
    return np.array(cuts), tp, fp, (y == 1).sum(), (y == 0).sum()


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_curve_and_metrics(spark, slices):
    df, rows = frame(spark)
    cuts, tp, fp, p, n = by_hand(rows)
    points = curves.curve_points(df, slices=slices)
    found = sorted(points.collect(), key=lambda r: -r["threshold"])
    assert [r["threshold"] for r in found] == list(cuts)
    assert [r["tp"] for r in found] == list(tp) and [r["fp"] for r in found] == list(fp)
    m = curves.curve_metrics(points, 0.05).first()
    recall, precision = tp / p, tp / (tp + fp)
    assert m["pr_auc"] == pytest.approx(np.sum(np.diff(np.concatenate([[0], recall])) * precision), abs=1e-12)
    x, y = np.concatenate([[0], fp / n]), np.concatenate([[0], tp / p])
    assert m["roc_auc"] == pytest.approx(np.trapezoid(y, x), abs=1e-12)
    assert m["recall_at_fpr"] == max(y[x <= 0.05])


def test_class_is_strictly_above_the_threshold(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7), (0, 0.5), (0, 0.2)], "isFraud int, prob double")
    assert tuple(curves.confusion(df, 0.5).first()) == (1, 0, 2, 1)
    best = thresholds.f1_threshold(curves.pr_curve(curves.curve_points(df))).first()
    assert best["threshold"] in (0.5, 0.7)
    # The chosen row itself is classified negative, though the curve counted it as positive.
    assert df.where(F.col("prob") > best["threshold"]).count() < df.where(F.col("prob") >= best["threshold"]).count()


def test_constant_scores(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "isFraud int, prob double")
    m = curves.curve_metrics(curves.curve_points(df)).first()
    assert (m["pr_auc"], m["roc_auc"], m["recall_at_fpr"]) == (pytest.approx(1 / 3), 0.5, 0.0)
    assert {r["left"] for r in curves.score_density(df).collect()} == {0.5}


def test_single_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "isFraud int, prob double")
    m = curves.curve_metrics(curves.curve_points(df)).first()
    assert m["pr_auc"] == 0.0 and m["roc_auc"] is None and m["recall_at_fpr"] is None
    assert {r["recall"] for r in curves.pr_curve(curves.curve_points(df)).collect()} == {1.0}
    metrics = curves.class_metrics(curves.confusion(df, 0.95)).first()
    assert (metrics["precision"], metrics["recall"], metrics["f1"], metrics["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_business_threshold(spark):
    df, rows = frame(spark)
    curve = curves.pr_curve(curves.curve_points(df))
    table = [r.asDict() for r in curve.collect()]
    reached = [r for r in table if r["precision"] >= 0.7]
    best = max(reached, key=lambda r: (r["recall"], r["precision"], r["threshold"]))
    found = thresholds.business_threshold(curve, 0.3).first()
    assert found["reached"] and found["threshold"] == best["threshold"]
    # Out of reach: F1 decides.
    unreachable = thresholds.business_threshold(curve.where("precision < 0.9"), 0.01).first()
    f1 = thresholds.f1_threshold(curve.where("precision < 0.9")).first()
    assert not unreachable["reached"] and unreachable["threshold"] == f1["threshold"]


def test_strategies(spark):
    df, _ = frame(spark)
    curve = curves.pr_curve(curves.curve_points(df))
    assert thresholds.choose_threshold(curve, "f1").first()["threshold"] == thresholds.f1_threshold(curve).first()["threshold"]
    with pytest.raises(ValueError):
        thresholds.choose_threshold(curve, "best")


def test_split_report_equals_separate_metrics(spark):
    df, _ = frame(spark)
    parts = df.withColumn("split", F.when(F.col("TransactionID") < 250, "train").otherwise("val"))
    report = {r["split"]: r for r in curves.split_report(parts, 0.4).collect()}
    for name in ("train", "val"):
        alone = curves.curve_metrics(curves.curve_points(parts.where(F.col("split") == name))).first()
        assert report[name]["pr_auc"] == pytest.approx(alone["pr_auc"]) and report[name]["roc_auc"] == alone["roc_auc"]


def test_density_matches_numpy(spark):
    df, rows = frame(spark, levels=997)
    for label in (0, 1):
        scores = np.array([r[2] for r in rows if r[1] == label])
        expected, edges = np.histogram(scores, bins=50, density=True)
        found = {r["bin"]: r["density"] for r in curves.score_density(df).where(F.col("isFraud") == label).collect()}
        assert [found.get(b, 0.0) for b in range(50)] == pytest.approx(list(expected), abs=1e-9)


def test_kde_matches_formula(spark):
    df, rows = frame(spark)
    for label in (0, 1):
        s = np.array([r[2] for r in rows if r[1] == label])
        h = len(s) ** -0.2 * s.std(ddof=1)
        grid = np.linspace(s.min(), s.max(), 200)
        expected = np.exp(-0.5 * ((grid[:, None] - s) / h) ** 2).sum(axis=1) / (len(s) * h * np.sqrt(2 * np.pi))
        found = curves.score_kde(df).where(F.col("isFraud") == label).orderBy("point").collect()
        assert [r["x"] for r in found] == pytest.approx(list(grid))
        assert [r["density"] for r in found] == pytest.approx(list(expected))


def test_unscored_rows_are_left_out(spark):
    df = spark.createDataFrame([(1, None), (1, 0.7), (0, 0.2)], "isFraud int, prob double")
    assert curves.curve_points(df).count() == 2
    assert tuple(curves.confusion(df, 0.5).first()) == (1, 0, 1, 0)


def test_binned_density_keeps_its_bound(spark):
    draw = np.random.default_rng(2)
    scores = np.concatenate([draw.normal(0.3, 0.05, 60_000), draw.beta(2, 5, 40_000)])
    labels = (np.arange(len(scores)) % 10 == 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"prob": scores, "isFraud": labels}))
    for r in curves.score_kde_binned(df, grid=25).collect():
        own = scores[labels == r["isFraud"]]
        h = len(own) ** -0.2 * own.std(ddof=1)
        exact = np.exp(-0.5 * ((r["x"] - own) / h) ** 2).sum() / (len(own) * h * np.sqrt(2 * np.pi))
        assert abs(r["density"] - exact) <= r["bound"] + 1e-9 and r["bound"] < 0.05
