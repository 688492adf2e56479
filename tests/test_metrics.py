import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from revlens.operators import metrics


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, score double").repartition(4)


def random_rows(n=500, levels=60, seed=1):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.3), rng.randint(0, levels) / levels) for _ in range(n)]


def by_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [1, 5, 60, 10_000])
@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_auc(spark, levels, buckets):
    rows = random_rows(levels=levels)
    df = frame(spark, rows)
    got = metrics.auc(df, buckets=buckets).first()[0]
    assert got == pytest.approx(by_pairs(rows))
    if buckets == 16:
        assert got == pytest.approx(BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df))


def test_auc_edges(spark):
    assert metrics.auc(frame(spark, [(1, 0.5), (0, 0.5), (0, 0.5)])).first()[0] == 0.5
    assert metrics.auc(frame(spark, [(1, 0.5), (1, 0.2)])).first()[0] is None
    with_gaps = [(1, 0.9), (0, 0.1), (1, None), (0, float("nan"))]
    assert metrics.auc(frame(spark, with_gaps)).first()[0] == 1.0


def curve(rows):
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    points = [(0.0, 0.0, math.inf)]
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        points.append((fp / neg, tp / pos, t))
    return points


@pytest.mark.parametrize("buckets", [2, 8, 256])
def test_roc_curve(spark, buckets):
    rows = random_rows(300, 40)
    got = [tuple(r) for r in metrics.roc_curve(frame(spark, rows), buckets=buckets).orderBy(F.desc("threshold")).collect()]
    want = curve(rows)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w)


@pytest.mark.parametrize("buckets", [2, 8, 256])
def test_roc_bends(spark, buckets):
    rows = random_rows(200, 1000)
    full = curve(rows)
    n = len(full)
    counts = [(0, 0)] + [
        (sum(1 for y, s in rows if s == t and y == 0), sum(1 for y, s in rows if s == t and y == 1)) for _, _, t in full[1:]
    ]
    want = [full[0]] + [full[i] for i in range(1, n) if i == n - 1 or counts[i] != counts[i + 1]]
    out = metrics.roc_curve(frame(spark, rows), drop_collinear=True, buckets=buckets).orderBy(F.desc("threshold")).collect()
    assert [r["threshold"] for r in out] == [w[2] for w in want]


def test_auc_per_class(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 2), [rng.random() for _ in range(3)]) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, probability array<double>")
    got = {r["class"]: r["auc"] for r in metrics.auc_per_class(df, "label", "probability", [0, 1, 2]).collect()}
    assert got == {c: pytest.approx(by_pairs([(int(y == c), p[c]) for y, p in rows])) for c in range(3)}


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["rows"] for r in metrics.confusion_matrix(df).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 4 and cells[(2, 1)] == 1 and cells[(2, 2)] == 0
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert set(report) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert report["2"]["f1"] == 0 and report["0"]["f1"] == pytest.approx(2 / 3)
    assert report["1"]["precision"] == pytest.approx(1 / 3)
    assert metrics.macro_f1(df).first()[0] == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    assert metrics.accuracy(df).first()[0] == 0.5
    assert tuple(metrics.scores(df).first()) == pytest.approx(((2 / 3 + 0.5) / 3, 0.5))


def test_prediction_outside_the_labels(spark):
    df = spark.createDataFrame([(0, 0), (0, 3)], "label int, prediction int")
    assert metrics.macro_f1(df).first()[0] == pytest.approx((2 / 3) / 2)


def test_rand_index(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 2), rng.randint(0, 3)) for _ in range(60)]
    same = [(a[0] == b[0]) == (a[1] == b[1]) for i, a in enumerate(rows) for b in rows[:i]]
    df = spark.createDataFrame(rows, "c int, l int")
    assert metrics.rand_index(df, "c", "l").first()[0] == pytest.approx(sum(same) / len(same))


def test_confusion_refuses_what_is_no_class(spark, monkeypatch):
    monkeypatch.setattr(metrics, "MAX_CLASSES", 5)
    df = spark.range(10).selectExpr("id AS label", "id AS prediction")
    with pytest.raises(Exception, match="not class columns"):
        metrics.confusion_matrix(df).collect()
