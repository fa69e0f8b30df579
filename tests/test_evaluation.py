import random

import pytest
from pyspark.sql import functions as F

from textgrain.operators import evaluation as ev


def scored(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, label int, prediction int, score double")


def published_counts():
    """Counts behind a validation report of 500 + 500 documents."""
    rows = []
    for label, prediction, n in ((0, 0, 140), (0, 1, 360), (1, 0, 20), (1, 1, 480)):
        rows += [(len(rows) + i, label, prediction, float(prediction)) for i in range(n)]
    return rows


def test_report_layout_and_values(spark):
    report = {r["class"]: r for r in ev.classification_report(scored(spark, published_counts())).collect()}
    assert list(report) == ["0", "1", "accuracy", "macro avg", "weighted avg"]

    def rounded(name):
        return [None if report[name][m] is None else round(report[name][m], 2) for m in ("precision", "recall", "f1")]

    assert rounded("0") == [0.88, 0.28, 0.42] and rounded("1") == [0.57, 0.96, 0.72]
    assert rounded("accuracy") == [None, None, 0.62]
    assert rounded("macro avg") == [0.72, 0.62, 0.57] == rounded("weighted avg")
    assert [report[c]["support"] for c in report] == [500, 500, 1000, 1000, 1000]


def test_auc_counts_pairs_and_ties(spark):
    rng = random.Random(1)
    rows = [(i, int(rng.random() < 0.3), 0, float(rng.randint(0, 12))) for i in range(400)]
    pos = [r[3] for r in rows if r[1] == 1]
    neg = [r[3] for r in rows if r[1] == 0]
    expected = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    df = scored(spark, rows)
    assert ev.roc_auc(df).first()["roc_auc"] == pytest.approx(expected)
    monotone = df.withColumn("score", F.exp(F.col("score") * 3))
    assert ev.roc_auc(monotone).first()["roc_auc"] == pytest.approx(expected)
    flipped = df.withColumn("score", -F.col("score"))
    assert ev.roc_auc(flipped).first()["roc_auc"] == pytest.approx(1 - expected)


def test_zero_denominators(spark):
    m = ev.binary_metrics(scored(spark, [(0, 0, 0, -1.0), (1, 0, 0, -2.0)])).first()
    assert (m["accuracy"], m["f1"], m["f1_macro"], m["roc_auc"]) == (1.0, 0.0, 0.5, None)
    assert m["confusion_matrix"] == [[2, 0], [0, 0]]


def test_hinge_uncertain_and_strongest(spark):
    df = scored(spark, [(0, 1, 1, 2.0), (1, 1, 0, -0.5), (2, 0, 1, 0.25), (3, 0, 0, -0.25)])
    assert ev.hinge_loss(df).first()["hinge_loss"] == pytest.approx((0 + 1.5 + 1.25 + 0.75) / 4)
    assert [r["doc_id"] for r in ev.most_uncertain(df, 2).collect()] == [2, 3]
    weights = spark.createDataFrame([("a", 1.0), ("b", -3.0), ("c", 2.0)], "feature string, weight double")
    assert [r["feature"] for r in ev.strongest_weights(weights, 2).collect()] == ["b", "c"]


def test_fold_summary_and_log(spark):
    df = spark.createDataFrame([("m", f, 0.5 + f / 10) for f in range(5)], "name string, fold int, accuracy double")
    row = ev.fold_summary(df, ["accuracy"], 5, ["name"]).first()
    assert row["accuracy_mean"] == pytest.approx(0.7) and row["accuracy_std"] == pytest.approx(0.02**0.5)
    assert [row[f"accuracy_fold_{i}"] for i in range(1, 6)] == pytest.approx([0.5, 0.6, 0.7, 0.8, 0.9])
    log = spark.createDataFrame([(1, 0.5, None), (1, None, 0.4), (2, 0.3, None)], "epoch int, loss double, eval_loss double")
    losses, evaluations = ev.log_slices(log)
    assert losses.count() == 2 and evaluations.count() == 1
