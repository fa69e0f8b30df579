"""Evaluation tables from scored rows.

A scored row has ``label`` (0/1), ``prediction`` (0/1) and ``score`` (signed margin or
probability of class 1).  Every table is one grouped aggregation; ``by`` adds grouping
columns such as ``split``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrain.operators.ordering import BUCKET, range_buckets, with_running_totals


def _share(top: Column, bottom: Column) -> Column:
    """A ratio that is 0 where its denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def _tally(label: int, prediction: int) -> Column:
    hit = (F.col("label") == label) & (F.col("prediction") == prediction)
    return F.coalesce(F.sum(hit.cast("long")), F.lit(0))


def confusion_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., tn, fp, fn, tp)``"""
    return scored.groupBy(*by).agg(
        _tally(0, 0).alias("tn"), _tally(0, 1).alias("fp"), _tally(1, 0).alias("fn"), _tally(1, 1).alias("tp")
    )


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Nested ``[[tn, fp], [fn, tp]]``"""
    return confusion_counts(scored, by).select(
        *by, F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    )


def signed_label() -> Column:
    return F.when(F.col("label") == 1, 1.0).otherwise(-1.0)


def hinge(score: Column | str = "score") -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.greatest(F.lit(0.0), 1 - signed_label() * score)


def hinge_loss(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg(hinge()).alias("hinge_loss"))


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve: P(positive above negative) + half of the ties.

    Equal scores are merged first, so a score shared by a third of the rows is one row.
    The negatives below each distinct score are then a bucketed running total.
    """
    by = list(by)
    distinct = scored.groupBy(*by, "score").agg(
        F.sum((F.col("label") == 1).cast("long")).alias("pos"),
        F.sum((F.col("label") == 0).cast("long")).alias("neg"),
    )
    order = [F.col(c) for c in by] + [F.col("score")]
    placed = with_running_totals(
        range_buckets(distinct, *order), [F.col("score")], {"upto": F.col("neg")}, within=by, bucket=BUCKET
    )
    won = F.col("pos") * (F.col("upto") - F.col("neg")) + F.col("pos") * F.col("neg") / 2
    sums = placed.groupBy(*by).agg(
        F.sum(won).alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("q")
    )
    pairs = F.col("p") * F.col("q")
    return sums.select(*by, F.when(pairs > 0, F.col("won") / pairs).alias("roc_auc"))


def _class_columns() -> dict[str, Column]:
    """Per-class precision, recall, F1 and support from the four counts."""
    out: dict[str, Column] = {}
    for cls, hit, wrong, missed in ((0, "tn", "fn", "fp"), (1, "tp", "fp", "fn")):
        hits, wrongs, misses = F.col(hit), F.col(wrong), F.col(missed)
        out[f"precision_{cls}"] = _share(hits, hits + wrongs)
        out[f"recall_{cls}"] = _share(hits, hits + misses)
        out[f"f1_{cls}"] = _share(2 * hits, 2 * hits + wrongs + misses)
        out[f"support_{cls}"] = hits + misses
    return out


def count_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, F1 of class 1 and macro F1, with the confusion matrix."""
    per_class = _class_columns()
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return confusion_counts(scored, by).select(
        *by,
        total.alias("n"),
        _share(F.col("tn") + F.col("tp"), total).alias("accuracy"),
        per_class["f1_1"].alias("f1"),
        ((per_class["f1_0"] + per_class["f1_1"]) / 2).alias("f1_macro"),
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
    )


def binary_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``count_metrics`` plus ``roc_auc``: one row per ``by`` group."""
    by = list(by)
    counted = count_metrics(scored, by)
    areas = roc_auc(scored, by)
    if not by:
        return counted.withColumn("roc_auc", areas.scalar())
    return counted.join(areas, by)


def classification_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg`` and ``weighted avg`` per group."""
    by = list(by)
    counts = confusion_counts(scored, by).withColumns(_class_columns())
    n = F.col("support_0") + F.col("support_1")
    none = F.lit(None).cast("double")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def mean(metric: str) -> Column:
        return (F.col(f"{metric}_0") + F.col(f"{metric}_1")) / 2

    def weighted(metric: str) -> Column:
        return _share(
            F.col(f"{metric}_0") * F.col("support_0") + F.col(f"{metric}_1") * F.col("support_1"), n
        )

    metrics = ("precision", "recall", "f1")
    rows = [
        line(str(cls), *[F.col(f"{m}_{cls}") for m in metrics], F.col(f"support_{cls}")) for cls in (0, 1)
    ]
    rows.append(line("accuracy", none, none, _share(F.col("tn") + F.col("tp"), n), n))
    rows.append(line("macro avg", *[mean(m) for m in metrics], n))
    rows.append(line("weighted avg", *[weighted(m) for m in metrics], n))
    return counts.select(*by, F.inline(F.array(*rows)))


def most_uncertain(scored: DataFrame, k: int = 5, row_id: str = "doc_id") -> DataFrame:
    """The ``k`` rows with the smallest absolute score."""
    return (
        scored.withColumn("uncertainty", F.abs("score")).orderBy("uncertainty", row_id).limit(k)
    )


def strongest_weights(weights: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` features with the largest absolute weight, sign kept."""
    return weights.orderBy(F.desc(F.abs("weight")), "feature").limit(k)


def softmax_scored(logits: DataFrame, column: str = "logits") -> DataFrame:
    """Turn class logits into scored rows: probability of class 1 and most likely class."""
    from textgrain.functions.vectors import argmax, softmax

    return logits.withColumn("probability", softmax(column)).withColumns(
        {"score": F.get("probability", 1), "prediction": argmax("probability")}
    )


def fold_summary(fold_metrics: DataFrame, metrics: Sequence[str], k: int, by: Sequence[str]) -> DataFrame:
    """Mean, population deviation and one column per fold for every metric.

    ``fold_metrics`` is long: ``(by..., fold, metric columns)``, one row per fitted fold.
    """
    summary = []
    for metric in metrics:
        summary += [F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std")]
    for metric in metrics:
        summary += [
            F.max(F.when(F.col("fold") == fold, F.col(metric))).alias(f"{metric}_fold_{fold + 1}")
            for fold in range(k)
        ]
    return fold_metrics.groupBy(*by).agg(*summary)


def log_slices(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training-loss rows and evaluation rows of a sparse training log, by epoch."""
    losses = log.filter(F.col("loss").isNotNull()).select("epoch", "loss").orderBy("epoch")
    evaluations = log.filter(F.col("eval_loss").isNotNull()).orderBy("epoch")
    return losses, evaluations
