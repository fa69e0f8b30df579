"""Scoring, evaluation tables and fitted models."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.functions import ngrams as ng
from textgrain.functions import text as tx
from textgrain.operators import evaluation as ev
from textgrain.operators import features as ft
from textgrain.operators import hooks, models, pooling, subset
from textgrain.operators import ngram_tables as nt
from textgrain.plans.fragments import CORPUS, LANGUAGES, sequence_ngrams_cte, sql, words_cte
from textgrain.plans.registry import query
from textgrain.plans.text_queries import _processed, lexicon
from textgrain.plans.vector_queries import _DEVIATIONS, _train_word_counts, embeddings
from textgrain.session import durable
from textgrain.sources import sinks
from textgrain.sources.tables import EMBEDDING_WIDTH, corpus, ranked_word_vectors, table

SPLITS = ("train", "validation", "test")


def scored_by_length(spark, folder) -> DataFrame:
    """Labelled documents with a margin that SQL can reproduce: the text length, shifted."""
    margin = (F.char_length("text") - 1200) / F.lit(1000.0)
    return corpus(spark, folder).select(
        "doc_id", "split", "label", margin.alias("score"), (margin > 0).cast("int").alias("prediction")
    )


_SCORED = """
scored AS (
  SELECT doc_id, split, label, (length(text) - 1200) / 1000.0::DOUBLE AS score,
         CASE WHEN length(text) > 1200 THEN 1 ELSE 0 END AS prediction FROM corpus)"""

_TALLY = """
tally AS (
  SELECT split, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM scored GROUP BY split),
rates AS (
  SELECT *, tn + fp + fn + tp AS n,
         CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1,
         CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1,
         CASE WHEN 2*tn + fn + fp = 0 THEN 0 ELSE 2*tn / (2*tn + fn + fp) END AS f0,
         CASE WHEN 2*tp + fn + fp = 0 THEN 0 ELSE 2*tp / (2*tp + fn + fp) END AS f1
  FROM tally)"""


def _auc_sql(by: str) -> str:
    """Pairs counted one by one: every positive against every negative."""
    return f"""
SELECT p.{by}, avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END) AS roc_auc
FROM scored p JOIN scored q ON p.{by} = q.{by} AND p.label = 1 AND q.label = 0 GROUP BY p.{by}"""


# --- evaluation tables ------------------------------------------------------------


@query("binary_metrics", lambda: sql(
    CORPUS, _SCORED, _TALLY,
    final=f"""
SELECT split, n, (tn + tp) / n AS accuracy, f1, (f0 + f1) / 2 AS f1_macro, round(roc_auc, 9) AS roc_auc, tn, fp, fn, tp
FROM rates JOIN ({_auc_sql("split")}) USING (split)""",
))
def binary_metrics(spark, folder):
    m = ev.binary_metrics(scored_by_length(spark, folder), ["split"])
    cell = F.col("confusion_matrix")
    return m.select(
        "split", "n", "accuracy", "f1", "f1_macro", F.round("roc_auc", 9).alias("roc_auc"),
        cell[0][0].alias("tn"), cell[0][1].alias("fp"), cell[1][0].alias("fn"), cell[1][1].alias("tp"),
    )


@query("auc", lambda: sql(CORPUS, _SCORED, final=f"SELECT split, round(roc_auc, 9) AS roc_auc FROM ({_auc_sql('split')})"))
def auc(spark, folder):
    areas = ev.roc_auc(scored_by_length(spark, folder), ["split"])
    return areas.select("split", F.round("roc_auc", 9).alias("roc_auc"))


@query("confusion", lambda: sql(CORPUS, _SCORED, _TALLY, final="SELECT split, tn, fp, fn, tp FROM tally"))
def confusion(spark, folder):
    return ev.confusion_counts(scored_by_length(spark, folder), ["split"])


@query("class_report", lambda: sql(
    CORPUS, _SCORED, _TALLY,
    final="""
SELECT split, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, tn + fp AS support FROM rates
UNION ALL SELECT split, '1', p1, r1, f1, tp + fn FROM rates
UNION ALL SELECT split, 'accuracy', NULL, NULL, (tn + tp) / n, n FROM rates
UNION ALL SELECT split, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM rates
UNION ALL SELECT split, 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / n, (r0 * (tn + fp) + r1 * (tp + fn)) / n,
                 (f0 * (tn + fp) + f1 * (tp + fn)) / n, n FROM rates""",
))
def class_report(spark, folder):
    return ev.classification_report(scored_by_length(spark, folder), ["split"])


@query("hinge_loss", lambda: sql(
    CORPUS, _SCORED,
    final="SELECT split, round(avg(greatest(0, 1 - (CASE WHEN label = 1 THEN 1 ELSE -1 END) * score)), 9) AS hinge_loss FROM scored GROUP BY split",
))
def hinge_loss(spark, folder):
    losses = ev.hinge_loss(scored_by_length(spark, folder), ["split"])
    return losses.select("split", F.round("hinge_loss", 9).alias("hinge_loss"))


@query("most_uncertain", lambda: sql(
    CORPUS, _SCORED,
    final="SELECT doc_id, label, prediction, score, abs(score) AS uncertainty FROM scored WHERE split = 'test' ORDER BY abs(score), doc_id LIMIT 5",
))
def most_uncertain(spark, folder):
    test = scored_by_length(spark, folder).filter(F.col("split") == "test").drop("split")
    return ev.most_uncertain(test)


@query("softmax_metrics", """
WITH z AS (SELECT vec_id, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings),
scored AS (
  SELECT 0 AS g, label, exp(b - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS score,
         CASE WHEN b > a THEN 1 ELSE 0 END AS prediction FROM z),
t AS (SELECT count(*) AS n, count(*) FILTER (label = prediction) AS hit, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (label <> prediction) AS miss FROM scored)
SELECT hit / n AS accuracy, 2 * tp / (2 * tp + miss) AS f1,
       (SELECT round(avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END), 9)
        FROM scored p JOIN scored q ON p.g = q.g AND p.label = 1 AND q.label = 0) AS roc_auc
FROM t""")
def softmax_metrics(spark, folder):
    logits = embeddings(spark, folder).select("label", F.slice("vec", 1, 2).alias("logits"))
    metrics = ev.binary_metrics(ev.softmax_scored(logits))
    return metrics.select("accuracy", "f1", F.round("roc_auc", 9).alias("roc_auc"))


_FOLD_METRICS = ("accuracy", "f1_macro", "roc_auc")


@query("fold_summary", lambda: sql(
    CORPUS, _SCORED,
    """
folds AS (SELECT s.*, (row_number() OVER (PARTITION BY label ORDER BY md5('42-' || doc_id), doc_id) - 1) % 5 AS fold FROM scored s),
cells AS (SELECT fold, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM folds GROUP BY fold),
areas AS (SELECT p.fold, avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END) AS roc_auc
          FROM folds p JOIN folds q ON p.fold = q.fold AND p.label = 1 AND q.label = 0 GROUP BY p.fold),
per_fold AS (SELECT fold, (tn + tp) / (tn + fp + fn + tp) AS accuracy, roc_auc,
                    (CASE WHEN 2*tn + fn + fp = 0 THEN 0 ELSE 2*tn / (2*tn + fn + fp) END
                     + CASE WHEN 2*tp + fn + fp = 0 THEN 0 ELSE 2*tp / (2*tp + fn + fp) END) / 2 AS f1_macro
             FROM cells LEFT JOIN areas USING (fold))""",
    final="SELECT 'length' AS representation, "
    + ", ".join(f"round(avg({m}), 9) AS {m}_mean, round(stddev_pop({m}), 9) AS {m}_std, "
                + ", ".join(f"round(max(CASE WHEN fold = {i} THEN {m} END), 9) AS {m}_fold_{i + 1}" for i in range(5)) for m in _FOLD_METRICS)
    + " FROM per_fold",
))
def fold_summary(spark, folder):
    folded = durable(subset.with_folds(scored_by_length(spark, folder)))
    per_fold = ev.binary_metrics(folded, ["fold"]).withColumn("representation", F.lit("length"))
    summary = ev.fold_summary(per_fold, _FOLD_METRICS, 5, ["representation"])
    rounded = {c: F.round(c, 9) for c in summary.columns if c != "representation"}
    return sinks.with_legend(summary.withColumns(rounded))


@query("log_slices", """
SELECT event_id AS epoch, 'loss' AS kind, value FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, 'eval', value FROM events WHERE event_type = 'click'""")
def log_slices(spark, folder):
    """Events as a sparse log: some rows carry a training loss, others an evaluation."""
    events = table(spark, folder, "events")
    log = events.select(
        F.col("event_id").alias("epoch"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("eval_loss"),
    )
    losses, evaluations = ev.log_slices(log)
    return losses.select("epoch", F.lit("loss").alias("kind"), F.col("loss").alias("value")).unionByName(
        evaluations.select("epoch", F.lit("eval").alias("kind"), F.col("eval_loss").alias("value"))
    )


# --- relational scoring -----------------------------------------------------------

_WEIGHTS = """
weights AS (SELECT feature, std, ((length(feature) % 7) - 3) * 0.1::DOUBLE AS weight FROM deviations)"""


def _weight_table(spark, folder) -> DataFrame:
    train = _train_word_counts(spark, folder).filter(F.col("split") == "train")
    n = corpus(spark, folder).filter(F.col("split") == "train").count()
    weight = (F.char_length("feature") % 7 - 3) * F.lit(0.1)
    return ft.sparse_deviations(train, n).withColumn("weight", weight)


@query("linear_score", lambda: sql(
    CORPUS, words_cte("corpus", "split"), sequence_ngrams_cte("word", 1, "split"), _DEVIATIONS, _WEIGHTS,
    """
sums AS (SELECT doc_id, sum(cnt / total / std * weight) AS s
         FROM word1 JOIN weights ON feature = 'word_1grams::' || ngram GROUP BY doc_id)""",
    final="SELECT doc_id, round(coalesce(s, 0) + 0.5, 6) AS score FROM corpus LEFT JOIN sums USING (doc_id)",
))
def linear_score(spark, folder):
    counts = _train_word_counts(spark, folder).select("doc_id", "feature", "freq")
    weights = durable(_weight_table(spark, folder).withColumn("weights", F.array("weight")))
    scored = models.with_predictions(models.relational_scores(counts, weights, [0.5], corpus(spark, folder)))
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@query("top_weights", lambda: sql(
    CORPUS, words_cte("corpus", "split"), sequence_ngrams_cte("word", 1, "split"), _DEVIATIONS, _WEIGHTS,
    final="SELECT feature, weight FROM weights ORDER BY abs(weight) DESC, feature LIMIT 20",
))
def top_weights(spark, folder):
    return ev.strongest_weights(_weight_table(spark, folder)).select("feature", "weight")


# --- fitted models ----------------------------------------------------------------


def _labelled(spark, folder) -> DataFrame:
    return _processed(spark, folder, ["label", "split"], labelled=True)


def _labelled_tagged(spark, folder) -> DataFrame:
    """The same with lemmas and parts of speech of the lexicon."""
    return nt.processed_documents(corpus(spark, folder), tx.stop_words(LANGUAGES), lexicon(spark, folder), ["label", "split"])


def _flat_confusion(df: DataFrame) -> DataFrame:
    cell = F.col("confusion_matrix")
    flat = {"tn": cell[0][0], "fp": cell[0][1], "fn": cell[1][0], "tp": cell[1][1]}
    return df.withColumns(flat).drop("confusion_matrix")


@query("svm_fit_eval")
def svm_fit_eval(spark, folder):
    """Word unigrams at the chosen C, fitted on train and measured on all three splits."""
    families = ng.representations()["word_1grams"]
    return _flat_confusion(
        models.evaluate_splits(_labelled(spark, folder), families, "word_1grams", 0.001)
    )


@query("svm_hashed")
def svm_hashed(spark, folder):
    """All character n-grams with hashed features, so that no vocabulary is needed."""
    families = ng.representations()["char_2_3_4grams"]
    return _flat_confusion(
        models.evaluate_splits(
            _labelled(spark, folder), families, "char_2_3_4grams", 0.1, hashed=True
        )
    )


@query("grid_cv")
def grid_cv(spark, folder):
    """All representations and C values, five folds on the training split."""
    train = _labelled_tagged(spark, folder).filter(F.col("split") == "train").drop("split")
    return models.grid_search(durable(train))


@query("learning_curve")
def learning_curve(spark, folder):
    families = ng.representations()["word_1grams"]
    return models.learning_curve(_labelled(spark, folder), families, 0.001)


def token_hash_encoder():
    """A deterministic stand-in for a text encoder: hashed token counts in 32 dimensions."""

    def encode(texts):
        out = np.zeros((len(texts), 32))
        for row, text in enumerate(texts):
            for token in text.lower().split():
                out[row, zlib.crc32(token.encode()) % 32] += 1.0
        return out

    return encode


@query("encoder_hook")
def encoder_hook(spark, folder):
    vectors = hooks.encode_texts(corpus(spark, folder), token_hash_encoder)
    return vectors.select("doc_id", F.posexplode("vec").alias("dim", "value"))


def dense_tables(spark, folder) -> dict[str, DataFrame]:
    """The compared document vectors, each ``(doc_id, label, split, vec)``."""
    docs = corpus(spark, folder)
    words = ranked_word_vectors(spark, folder)
    runs, keep = tx.word_runs("text"), ["label", "split"]
    train = docs.filter(F.col("split") == "train")
    sif = durable(pooling.sif_pool(
        docs, words, EMBEDDING_WIDTH, runs, pooling.unigram_probabilities(train, runs), keep=keep
    ))
    direction = pooling.first_direction(sif.filter(F.col("split") == "train"))
    return {
        "encoder": hooks.encode_texts(docs, token_hash_encoder, keep),
        "masked_mean": pooling.truncated_mean_pool(docs, words, EMBEDDING_WIDTH, runs, keep=keep),
        "mean": pooling.sentence_vectors(docs, words, EMBEDDING_WIDTH, runs, keep),
        "mean_std": pooling.mean_std_pool(docs, words, EMBEDDING_WIDTH, tx.alpha_words("text"), keep),
        "sif": pooling.remove_direction(sif, direction),
    }


@query("representation_compare")
def representation_compare(spark, folder):
    return models.compare_representations(dense_tables(spark, folder))


@query("final_test")
def final_test(spark, folder):
    """The representation chosen on validation, fitted on train and measured on test."""
    tables = dense_tables(spark, folder)
    winner = models.compare_representations(tables).first()["representation"]
    return models.evaluate_dense(tables[winner], winner, on="test")


def _profile_vectors(spark, folder) -> DataFrame:
    names = list(ft.SURFACE_FEATURES)
    profile = ft.coerce_numeric(ft.surface_profile(corpus(spark, folder), ["label", "split"]), names)
    rows = profile.select("doc_id", "label", "split", F.array(*names).alias("vec"))
    scaler = ft.fit_scaler(rows.filter(F.col("split") == "train"))
    return rows.withColumn("vec", scaler.centred("vec"))


@query("epoch_losses")
def epoch_losses(spark, folder):
    """Hinge loss on three splits after each of the passes over the profile features."""
    rows = durable(_profile_vectors(spark, folder))
    history = models.fit_epochs(rows.filter(F.col("split") == "train"))
    return models.epoch_losses(rows, history)


@query("profile_report")
def profile_report(spark, folder):
    """Classification report of the profile model on validation and test."""
    rows = durable(_profile_vectors(spark, folder))
    weights, bias = models.fit_epochs(rows.filter(F.col("split") == "train"))[-1]
    scored = models.linear_scores(rows.filter(F.col("split") != "train"), weights, bias, ["split", "label"])
    return ev.classification_report(scored, ["split"])


@query("profile_top_weights")
def profile_top_weights(spark, folder):
    rows = _profile_vectors(spark, folder)
    model = models.fit_dense(rows.filter(F.col("split") == "train"))
    return ev.strongest_weights(models.model_weights(spark, model, ft.SURFACE_FEATURES))
