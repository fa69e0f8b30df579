import zlib

import numpy as np
import pandas as pd

from textgrain.llm.language import UNKNOWN, descend, fit_languages, gram_counts, identify_languages, leader_weights, train_language

TABLES = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    got = {r.doc_id: r for r in identify_languages(docs, fit_languages(docs)).collect()}
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == docs.count()
    held = [r for r in got.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    right = [r.lang_pred == known[r.doc_id] for r in held if r.lang_pred != UNKNOWN]
    assert np.mean(right) > 0.97
    assert abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.05


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", "fr"), (5, "123 !!", "en"), (6, "la " * 500_000, "fr"), (None, "the end", "en"), (7, "the cat", None), (1, "the cat and the dog", "en")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0.5 AS score", "1 AS key").repartition(3)
    found = identify_languages(docs, fit_languages(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.lang_pred == UNKNOWN and r.score == 0) if r.doc_id in (3, 4, 5) else r.lang_pred in ("en", "fr") and 0 < r.score <= 1
    assert {r.lang_pred for r in found if r.doc_id == 2} == {"fr"}


def test_none_and_one_language(spark):
    fields = "doc_id long, text string, lang string"
    assert identify_languages(spark.createDataFrame([], fields), fit_languages(spark.createDataFrame([], fields))).count() == 0
    unlabelled = spark.createDataFrame([(1, "a", None)], fields)
    assert [r.lang_pred for r in identify_languages(unlabelled, fit_languages(unlabelled)).collect()] == [UNKNOWN]
    one = spark.createDataFrame([(1, "a", "xx"), (3, "b", "xx")], fields)
    model = train_language(one.selectExpr("doc_id AS key", "text", "lang"))
    assert {(r.lang_pred, r.score) for r in identify_languages(one, model).collect()} == {("xx", 1.0)}


def test_descent_equals_plain_loops():
    source = np.random.default_rng(4)
    rows = pd.DataFrame({"slots": [np.sort(source.choice(9, 4, replace=False)) for _ in range(30)], "values": [source.random(4) for _ in range(30)], "label": source.integers(0, 3, 30)})
    z, n = np.zeros((10, 3)), np.zeros((10, 3))
    descend(z, n, rows)
    plain_z, plain_n = np.zeros((10, 3)), np.zeros((10, 3))
    for slots, values, label in rows.itertuples(index=False):
        x = dict(zip(slots.tolist(), values.tolist())) | {9: 1.0}
        w = leader_weights(plain_z, plain_n)
        scores = [sum(v * w[i, c] for i, v in x.items()) for c in range(3)]
        chance = np.exp(scores) / np.exp(scores).sum()
        for i, v in x.items():
            for c in range(3):
                g = v * (chance[c] - (c == label))
                plain_z[i, c] += g - (np.sqrt(plain_n[i, c] + g * g) - np.sqrt(plain_n[i, c])) * w[i, c]
                plain_n[i, c] += g * g
    assert np.allclose(z, plain_z) and np.allclose(n, plain_n)


def test_gram_counts():
    ((slots, counts),) = gram_counts(["aaa"])
    assert counts.sum() == 6 and len(slots) == 3
    ((slots, _),) = gram_counts([""])
    assert len(slots) == 0
