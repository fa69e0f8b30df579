import numpy as np
from pyspark.sql import functions as F

from textgrain.functions import vectors as vec
from textgrain.functions.text import word_runs
from textgrain.operators import directions, pooling

WORDS = {f"w{i}": np.random.default_rng(i).normal(size=70) for i in range(12)}
TEXTS = {0: "w1 w2 w2 zz", 1: "nothing here", 2: "w3", 3: "w1 w1 w4 w5 w6 W7", 4: ""}


def tables(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    vectors = spark.createDataFrame(
        [(w, [float(x) for x in v]) for w, v in WORDS.items()], "token string, vec array<float>"
    )
    return docs, vectors


def pooled(df):
    return {r["doc_id"]: np.array(r["vec"]) for r in df.collect()}


def known(text):
    return [w for w in text.lower().split() if w in WORDS]


def check(got, function, width):
    for doc, text in TEXTS.items():
        words = known(text)
        expected = function(np.stack([WORDS[w] for w in words]), words) if words else np.zeros(width)
        np.testing.assert_allclose(got[doc], expected, atol=1e-6)


def test_mean_and_deviation(spark):
    docs, vectors = tables(spark)
    check(pooled(pooling.mean_pool(docs, vectors, 70, word_runs("text"))), lambda m, w: m.mean(0), 70)
    both = pooled(pooling.mean_std_pool(docs, vectors, 70, word_runs("text")))
    check(both, lambda m, w: np.concatenate([m.mean(0), m.std(0)]), 140)


def test_sif(spark):
    docs, vectors = tables(spark)
    prob = pooling.unigram_probabilities(docs.filter("doc_id < 3"), word_runs("text"))
    train = [t for d, text in TEXTS.items() if d < 3 for t in text.lower().split()]
    p = {w: train.count(w) / len(train) for w in set(train)}
    assert {r["token"]: r["p"] for r in prob.collect()} == p

    def expected(m, words):
        return np.average(m, axis=0, weights=[1e-3 / (1e-3 + p.get(w, 0)) for w in words])

    check(pooled(pooling.sif_pool(docs, vectors, 70, word_runs("text"), prob)), expected, 70)


def test_blocks_equal_the_sums_by_row(spark, monkeypatch):
    """Many blocks; null and repeated ids, repeated words in the table, missing components."""
    monkeypatch.setattr(pooling, "BLOCK_BYTES", 8)
    monkeypatch.setattr(pooling, "PAIRS", 2)
    texts = [(0, "a b a zz"), (0, "b c"), (1, "c c d"), (None, "a e"), (None, "b"), (2, None), (3, "zz"), (4, "e"), (5, "a b c d e")]
    table = [("a", [1.0, 2.0]), ("a", [3.0, 5.0]), ("b", [0.5, None]), ("c", [4.0, 1.0]), ("d", [7.0]), ("e", None), (None, [9.0, 9.0])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    vectors = spark.createDataFrame(table, "token string, vec array<float>")
    got = {r.doc_id: r.vec for r in pooling.pooled(
        docs, F.split("text", " "), F.octet_length("text"), vectors.withColumn("weight", F.lit(1.0)), "token", 2, deviation=True
    ).collect()}
    expected = {}
    for doc in {d for d, _ in texts}:
        rows = [v for d, t in texts if d == doc for w in (t or "").split() for k, v in table if k == w]
        if rows:
            sums = [[(v or [])[i] for v in rows if v and len(v) > i and v[i] is not None] for i in range(2)]
            means = [sum(x) / len(rows) if x else None for x in sums]
            spread = [(sum((y - m) ** 2 for y in x) / len(rows)) ** 0.5 if x else None for x, m in zip(sums, means)]
            expected[doc] = means + spread
    assert set(got) == set(expected) and got[4] == [None] * 4
    for doc, vector in expected.items():
        np.testing.assert_allclose(np.array(got[doc], float), np.array(vector, float), atol=1e-9)


def test_a_word_moves_once_per_block(spark):
    """One vector per word of a block is moved, not one per word of a document."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("w1 w2 w3").alias("text"))
    _, vectors = tables(spark)
    frame = pooling.mean_pool(docs, vectors, 70, word_runs("text"))
    assert frame.count() == 300
    assert "FlatMapCoGroupsInArrow" in frame._jdf.queryExecution().optimizedPlan().toString()


def test_sif_does_not_see_held_out_texts(spark):
    docs, _ = tables(spark)
    train = docs.filter("doc_id < 3")
    changed = docs.withColumn("text", F.when(F.col("doc_id") >= 3, "w1 w1 w1").otherwise(F.col("text")))
    before = pooling.unigram_probabilities(train, word_runs("text")).collect()
    after = pooling.unigram_probabilities(changed.filter("doc_id < 3"), word_runs("text")).collect()
    assert sorted(before) == sorted(after)


def test_first_direction_and_its_removal(spark):
    x = np.random.default_rng(0).normal(size=(60, 5)) + np.array([3, 0, 1, 0, 0])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "doc_id long, vec array<double>")
    axis = np.array(pooling.first_direction(df))
    leading = np.linalg.svd(x, full_matrices=False)[2][0]
    assert abs(abs(axis @ leading) - 1) < 1e-9
    rest = pooled(pooling.remove_direction(df, axis))
    assert max(abs(v @ axis) for v in rest.values()) < 1e-9


def test_leading_direction_of_wide_vectors(spark):
    """4,096 components, several restarts, null and short vectors; no matrix of that width exists."""
    source = np.random.default_rng(3)
    x = source.normal(size=(90, 4096)) + 0.3 * source.normal(size=(90, 1)) * source.normal(size=4096)
    rows = [[float(v) for v in row] for row in x] + [None, [float(v) for v in x[0][:5]], [None] * 4096]
    df = spark.createDataFrame([(v,) for v in rows], "vec array<double>").repartition(4)
    axis = directions.leading_direction(df)
    whole = np.vstack((x, np.pad(x[0][:5], (0, 4091))))
    leading = np.linalg.svd(whole, full_matrices=False)[2][0]
    assert abs(abs(axis @ leading) - 1) < 1e-9


def test_leading_direction_without_a_clear_winner(spark):
    for k in range(3):
        x = np.random.default_rng(k).normal(size=(400, 40))
        df = spark.createDataFrame([([float(v) for v in row],) for row in x], "vec array<float>")
        leading = np.linalg.svd(x.astype(np.float32).astype(float), full_matrices=False)[2][0]
        assert abs(abs(directions.leading_direction(df) @ leading) - 1) < 1e-12


def test_leading_direction_of_no_and_of_zero_vectors(spark):
    empty = spark.createDataFrame([], "vec array<double>")
    assert directions.leading_direction(empty).tolist() == []
    zeros = spark.createDataFrame([([0.0, 0.0],), ([0.0, 0.0],)], "vec array<double>")
    assert directions.leading_direction(zeros).tolist() == [0.0, 0.0]


def test_masked_mean_and_unit(spark):
    rows = [(0, 1, [1.0, 2.0]), (0, 0, [9.0, 9.0]), (0, 1, [3.0, 4.0]), (1, 0, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "doc_id long, mask int, vec array<double>")
    got = pooled(pooling.masked_mean_pool(df, 2))
    np.testing.assert_allclose(got[0], [2, 3])
    np.testing.assert_allclose(got[1], [0, 0])
    units = df.select("doc_id", vec.unit("vec").alias("vec")).collect()
    assert all(abs(np.linalg.norm(r["vec"]) - 1) < 1e-12 for r in units)
    zero = spark.createDataFrame([(0, [0.0, 0.0])], "doc_id long, vec array<double>")
    assert zero.select(vec.unit("vec").alias("v")).first()["v"] == [0.0, 0.0]


def test_softmax(spark):
    df = spark.createDataFrame([(0, [1000.0, 1001.0]), (1, [2.0, 2.0])], "doc_id long, logits array<double>")
    rows = df.select("doc_id", vec.softmax("logits").alias("p")).withColumn("k", vec.argmax("p")).orderBy("doc_id").collect()
    np.testing.assert_allclose(rows[0]["p"], [1 / (1 + np.e), np.e / (1 + np.e)])
    assert [r["k"] for r in rows] == [1, 0]


def test_truncated_mean_covers_the_first_tokens(spark):
    docs = spark.createDataFrame([(0, "a b a c"), (1, "zz"), (2, "")], "doc_id long, text string")
    vectors = spark.createDataFrame([("a", [3.0, 0.0]), ("b", [0.0, 4.0]), ("c", [9.0, 9.0])], "token string, vec array<double>")
    rows = pooling.truncated_mean_pool(docs, vectors, 2, F.split("text", " "), length=3).orderBy("doc_id").collect()
    assert [round(x, 9) for x in rows[0]["vec"]] == [round(6 / 52**0.5, 9), round(4 / 52**0.5, 9)]
    assert rows[1]["vec"] == [0.0, 0.0] and rows[2]["vec"] == [0.0, 0.0]
