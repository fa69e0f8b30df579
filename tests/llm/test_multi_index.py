import math

import numpy as np

from textgrain.llm.multi_index import nearest_neighbours


def brute(rows, k, every):
    fine = {}
    for key, vec in rows:
        if key is None or not vec or any(x is None or not math.isfinite(x) for x in vec) or not any(vec):
            continue
        fine[key] = min(fine.get(key, vec), vec)
    keys = sorted(fine)
    matrix = np.array([fine[i] for i in keys])
    norms = np.sqrt((matrix * matrix).sum(1))
    found = {}
    for key in keys:
        if key % every:
            continue
        v = np.array(fine[key])
        scores = (matrix * v).sum(1) / (np.sqrt((v * v).sum()) * norms)
        order = sorted((-s, i) for s, i in zip(scores.tolist(), keys) if i != key)[:k]
        found[key] = [(i, -s) for s, i in order]
    return found


def collected(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


def test_small_tables_are_exact(spark):
    source = np.random.default_rng(1)
    rows = [(i, source.normal(size=7).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0] * 7) for i in range(20)] + [(300, [2.0] * 7), (301, [0.0] * 7), (302, None), (303, [1.0, None] + [1.0] * 5), (304, [math.nan] * 7), (305, [math.inf] * 7), (306, []), (None, [1.0] * 7), (5, [9.0] * 7), (5, [9.0] * 7)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS id", "1 AS vec", "2 AS i").repartition(4)
    got, expected = collected(nearest_neighbours(table, k=5, every=10)), brute(rows, 5, 10)
    assert got.keys() == expected.keys()
    for key in got:
        assert [i for i, _ in got[key]] == [i for i, _ in expected[key]]
        assert np.allclose([s for _, s in got[key]], [s for _, s in expected[key]], rtol=0, atol=1e-12)


def test_recall_on_directionless_vectors(spark):
    source = np.random.default_rng(2)
    rows = [(i, source.normal(size=32).tolist()) for i in range(4000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, expected = collected(nearest_neighbours(table, least=10)), brute(rows, 5, 50)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9


def test_few_and_none(spark):
    fields = "vec_id long, embedding array<float>"
    assert nearest_neighbours(spark.createDataFrame([], fields)).count() == 0
    assert nearest_neighbours(spark.createDataFrame([(0, [1.0])], fields)).count() == 0
    assert collected(nearest_neighbours(spark.createDataFrame([(0, [1.0]), (1, [2.0])], fields))) == {0: [(1, 1.0)]}


def test_scaled_copies_of_a_vector_tie_by_id(spark):
    rows = [(k, [x * 2.0 ** ((k * 37) % 101 - 50) for x in (0.3, -0.7, 0.2, 0.5)]) for k in range(101)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(docs, k=5, every=25, share=1.0).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 25, 50, 75, 100)}
    assert got == {q: [k for k in range(6) if k != q][:5] for q in got}
