import numpy as np
import pyarrow as pa

from textgrain.llm.common import text_runs
from textgrain.llm.ordinal_quality import features, fit_ordinal, fit_quality, grade_documents, loss_and_gradient, thresholds_of

TABLES = "/root/testdata/sf0.01"


def test_gradient_equals_differences():
    source = np.random.default_rng(0)
    slots, rows = 1 << 8, 40
    texts = pa.array([" ".join(source.choice(["a", "bb", "c!", "Stem1234", "Stem12"], 9)) for _ in range(rows)])
    ((_, _, raw, offsets),) = text_runs(texts)
    row, slot, value = features(raw, offsets, slots)
    level = source.integers(0, 4, rows)
    point = np.concatenate((source.normal(size=slots), [-1.0, 0.2, -0.5]))
    _, slope = loss_and_gradient(row, slot, value, level, point, slots)
    for k in [*np.unique(slot)[:6], slots, slots + 1, slots + 2]:
        step = np.zeros(len(point))
        step[k] = 1e-6
        up, down = (loss_and_gradient(row, slot, value, level, point + s * step, slots)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - slope[k]) < 1e-4
    assert np.all(np.diff(thresholds_of(point[slots:])) > 0)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    model = fit_quality(docs, labels.filter("doc_id % 4 != 1"))
    rows = grade_documents(docs.join(labels.filter("doc_id % 4 = 1"), "doc_id"), model).collect()
    good = [r.tail >= 0.5 for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.tail >= 0.5 for r in rows if r.quality == 0 or r.toxic == 1]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.4 * len(bad)
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail <= 1 for r in rows)


def test_same_text_same_grade_and_odd_rows(spark):
    rows = [(1, "fine words here", 2), (2, "bad !!! ###", 0), (3, "so so ...", 1), (4, None, None), (5, "", 2), (6, "x" * 3_000_000, 1), (None, "fine", 2), (1, "fine words here", 2)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int").selectExpr("*", "'x' AS tail", "0 AS level", "1 AS slot").repartition(3)
    model = fit_ordinal(docs, "doc_id", "text", "grade")
    graded = grade_documents(docs, model)
    assert graded.columns.count("tail") == 1 and graded.count() == len(rows)
    by_text = {}
    for r in graded.collect():
        assert by_text.setdefault(r.text, r.tail) == r.tail
    assert by_text["fine words here"] > by_text["bad !!! ###"]


def test_nothing_to_learn(spark):
    fields = "doc_id long, text string, grade int"
    none = spark.createDataFrame([], fields)
    one = spark.createDataFrame([(1, "a", 1)], fields)
    assert grade_documents(none, fit_ordinal(none, "doc_id", "text", "grade")).count() == 0
    assert [r.tail for r in grade_documents(one, fit_ordinal(one, "doc_id", "text", "grade")).collect()] == [1.0]
