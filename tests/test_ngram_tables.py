import json
from collections import Counter

from pyspark.sql import functions as F

from textgrain.functions.ngrams import representations
from textgrain.operators import ngram_tables as nt
from textgrain.operators import ordering
from textgrain.operators.lookup import hot_keys, keyed_lookup
from textgrain.operators.vectorize import fit_features, hashed_features, named_features, training_vectors

TEXTS = ["il gatto nero e il gatto bianco", "a", "", "gatto gatto gatto cane"]


def processed(spark, stops=("il", "e")):
    docs = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(TEXTS)], "doc_id long, text string, label int")
    return nt.processed_documents(docs, list(stops), keep=["label"])


def words_of(text):
    return [w for w in text.split() if w not in ("il", "e")]


def test_counts_and_relative_frequencies(spark):
    rows = nt.ngram_counts(processed(spark), [("char", 2), ("word", 1), ("word", 2)]).collect()
    found = {(r["doc_id"], r["kind"], r["n"], r["ngram"]): (r["cnt"], r["freq"]) for r in rows}
    expected = {}
    for i, text in enumerate(TEXTS):
        w = words_of(text)
        joined = " ".join(w)
        bags = {
            ("char", 2): Counter(joined[k : k + 2] for k in range(len(joined) - 1)),
            ("word", 1): Counter(w),
            ("word", 2): Counter(" ".join(w[k : k + 2]) for k in range(len(w) - 1)),
        }
        for (kind, n), bag in bags.items():
            for gram, cnt in bag.items():
                expected[(i, kind, n, gram)] = (cnt, cnt / sum(bag.values()))
    assert found == expected


def test_profile_keeps_short_documents_and_orders_cells(spark):
    families = [("char", 3), ("word", 1)]
    rows = nt.ngram_profile(processed(spark), families, ["label"], as_json=True).orderBy("doc_id").collect()
    assert [r["label"] for r in rows] == [0, 1, 0, 1]
    assert json.loads(rows[2]["word_1grams"]) == [] and json.loads(rows[1]["char_3grams"]) == []
    bag = Counter(words_of(TEXTS[0]))
    expected = [w for w, _ in sorted(bag.items(), key=lambda x: (-x[1], x[0]))]
    assert [e["ngram"] for e in json.loads(rows[0]["word_1grams"])] == expected


def test_json_cells_decode(spark):
    df = spark.createDataFrame([(0, '[{"ngram":"à","freq":0.5}]'), (1, None), (2, "")], "doc_id long, c string")
    cells = [r["c"] for r in nt.cells_from_json(df, ["c"]).orderBy("doc_id").collect()]
    assert [[(e["ngram"], e["freq"]) for e in c] for c in cells] == [[("à", 0.5)], [], []]


def test_one_shuffle_from_text_to_profile_cells(spark):
    plan = nt.ordered_cells(nt.ngram_counts(processed(spark), [("char", 3), ("word", 2)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1


def test_parts_follow_the_size_of_the_texts(spark, monkeypatch):
    """What one task counts is bounded by bytes, whatever the number of shuffle partitions."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcd "), 200).alias("text"))
    monkeypatch.setattr(ordering.by_document, "__defaults__", ("doc_id", None, 4000))
    found = nt.ngram_counts(nt.processed_documents(docs, []), [("char", 2)])
    assert "hashpartitioning(doc_id" in (plan := found._jdf.queryExecution().executedPlan().toString())
    assert plan.count("Exchange ") == 1 and ", 101)" in plan
    assert found.agg(F.sum("cnt"), F.count("*")).first()[:] == (400 * 998, 400 * 5)


def test_words_do_not_depend_on_blanks(spark):
    docs = spark.createDataFrame([(0, "\x1c a\u00a0 l'\x85b\tc'd \u2003 e1_'"), (1, "\n ")], "doc_id long, text string")
    found = nt.processed_documents(docs, [])
    assert "regexp_replace" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"]: r["word"] for r in found.collect()} == {0: ["a", "l'", "b", "c'", "d", "e1_"], 1: []}


def test_lexicon_tags_keep_word_order(spark):
    docs = spark.createDataFrame([(0, "b a c a"), (1, "")], "doc_id long, text string")
    lexicon = spark.createDataFrame([("a", "A", "N"), ("b", "B", "V")], "form string, lemma string, pos string")
    rows = nt.processed_documents(docs, [], lexicon).orderBy("doc_id").collect()
    assert rows[0]["word"] == ["b", "a", "c", "a"]
    assert rows[0]["lemma"] == ["B", "A", "c", "A"]
    assert rows[0]["pos"] == ["V", "N", "X", "N"]
    assert rows[1]["word"] == [] and rows[1]["pos"] == []


def test_vocabulary_is_sorted_and_dense(spark):
    counts = nt.ngram_counts(processed(spark), [("char", 2), ("word", 1)])
    rows = nt.vocabulary(counts).orderBy("index").collect()
    names = sorted({f"{r['kind']}_{r['n']}grams::{r['ngram']}" for r in counts.collect()})
    assert [(r["feature"], r["index"]) for r in rows] == list(zip(names, range(len(names))))


def test_salted_lookup_equals_broadcast_lookup(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 90).cast("string")).alias("key"))
    table = rows.select("key").distinct().filter("key <> '7'").withColumn("v", F.length("key"))
    hot = {r["key"]: r["_salts"] for r in hot_keys(rows, "key", one_in=10).collect()}
    assert hot == {"hot": 4}
    for how in ("inner", "left"):
        small = keyed_lookup(rows, table, "key", "id", how)
        salted = keyed_lookup(rows, table, "key", "id", how, limit=-1, one_in=10)
        assert sorted(map(str, small.select("id", "key", "v").collect())) == sorted(
            map(str, salted.select("id", "key", "v").collect())
        )


def test_training_vectors_are_scaled_frequencies(spark):
    rows = named_features(nt.ngram_counts(processed(spark), [("word", 1)]))
    docs = processed(spark).select("doc_id", "label")
    fitted = fit_features(rows, 4)
    dense = {r["feature"]: (r["index"], r["std"]) for r in fitted.table.collect()}
    freqs = [Counter(words_of(t)) for t in TEXTS]
    for name, (_, std) in dense.items():
        word = name.split("::")[1]
        column = [bag[word] / max(sum(bag.values()), 1) for bag in freqs]
        mean = sum(column) / 4
        assert abs(std - (sum((x - mean) ** 2 for x in column) / 4) ** 0.5) < 1e-12
    vectors = training_vectors(rows, fitted, docs).collect()
    assert len(vectors) == 4 and {v["features"].size for v in vectors} == {fitted.size}
    assert sum(v["features"].numNonzeros() for v in vectors) == rows.count()


def test_hashed_features_keep_the_total_frequency(spark):
    counts = nt.ngram_counts(processed(spark), [("char", 2)])
    sums = hashed_features(counts, bits=3).groupBy("doc_id").agg(F.sum("freq").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1) < 1e-9 for r in sums)


def test_parts_are_smaller_where_a_text_has_more_ngrams(spark):
    """Fifteen families take about 500 bytes per byte of text: parts of 4 MB would be spilled."""
    every = representations()["all_ngrams"]
    assert nt.placed_bytes([("word", 1)]) == ordering.PLACED_BYTES
    assert nt.placed_bytes(every) * nt.NGRAM_BYTES * 5 <= nt.PART_MEMORY < 2 * nt.placed_bytes(every) * nt.NGRAM_BYTES * 5
    texts = spark.range(30).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a"), 1 << 20).alias("text"))
    placed = ordering.by_document(texts, size=F.octet_length("text"), most=nt.placed_bytes(every))
    assert placed.rdd.getNumPartitions() > 50
