import public_tokenizers
import sentencepiece
from test_chosen_path import brute as brute_components
from test_string_tiling import brute_tiles, words

import corpus_pipeline
from textgrain.llm.ordinal_quality import fit_quality, grade_documents

TABLES = "/root/testdata/sf0.001"


def without(text, gone):
    """Characters that do not lie wholly in removed bytes."""
    kept, place = [], 0
    for character in text:
        size = len(character.encode())
        if not all(gone[place : place + size]):
            kept.append(character)
        place += size
    return "".join(kept)


def removed(raws, width=200):
    seen = {}
    for raw in raws:
        for i in range(len(raw) - width + 1):
            seen[raw[i : i + width]] = seen.get(raw[i : i + width], 0) + 1
    found = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - width + 1):
            if seen[raw[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        found.append(gone)
    return found


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near duplicates", "repeated passages", "benchmark leaks", "tokens"]

    graded = grade_documents(docs, fit_quality(docs, labels))
    good = stages["quality"](spark, docs, TABLES)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in graded.collect() if r.tail >= 0.5}

    unique = stages["near duplicates"](spark, docs, TABLES).cache()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in unique.collect()) == sorted(k for k, _, component in brute_components(rows, 5) if k == component)

    cleaned = stages["repeated passages"](spark, docs, TABLES).cache()
    raws = [t.encode() for _, t in rows]
    expected = {key: without(text, gone) for (key, text), gone in zip(rows, removed(raws))}
    assert {r.doc_id: r.text for r in cleaned.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())

    clean = stages["benchmark leaks"](spark, docs, TABLES)
    leaks = {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()}
    for key, text in rows[:60]:
        body = words(text)[:1500]
        best = max((sum(s for _, _, s in brute_tiles(i, body, 5)) / len(i) for _, i in items if len(i) >= 5 and set(zip(i, i[1:], i[2:], i[3:], i[4:])) & set(zip(body, body[1:], body[2:], body[3:], body[4:]))), default=0)
        assert (best >= 0.5) == (key in leaks) or len(words(text)) > 1500
    assert 0 < len(leaks) < 60

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = {r.doc_id: list(r.ids) for r in stages["tokens"](spark, docs, TABLES).collect()}
    assert ids == {key: library.encode(text) for key, text in rows}


def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = corpus_pipeline.run(spark, TABLES).collect()
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TABLES).cache()
    assert sorted((r.doc_id, tuple(r.ids)) for r in found) == sorted((r.doc_id, tuple(r.ids)) for r in docs.collect())
    assert 0 < len(found) < 200


def test_odd_rows_and_empty_tables(spark):
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (None, "a b c", "en", "s", 5), (3, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11)]
    fields = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, fields).selectExpr("*", "1 AS key", "2 AS id", "3 AS tail", "4 AS ids")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TABLES)
    assert docs.count() <= 4
    none = spark.createDataFrame([], fields)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, TABLES).count() == 0
