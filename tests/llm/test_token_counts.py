import random

import public_tokenizers
from tokenizers import Tokenizer

from textgrain.llm.token_counts import Counter, Vocabulary, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(PATH)
    source = random.Random(3)
    letters = list("abc  \t\n\x0b\x1c\x1f\x85\xa0'sdrevl09²½éßñ̀ 　中😀<|>​١ªµ×ʰ ") + ["<|endoftext|>", "'ll"]
    texts = ["".join(source.choice(letters) for _ in range(source.randint(0, 60))) for _ in range(2000)]
    texts += ["", None, "a" * 50_000, "x " * 50_000, "<|endoftext|>" * 3, "word\x00", "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS n_bytes")
    rows = {r.doc_id: r for r in token_counts(docs.repartition(3), PATH).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        number = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit) == (number, len((text or "").encode()), number > 512), repr(text)


def test_proven_tokens_are_single_tokens():
    library, vocabulary = Tokenizer.from_file(PATH), Vocabulary(PATH)
    source = sorted(vocabulary.whole)[::97]
    assert len(vocabulary.whole) > 40_000
    assert all(len(library.encode(text, add_special_tokens=False).ids) == 1 for text in source)
    assert Counter(vocabulary).count(source) == [1] * len(source)


def test_empty_table(spark):
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
