import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from textgrain.llm.common import text_runs
from textgrain.llm.phrase_automata import Words, phrase_digests, phrase_spans


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    found = []
    for (key, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        found.append((key, len(words), sum(gone), spans, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=repr)


def corpus(seed, window):
    source = random.Random(seed)
    bag = [f"w{k}" for k in range(60)] + ["The", "the", "é😀", "a,", "x"]

    def words(n):
        return [source.choice(bag) for _ in range(n)]

    passages = [words(source.randint(window, 2 * window)) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = words(source.randint(0, window))
        if i % 2:
            parts += source.choice(passages)[source.randint(0, 4) :]
        if i % 5 == 0:
            parts += words(source.randint(0, 3)) + source.choice(passages)[: -source.randint(1, 5)]
        rows.append((i, source.choice((" ", "\n", " \t ")).join(parts + words(source.randint(0, 9)))))
    base = words(4 * window)
    for i in range(30):
        near = list(base)
        for _ in range(3):
            near[source.randrange(len(near))] = source.choice(bag)
        rows.append((300 + i, " ".join(near)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a " * (window + 9)), (504, "b " * (window - 1)), (505, "c " * window), (506, "d " * (window + 1)), (3, rows[3][1])]
    rows += [(None, rows[9][1]), (None, "own " + rows[11][1]), (507, rows[13][1] + " " + rows[13][1]), (3, rows[7][1] + " more"), (508, rows[21][1].replace(" ", "\n"))]
    return rows


@pytest.mark.parametrize("window, gram, block, limit", [(9, 3, 2000, 50), (35, 8, 1 << 23, 100_000), (12, 4, 1 << 23, 1)])
def test_spans_equal_brute_force(spark, window, gram, block, limit):
    rows = corpus(window, window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS id", "3 AS n", "4 AS block").repartition(4)
    result = phrase_spans(docs, window=window, gram=gram, block_bytes=block, limit=limit)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) for r in result.collect()), key=repr)
    assert got == brute(rows, window)


def test_anchors_follow_the_words():
    source = random.Random(5)
    texts = [" ".join(source.choice("abcdefgh") * source.randint(1, 3) for _ in range(n)) for n in (0, 5, 40, 90, 12)]
    (_, _, raw, offsets), = text_runs(pa.array(texts))
    words = Words(raw, offsets)
    names, chosen = words.anchors(12, 4)
    alone = []
    for text in texts:
        (_, _, raw, offsets), = text_runs(pa.array([text]))
        own = Words(raw, offsets)
        own_names, own_chosen = own.anchors(12, 4)
        alone += own_names[own_chosen[own_chosen >= 0]].tolist()
    assert names[chosen[chosen >= 0]].tolist() == alone
    assert len(alone) == sum(max(0, len(t.split()) - 11) for t in texts)


def test_very_long_and_empty(spark):
    source = random.Random(6)
    long = [f"v{source.randrange(3000)}" for _ in range(120_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[70_000:70_050])), (3, "z" * 500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in phrase_digests(docs).collect()}
    assert got == {1: (120_000, 50), 2: (50, 50), 3: (1, 0)}
    assert phrase_digests(docs.limit(0)).count() == 0
