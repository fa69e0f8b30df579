import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from textgrain.llm.common import text_runs
from textgrain.llm.suffix_buckets import removal_digests, text_anchors, without_repeats


def brute(rows, width):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(raw[i : i + width] for raw in raws for i in range(len(raw) - width + 1))
    found = []
    for (key, _), raw in zip(rows, raws):
        gone = [False] * (len(raw) + 1)
        for i in range(len(raw) - width + 1):
            if seen[raw[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        gone = gone[: len(raw)]
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        found.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def corpus(seed, width):
    source = random.Random(seed)
    bag = ["of ", "the ", "ä", "é😀 ", "x", "thonn ", "re", "\n"] + [f"w{k} " for k in range(50)]

    def text(n):
        return "".join(source.choice(bag) for _ in range(n))

    passages = [text(source.randint(width // 4, width)) for _ in range(12)]
    rows = []
    for i in range(160):
        parts = [text(source.randint(0, width)) for _ in range(3)]
        if i % 2:
            parts.insert(1, source.choice(passages))
        if i % 5 == 0:
            parts.append(source.choice(passages)[source.randint(0, 9) :])
        rows.append((i, "".join(parts)))
    base = text(3 * width)
    for i in range(25):
        near = list(base)
        for _ in range(3):
            near[source.randrange(len(near))] = source.choice("abcé")
        rows.append((300 + i, "".join(near)))
    rows += [(500, None), (501, ""), (502, "a" * (width + 40)), (503, "a" * (width - 1)), (504, "ab" * width), (505, "q" * width), (506, rows[3][1]), (3, rows[3][1]), (None, rows[9][1]), (507, rows[11][1] * 2)]
    return rows


@pytest.mark.parametrize("width", [20, 64, 200])
def test_digests_equal_brute_force(spark, width):
    rows = corpus(width, width)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS id", "3 AS n").repartition(4)
    got = sorted((tuple(r) for r in removal_digests(docs, width=width).collect()), key=repr)
    assert got == brute(rows, width)


def test_pieces_of_a_long_text_change_nothing():
    import pyarrow as pa

    source = random.Random(2)
    text = "".join(source.choice("abcdef ") for _ in range(9000))
    ((_, _, raw, offsets),) = text_runs(pa.array([text]))
    whole = text_anchors(raw, offsets, 100, 30)
    parts = text_anchors(raw, offsets, 100, 30, limit=1000)
    assert set(zip(whole[1], whole[4])) == set(zip(parts[1], parts[4]))
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(parts[2], parts[3])])
    assert np.array_equal(np.sort(covered), np.arange(9000 - 99))


def test_cleaned_texts_stay_valid(spark):
    rows = [(1, "é" * 150 + "one"), (2, "x" + "é" * 150 + "two"), (3, None), (4, "short")]
    got = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "one", 2: "xtwo", 3: None, 4: "short"}


def test_empty_table(spark):
    assert removal_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
