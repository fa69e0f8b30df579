import random
import re

import numpy as np

from textgrain.llm.string_tiling import contamination, tiles


def brute_tiles(item, text, least):
    """Longest unmarked common run first, by trying every pair of places."""
    marked_item, marked_text, found = [False] * len(item), [False] * len(text), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(text)):
                size = 0
                while i + size < len(item) and j + size < len(text) and item[i + size] == text[j + size] and not marked_item[i + size] and not marked_text[j + size]:
                    size += 1
                if size >= least and (best is None or (-size, i, j) < best):
                    best = (-size, i, j)
        if best is None:
            return found
        size, i, j = -best[0], best[1], best[2]
        for k in range(size):
            marked_item[i + k] = marked_text[j + k] = True
        found.append((i, j, size))


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_tiles_equal_brute_force():
    source = random.Random(7)
    for _ in range(400):
        item = [source.randint(0, 3) for _ in range(source.randint(0, 45))]
        text = [source.randint(0, 3) for _ in range(source.randint(0, 60))]
        if item and source.random() < 0.5:
            cut = source.randint(0, len(item))
            text[3:3] = item[cut:] + item[:cut]
        least = source.choice((2, 3, 5))
        assert tiles(np.array(item, np.uint64), np.array(text, np.uint64), least) == brute_tiles(item, text, least)


def test_documents_equal_brute_force(spark):
    source = random.Random(8)
    bag = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(source.choice(bag) for _ in range(source.randint(3, 40)))) for i in range(20)] + [(50, None), (51, ""), (52, "w1 w2"), (53, "Ünder Äpfel sind drei vier fünf"), (5, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(150):
        text = [source.choice(bag) for _ in range(source.randint(0, 200))]
        if i % 3 == 0:
            leak = words(source.choice(items)[1])
            cut = source.randint(0, len(leak))
            at = source.randint(0, len(text))
            text[at:at] = leak[cut:] + ["z"] + leak[:cut]
        docs.append((i, source.choice((" ", ", ", "\n")).join(text).upper() if i % 2 else " ".join(text)))
    docs += [(200, None), (201, ""), (202, "ünder äpfel! Sind drei Vier fünf"), (203, docs[0][1]), (3, docs[6][1]), (None, docs[3][1]), (204, "q " * 200_000 + docs[9][1])]
    expected = {}
    for key, text in docs:
        best = expected.get(key, (0.0, None, 0))
        for number, item in items:
            if len(words(item)) >= 5:
                found = brute_tiles(words(item), words(text)[-400:], 5)
                cover = sum(s for _, _, s in found) / len(words(item))
                if found and (-cover, number) < (-best[0], best[1] if best[1] is not None else 10**9):
                    best = (cover, number, len(found))
        expected[key] = best
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS words", "3 AS item_id").repartition(4)
    got = contamination(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (round(r.coverage, 9), r.item_id, r.n_tiles) == (round(expected[r.doc_id][0], 9), *expected[r.doc_id][1:]), r
        assert r.contaminated == (r.coverage >= 0.5)
    assert sum(r.contaminated for r in got) > 20


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in contamination(docs, items).collect()] == [False]
    assert contamination(docs.limit(0), items).count() == 0
