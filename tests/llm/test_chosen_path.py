import random
import re

import pytest

from textgrain.llm import chosen_path
from textgrain.llm.chosen_path import near_components
from textgrain.llm.components import components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((key, len(sets[i]), least.get(root(i))) for i, (key, _) in enumerate(rows)), key=repr)


def corpus(seed, groups):
    source = random.Random(seed)
    bag = [f"W{k}" for k in range(400)] + ["of", "The", "and"] * 40
    texts = []
    for copies, edits in groups:
        base = [source.choice(bag) for _ in range(source.randint(8, 90))]
        for _ in range(copies):
            text = list(base)
            for _ in range(source.randint(0, edits)):
                text[source.randrange(len(text))] = source.choice(bag)
            texts.append(source.choice((" ", "\n", "\t ")).join(text))
    texts += [None, "", " \t\n", "one", "ONE", "one two", "x y", "x y", "É a", "é a"]
    source.shuffle(texts)
    return [(i + 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    rows = corpus(size, [(1, 0)] * 120 + [(2, 2)] * 40 + [(6, 6)] * 12 + [(60, 10)] * 2)
    rows += [rows[0], (None, rows[1][1]), (None, "alone here"), (2, "word " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS name", "3 AS n").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_components(docs, size=size).collect()), key=repr)
    assert got == brute(rows, size)


def test_large_groups_branch_and_are_dealt_in_blocks(spark, monkeypatch):
    """With tiny nodes the trees must go deep: nothing false is linked, nearly all is found."""
    monkeypatch.setattr(chosen_path, "NODE_LIMIT", 12)
    rows = corpus(9, [(90, 8), (70, 2), (1, 0), (5, 3)])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_components(docs, size=2).collect()), key=repr)
    expected = brute(rows, 2)
    whole = {key: component for key, _, component in expected}
    assert all(whole[key] == whole[component] for key, _, component in got)
    assert sum(a == b for a, b in zip(got, expected)) >= 0.97 * len(rows)


def test_components(spark):
    source = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(source.randint(0, 60), source.randint(0, 60)) for _ in range(30)] + [(500, k) for k in range(501, 520)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for link in links for x in link}
    for _ in range(200):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {n: r for n, r in parent.items() if n != r}


def test_empty_table(spark):
    assert near_components(spark.createDataFrame([], "doc_id long, text string"), size=2).count() == 0


@pytest.mark.parametrize("limit", [chosen_path.NODE_LIMIT, 16])
def test_a_large_node_equals_brute_force(spark, monkeypatch, limit):
    """A family around one template: hardly anyone is linked with it, but many have a partner."""
    monkeypatch.setattr(chosen_path, "NODE_LIMIT", limit)
    source = random.Random(4)
    template = [f"t{k}" for k in range(100)]

    def changed(words, count, mark):
        words = list(words)
        for k, at in enumerate(source.sample(range(0, 100, 3), count)):
            words[at] = f"{mark}x{k}"
        return words

    rows = [(0, " ".join(template))]
    for k in range(350):
        one = changed(template, source.choice((6, 7, 8)), f"a{k}")
        two = changed(one, source.choice((3, 4, 5)), f"b{k}")
        rows += [(len(rows), " ".join(one)), (len(rows) + 1, " ".join(two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_components(docs, size=2).collect()), key=repr)
    expected = brute(rows, 2)
    assert len({component for _, _, component in expected}) > 100
    assert got == expected


def test_pairs_at_a_lower_threshold(spark):
    """Pairs of similarity 48 / 78 = 0.615 are candidates at 60 percent."""
    rows = []
    for k in range(60):
        words = [f"w{k}x{j}" for j in range(63)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:48], *(f"v{k}x{j}" for j in range(15))]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_components(docs, size=1, percent=60).collect()}
    assert sum(got[2 * k + 1] == 2 * k for k in range(60)) >= 55


def test_deeper_levels_take_more_trees():
    """The chance to meet is an average over what the sketches of a pair at the threshold share."""
    assert [chosen_path.tree_count(80, level) for level in (2, 6, 10, 14)] == [12, 12, 21, 39]


def test_texts_are_read_for_new_candidates_only(spark, monkeypatch):
    """Later trees find the same pairs again: neither their texts nor their sets are built twice."""
    calls, build = [], chosen_path.full_sets
    monkeypatch.setattr(chosen_path, "full_sets", lambda *args: calls.append(1) or build(*args))
    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join([*words[:53], *(f"v{k}" for k in range(7))])), (4, "quite another")]
    got = sorted((r.doc_id, r.component_id) for r in near_components(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert len(calls) == 1


def test_blocks_hold_every_member_once_and_the_least_always(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "NODE_LIMIT", 5)
    members = spark.createDataFrame([(path, name, name, 10, 0) for path in (7, 8) for name in range(10)], "path long, name long, component long, n long, least long")
    found = [(r.path, r.name) for r in chosen_path.blocks_with_pivot(members, 0).collect()]
    names = [name for _, name in found]
    assert all(names.count(name) == 2 for name in range(1, 10))
    assert {path for path, name in found if name == 0} >= {path for path, name in found if name}
