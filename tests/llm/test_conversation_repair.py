import hashlib
import itertools
import random
import re
import zlib

import pytest

from textgrain.llm.conversation_repair import CUT, FINE, MUST_GO, cheapest, damaged, repair_digests, repair_plans, repaired_turns

GOAL = re.compile(r"(s?(ua)+)?")


def by_enumeration(symbols):
    """All edits of all rows, with up to two turns inserted in every gap."""
    rows = []
    for symbol in symbols:
        initial, fault = "sua?"[symbol % 4], symbol // 4
        options = [("D", 2, "")]
        if fault != MUST_GO:
            more = 5 if fault == CUT else 0
            options += [("K", more, initial), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        rows.append(options)
    gap = [("I" * k, 5 * k, "".join(p)) for k in range(3) for p in itertools.product("ua", repeat=k)]
    best = None
    for plan in itertools.product(gap, *itertools.chain.from_iterable((r, gap) for r in rows)):
        if GOAL.fullmatch("".join(p[2] for p in plan)):
            found = (sum(p[1] for p in plan), "".join(p[0] for p in plan))
            best = found if best is None else min(best, found)
    return best


def by_prefixes(symbols):
    """Cheapest and ASCII-least prefix of edits per state, with whole strings."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def closed(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                for x in "ua":
                    if (state, x) in moves:
                        new = (cost + 5, audit + "I")
                        after = moves[state, x]
                        states[after] = min(states.get(after, new), new)
        return states

    states = closed({"": (0, "")})
    for symbol in symbols:
        initial, fault, new = "sua?"[symbol % 4], symbol // 4, {}
        for state, (cost, audit) in states.items():
            options = [("D", 2, state)]
            if fault != MUST_GO:
                more = 5 if fault == CUT else 0
                options += [("K", more, moves[state, initial])] if (state, initial) in moves else []
                options += [("R", 1 + more, moves[state, x]) for x in "ua" if (state, x) in moves]
            for letter, more, after in options:
                found = (cost + more, audit + letter)
                new[after] = min(new.get(after, found), found)
        states = closed(new)
    return min(states[s] for s in ("", "a") if s in states)


def test_search_equals_enumeration():
    for n in range(3):
        for symbols in itertools.product(range(12), repeat=n):
            assert cheapest(bytes(symbols)) == by_enumeration(symbols) == by_prefixes(symbols)
    source = random.Random(0)
    for _ in range(12):
        symbols = [source.randrange(12) for _ in range(3)]
        assert cheapest(bytes(symbols)) == by_enumeration(symbols)


@pytest.mark.parametrize("weights", [(1, 1, 1), (8, 1, 1), (1, 0, 6), (9, 1, 0)])
def test_search_equals_prefixes(weights):
    source = random.Random(str(weights))
    for _ in range(400):
        faults = source.choices((FINE, MUST_GO, CUT), weights, k=source.randint(0, 60))
        symbols = bytes(source.randrange(4) + 4 * f for f in faults)
        assert cheapest(symbols) == by_prefixes(symbols)


def test_long_conversations():
    cost, audit = cheapest(bytes([0, 0]) * 50_000 + bytes([1, 2]) * 50_000)
    assert len(audit) >= 200_000 and cost > 0
    assert cheapest(bytes([3 + 4 * MUST_GO]) * 100_000) == (200_000, "D" * 100_000)


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        code = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def brute(rows, ids):
    found = []
    for conv in ids:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        counts, seen, symbols = [0, 0, 0], set(), []
        for _, _, role, text in own:
            kept = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = 0 if not kept else 1 if (role, text) in seen else 2 if kept[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            at = "sua".find(role[:1]) if role else -1
            symbols.append((at if at >= 0 else 3) + 4 * {None: FINE, 0: MUST_GO, 1: MUST_GO, 2: CUT}[fault])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = by_prefixes(symbols)
        lines, left = [], list(own)
        for letter in audit:
            due = "assistant" if lines and lines[-1][0][0] == "u" else "user"
            if letter == "I":
                lines.append((due, ""))
                continue
            _, _, role, text = left.pop(0)
            if letter != "D":
                lines.append((due if letter == "R" else role, text))
        assert not left and GOAL.fullmatch("".join(role[0] for role, _ in lines))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=repr)


def sample(seed):
    source = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "agent", "", None]
    texts = ["Yes.", "no", "What?", " \t", "", "é!\n", "done. ", "x. ", None, "long " * 30]
    rows = []
    for conv in range(60):
        for turn in range(source.randint(1, 14)):
            rows.append((conv, source.choice((turn, turn, turn + 3, None)), source.choice(roles), source.choice(texts)))
    rows += [(None, k, "user", "hello.") for k in range(3)] + [(99, 5, "user", "a." * 300_000), (99, 6, "assistant", "ok.")]
    return rows


def test_rows_equal_brute_force(spark):
    rows = sample(2)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.selectExpr("*", "1 AS conv", "2 AS digest", "3 AS kind", "4 AS cost", "5 AS audit").repartition(5)
    harm = damaged(table)
    assert sorted(map(tuple, harm.collect()), key=repr) == sorted(harmed(rows), key=repr)
    got = sorted((tuple(r) for r in repair_digests(harm, table).collect()), key=repr)
    assert got == brute(harmed(rows), {r[0] for r in rows})


def test_repaired_turns_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "There."), (2, 0, "user", " ")]
    table = spark.createDataFrame(rows, schema)
    got = sorted((r.conv_id, r.position, r.edit, r.role, r.text) for r in repaired_turns(table, repair_plans(table)).collect())
    assert got == [(1, 1, "R", "user", "Hi."), (1, 2, "K", "assistant", "There.")]
    none = spark.createDataFrame([], schema)
    assert repair_digests(none, none).count() == 0
    lost = repair_digests(none, table).collect()
    assert {tuple(r)[1:] for r in lost} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
