import hashlib
import random

from textgrain.llm.chat_windows import MARK_TOKENS, chat_windows, escape, read_windows, turns_of, unescape

FIELDS = "conv_id long, turn long, role string, text string"


def conversations():
    source = random.Random(5)
    rows = []
    for conv in range(40):
        for turn in range(source.choice((1, 2, 5, 30))):
            role = "system" if turn == 0 and conv % 3 == 0 else source.choice(("user", "assistant"))
            text = " ".join(source.choice(("a", "<turn x>", "</turn>\n", "\\", "wörd", "\n")) for _ in range(source.randint(0, 12)))
            rows.append((conv, turn, role, text))
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t} " * (300 if t == 40 else 3)) for t in range(400)]
    rows += [(None, 0, "user", "null conversation"), (60, None, None, None), (60, 1, "assistant", "x\\"), (60, 1, "assistant", "x\\"), (61, 0, "system", "s " * 500), (61, 1, "assistant", "t")]
    return rows


def brute(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        found[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def test_escape_is_reversible():
    for text in ("", "\\", "<turn user>", "a\\<b>\\\\", "</turn>\n"):
        assert unescape(escape(text)) == text and "</turn>" not in escape(text)


def test_read_back_equals_brute_force(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, FIELDS).selectExpr("*", "1 AS conv", "2 AS position", "3 AS system").repartition(5)
    windows = chat_windows(turns, budget=64).cache()
    got = {r.conv_id: tuple(r)[1:5] for r in read_windows(windows).collect()}
    assert got == brute(rows)
    for w in windows.collect():
        read = list(turns_of(w.text))
        assert w.over_budget == (w.n_tokens > 64)
        if w.over_budget:  # only where one turn or the system turn alone is large
            assert len(read) - w.n_repeated == 1 or w.conv_id == 61
        starts_with_system = brute_system(rows, w.conv_id)
        if starts_with_system is not None and w.first_position > 1:
            assert read[0] == ("system", starts_with_system) and w.n_repeated >= 1
        targets = [x for r, x in read[w.n_repeated:] if r == "assistant"]
        assert [unescape(w.text[s.start:s.end]) for s in w.loss_spans] == targets
    assert any(w.n_repeated > 1 for w in windows.collect())
    windows.unpersist()


def brute_system(rows, conv):
    turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
    return turns[0][3] if turns[0][2] == "system" else None


def test_history_is_the_longest_that_fits(spark):
    rows = [(1, t, "user", "w " * 6) for t in range(30)]
    size = 6 + MARK_TOKENS
    windows = chat_windows(spark.createDataFrame(rows, FIELDS), budget=160).collect()
    for w in windows:
        expected = min(20 // size, w.first_position - 1)
        assert w.n_repeated == expected and w.n_tokens <= 160


def test_empty(spark):
    assert read_windows(chat_windows(spark.createDataFrame([], FIELDS))).count() == 0
