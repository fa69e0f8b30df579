import random

import public_tokenizers
import sentencepiece

from textgrain.llm.piece_encoding import BLANK_MARK, Encoder, Lattice, Pieces, decode, decode_ids, encode_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
LETTERS = list("abcdefghiklmnorstuy") * 2 + list(" " * 8 + "\t\n▁\x00\x01éßñ̀中😀<s>\x7f\r") + ["the", "ing", " of", "    ", "http://", "   \n", "0x"]


def texts(count, longest, seed):
    source = random.Random(seed)
    return ["".join(source.choice(LETTERS) for _ in range(source.randint(0, longest))) for _ in range(count)]


def test_ids_equal_the_library(spark):
    rows = texts(1500, 60, 1) + ["", None, " ", "  x", "x  ", "ab" * 60_000, " " * 2000, "same", "same", "x" * 41 + " y"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS ids").repartition(3)
    encoded = encode_texts(docs, PATH)
    got = {r.doc_id: r for r in decode_ids(encoded, PATH, output="decoded").collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        expected = LIBRARY.encode(text or "")
        assert list(got[i].ids) == expected and got[i].n_tokens == len(expected) and got[i].n_bytes == len((text or "").encode())
        assert got[i].decoded == LIBRARY.decode(expected)
        if BLANK_MARK not in (text or ""):
            assert got[i].decoded == (text or "")


def test_stream_gives_final_ids_early():
    pieces = Pieces(PATH)
    for text in texts(60, 900, 2):
        marked = BLANK_MARK + text.replace(" ", BLANK_MARK)
        lattice, ids, kept = Lattice(pieces), [], 0
        for start in range(0, len(marked), 23):
            ids += lattice.feed(marked[start : start + 23])
            kept = max(kept, len(lattice.text))
        ids += lattice.close()
        assert ids == (LIBRARY.encode(text) if text else [pieces.ids[BLANK_MARK]])
        assert kept <= 12 * pieces.longest


def test_pair_rule_equals_merging():
    pieces, source = Pieces(PATH), random.Random(3)
    names = [n for n in sorted(pieces.ids) if BLANK_MARK * 2 not in n and n != BLANK_MARK]
    short = [n for n in names if len(n) < 4]
    for _ in range(20_000):
        left, right = source.choice(short if source.random() < 0.5 else names), source.choice(short if source.random() < 0.5 else names)
        assert pieces.may_follow(left, right) == (pieces.merged(left + right) == [left, right])


def test_runs_of_blanks_before_words():
    pieces, source = Pieces(PATH), random.Random(6)
    assert pieces.blank_run == 16
    encoder = Encoder(pieces)
    ends = ["", "the", "中", "😀x", "\x00", "of" * 40, "zq" * 30]
    rows = [" " * n + end for n in range(0, 120) for end in ends]
    rows += ["a" + " " * source.randint(30, 90) + source.choice(ends) + " " * source.randint(0, 60) for _ in range(300)]
    assert encoder.encode(rows) == [LIBRARY.encode(t) for t in rows]


def test_a_million_blanks_and_letters():
    """Quadratic steps would take hours."""
    encoder = Encoder(Pieces(PATH))
    for text in (" " * 1_000_000, "x" + " " * 1_000_000 + "y", "  " + "ab" * 500_000, "\n" + " " * 999_999 + "中"):
        assert encoder.encode([text])[0] == LIBRARY.encode(text)


def test_merging_by_heap_equals_merging():
    pieces, source = Pieces(PATH), random.Random(7)
    for text in texts(400, 300, 8) + ["▁" * n for n in range(41, 130)]:
        parts, steps = pieces.merged_by_heap(text), []
        assert parts == pieces.merged(text, steps) and "".join(parts) == text


def test_remembered_words_change_nothing():
    encoder = Encoder(Pieces(PATH))
    rows = texts(200, 50, 4)
    assert encoder.encode(rows) == encoder.encode(rows) == [LIBRARY.encode(t) for t in rows]
    assert decode(encoder.pieces, []) == ""


def test_empty_table(spark):
    assert decode_ids(encode_texts(spark.createDataFrame([], "doc_id long, text string"), PATH), PATH).count() == 0
