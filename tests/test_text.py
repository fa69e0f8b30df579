import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textgrain.functions import ngrams as ng
from textgrain.functions import text as tx

SAMPLES = [
    "Perché è così?  Sì. Vero!\tL’acqua dell'isola 1_2 €5",
    "é café\u001c\u001dfine",
    "",
    " \n ",
    "ab",
    "😀🎉a 😀",
    "한글 한 Å ̈́ Ω",
    "Dr. Rossi.Ciao!  Come va?\n\nBene. ",
    "1a__b ²Ⅻ x" + "y" * 20,
    None,
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def values(df, column):
    return [r["v"] for r in df.select("doc_id", column.alias("v")).orderBy("doc_id").collect()]


NORMALIZED = [
    "Perché è così? Sì. Vero! L’acqua dell'isola 1_2 €5",
    "é café fine",
    "",
    "",
    "ab",
    "😀🎉a 😀",
    "한글 한 Å ̈́ Ω",
    "Dr. Rossi.Ciao! Come va? Bene.",
    "1a__b ²Ⅻ x" + "y" * 20,
    "nan",
]


def test_normalized(spark):
    assert values(frame(spark, SAMPLES), tx.normalized("text")) == NORMALIZED


def test_every_code_point_outside_the_suspect_class_is_composed(spark):
    def suspect(c):
        return unicodedata.normalize("NFC", chr(c)) != chr(c) or unicodedata.combining(chr(c))

    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and suspect(c)]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "doc_id long, text string")
    assert df.filter(~(F.col("text").rlike(tx.OUTSIDE_PLAIN) & F.col("text").rlike(tx.MAYBE_UNCOMPOSED))).count() == 0


def test_only_one_plain_range_is_searched_before_composing(spark):
    """A class of many ranges took 18 of the 30 seconds that the words of 173 MB took."""
    texts = ["e\u0301", "\u1e69", "s\u0323\u0307", "\u212b", "é ß", "日本", None]
    df = frame(spark, texts)
    assert values(df, tx.composed("text")) == [t and unicodedata.normalize("NFC", t) for t in texts]
    plan = df.select(tx.composed("text"))._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan and "x{2010}" not in plan


def test_null_policies(spark):
    df = frame(spark, [None])
    assert values(df, tx.null_text("text", "nan")) == ["nan"]
    assert values(df, tx.null_text("text", "empty")) == [""]
    assert values(df, tx.null_text("text")) == [None]


def test_word_runs(spark):
    texts = ["Perché è 1_2 €5", "l’acqua dell'isola", "", " \n ", "😀a😀 B", "한글 x²"]
    expected = [["perché", "è", "1_2", "5"], ["l", "acqua", "dell", "isola"], [], [], ["a", "b"], ["한글", "x²"]]
    assert values(frame(spark, texts), tx.word_runs("text")) == expected


def test_alpha_words(spark):
    texts = ["Perché è 1_2 €5", "1a__b ²Ⅻ x" + "y" * 20, "ab c de_f _gh", "", "L’Acqua x" + "y" * 14]
    expected = [["perché"], ["a__b", "²ⅻ"], ["ab", "de_f"], [], ["acqua", "x" + "y" * 14]]
    assert values(frame(spark, texts), tx.alpha_words("text")) == expected


def test_sentences(spark):
    texts = ["Dr. Rossi.Ciao!  Come va?\n\nBene. ", "no end", "", " \n ", "One.\u001cTwo! ?", None]
    expected = ["Dr.\nRossi.Ciao!\nCome va?\nBene.", "no end", "", "", "One.\nTwo!\n?", ""]
    assert values(frame(spark, texts), tx.one_sentence_per_line("text")) == expected


def test_stop_words_ignore_case_and_apostrophe(spark):
    df = frame(spark, ["Dell' acqua E la L’ onda"]).select("doc_id", tx.surface_tokens("text").alias("t"))
    kept = tx.drop_stop_words(df, "t", ["dell", "l", "e", "la"], "kept")
    assert kept.first()["kept"] == ["acqua", "onda"]


def test_truncate_pad(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, []), (2, [1, 2, 3, 4, 5, 6])], "doc_id long, ids array<int>")
    ids, mask = tx.truncate_pad("ids", 4)
    assert values(df, ids) == [[1, 2, 3, 0], [0, 0, 0, 0], [1, 2, 3, 4]]
    assert values(df, mask) == [[1, 1, 1, 0], [0, 0, 0, 0], [1, 1, 1, 1]]


def test_document_key(spark):
    assert values(frame(spark, ["x"]), tx.document_key(F.lit("train"), F.lit(7))) == ["train_00007"]


def test_ngrams(spark):
    df = frame(spark, ["abè😀", "a", "", "a b"])
    assert values(df, ng.char_ngrams("text", 2)) == [["ab", "bè", "è😀"], [], [], ["a ", " b"]]
    assert values(df, ng.char_ngrams("text", 4)) == [["abè😀"], [], [], []]
    items = spark.createDataFrame([(0, ["x", "y", "z", "x"]), (1, ["x"]), (2, [])], "doc_id long, w array<string>")
    assert values(items, ng.sequence_ngrams("w", 1)) == [["x", "y", "z", "x"], ["x"], []]
    assert values(items, ng.sequence_ngrams("w", 3)) == [["x y z", "y z x"], [], []]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab è😀\n.", max_size=12), min_size=10, max_size=30))
def test_char_ngrams_rebuild_the_text(spark, texts):
    df = frame(spark, texts)
    for n in ng.CHAR_ORDERS:
        for text, grams in zip(texts, values(df, ng.char_ngrams("text", n))):
            if len(text) < n:
                assert grams == []
            else:
                assert all(len(g) == n for g in grams)
                assert grams[0] + "".join(g[-1] for g in grams[1:]) == text


def test_representations():
    named = ng.representations()
    assert len(named) == 20
    assert named["char_2_3_4grams"] == [("char", 2), ("char", 3), ("char", 4)]
    assert named["pos_1_2_3_4grams"] == [("pos", n) for n in (1, 2, 3, 4)]
    assert len(named["all_ngrams"]) == 15


def test_row_wise_functions_run_on_a_stream(spark, tmp_path):
    frame(spark, SAMPLES[:2]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id long, text string").parquet(str(tmp_path / "in"))
    rows = stream.select("doc_id", F.size(ng.char_ngrams(tx.normalized("text"), 3)).alias("n"))
    query = rows.writeStream.format("memory").queryName("grams").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("grams").count() == 2
