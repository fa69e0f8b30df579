"""N-gram tables: long counts, per-document profiles, corpus totals, vocabularies.

The canonical table is long: ``(doc_id, kind, n, ngram, cnt, total, freq)``.  The n-grams
of a text take many times the bytes of the text, so the texts are placed by ``doc_id``
*before* they are tokenised and exploded: the grouping on
``(doc_id, kind, n, ngram)`` and every later grouping on ``doc_id`` then find their rows
already together, and only the text crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgrain.functions.ngrams import (
    FAMILIES,
    char_ngrams,
    family_name,
    feature_name,
    ngram_total,
    sequence_ngrams,
)
from textgrain.functions.text import composed, drop_stop_words, null_text, surface_tokens
from textgrain.operators.lookup import keyed_lookup
from textgrain.operators.ordering import PLACED_BYTES, by_document, sorted_positions

PROFILE_CELL = "array<struct<ngram:string,freq:double>>"
# Memory for the n-grams of a part while they are counted and ordered, the bytes that one takes
# there, and the n-grams of a byte of text: one of characters, fewer of words.
PART_MEMORY, NGRAM_BYTES, CHAR_RATE, SEQUENCE_RATE = 256 << 20, 100, 1.0, 1 / 6


def placed_bytes(families: Sequence[tuple[str, int]]) -> int:
    """Bytes of text in a part whose n-grams of ``families`` fit a task's memory and are not spilled."""
    rate = sum(CHAR_RATE if kind == "char" else SEQUENCE_RATE for kind, _ in families)
    return min(PLACED_BYTES, int(PART_MEMORY / (NGRAM_BYTES * rate)))


def processed_documents(
    docs: DataFrame, stops: list[str], lexicon: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``(doc_id, keep..., text, word, lemma, pos)``: kept words and their annotations.

    ``text`` is the kept words joined by a space; character n-grams are taken from it.
    Without a lexicon the lemma is the word itself and the part of speech is ``X``.
    """
    # Placed here, so that only the raw text is moved and all later work on a document,
    # from its tokens to its n-gram counts, happens where it lands.  The Python step comes
    # first because Spark forgets the placement of rows that went through Python.
    texts = docs.select("doc_id", *keep, composed(null_text("text", "nan")).alias("text"))
    placed = by_document(texts, size=F.octet_length("text"))
    # No token holds a blank, so runs of them need not be squeezed before.
    tokens = placed.select("doc_id", *keep, surface_tokens("text").alias("_tokens"))
    words = drop_stop_words(tokens, "_tokens", stops, "word").drop("_tokens")
    if lexicon is None:
        tagged = words.withColumn("lemma", F.col("word")).withColumn(
            "pos", F.transform("word", lambda w: F.lit("X"))
        )
    else:
        tagged = tag_words(words, lexicon, keep)
    return tagged.select("doc_id", *keep, F.array_join("word", " ").alias("text"), "word", "lemma", "pos")


def tag_words(words: DataFrame, lexicon: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Add ``lemma`` and ``pos`` arrays, in word order, from a ``(form, lemma, pos)`` lexicon.

    ``form`` must be unique in the lexicon.
    """
    # The outer explode keeps documents without words, and keeps Catalyst from testing
    # the array for emptiness by computing it a second time before the rows are placed.
    tokens = words.select("doc_id", *keep, F.posexplode_outer("word").alias("at", "form"))
    tagged = keyed_lookup(tokens, lexicon.select("form", "lemma", "pos"), "form", "doc_id", how="left")
    entry = F.struct(
        "at",
        "form",
        F.coalesce("lemma", "form").alias("lemma"),
        F.coalesce("pos", F.lit("X")).alias("pos"),
    )
    ordered = F.filter(F.array_sort(F.collect_list(entry)), lambda e: e["form"].isNotNull())
    return (
        tagged.groupBy("doc_id", *keep)
        .agg(ordered.alias("t"))
        .select("doc_id", *keep, F.col("t.form").alias("word"), F.col("t.lemma").alias("lemma"), F.col("t.pos").alias("pos"))
    )


def _grams_of(kind: str, n: int) -> tuple[Column, Column]:
    if kind == "char":
        return char_ngrams("text", n), ngram_total(F.char_length("text"), n)
    return sequence_ngrams(kind, n), ngram_total(F.size(kind), n)


def ngram_counts(
    processed: DataFrame,
    families: Sequence[tuple[str, int]] = FAMILIES,
    keep: Sequence[str] = (),
    relative: bool = True,
) -> DataFrame:
    """Long n-gram counts of every document for the given ``(kind, n)`` families.

    ``processed`` has ``doc_id``, ``text`` for character n-grams and an array column per
    sequence kind, and should be placed by ``doc_id`` (``processed_documents`` does that,
    a table read back needs ``by_document``).  ``total`` comes from the length
    of the text, not from a second aggregation.  ``keep`` names columns that are constant
    per document.
    """
    bags = []
    for kind, n in families:
        grams, total = _grams_of(kind, n)
        bags.append(
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(n).alias("n"),
                total.cast("long").alias("total"),
                grams.alias("grams"),
            )
        )
    # Own columns before the second explode: a struct that holds the whole array would be
    # copied into every exploded row.
    families_of = processed.select("doc_id", *keep, F.inline(F.array(*bags)))
    exploded = families_of.select("doc_id", *keep, "kind", "n", "total", F.explode("grams").alias("ngram"))
    counted = exploded.groupBy("doc_id", *keep, "kind", "n", "total", "ngram").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    freq = F.col("cnt") / F.col("total") if relative else F.col("cnt").cast("double")
    return counted.select("doc_id", *keep, "kind", "n", "ngram", "cnt", "total", freq.alias("freq"))


def ordered_cells(counts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One array per document and family: most frequent first, ties by n-gram.

    The rows of a document are its own n-grams, so an array is bounded by one text.
    """
    entry = F.struct((-F.col("cnt")).alias("rank"), "ngram", "freq")
    return (
        counts.groupBy("doc_id", *keep, "kind", "n")
        .agg(F.array_sort(F.collect_list(entry)).alias("sorted"))
        .withColumn(
            "cell", F.transform("sorted", lambda e: F.struct(e["ngram"].alias("ngram"), e["freq"].alias("freq")))
        )
        .drop("sorted")
    )


def ngram_profile(
    processed: DataFrame,
    families: Sequence[tuple[str, int]] = FAMILIES,
    keep: Sequence[str] = (),
    as_json: bool = False,
) -> DataFrame:
    """One row per document with an ordered n-gram array (or JSON text) per family."""
    cells = ordered_cells(ngram_counts(processed, families, keep), keep)
    empty = F.array().cast(PROFILE_CELL)
    wide = cells.groupBy("doc_id").agg(
        *[
            F.first(F.when((F.col("kind") == kind) & (F.col("n") == n), F.col("cell")), ignorenulls=True).alias(
                family_name(kind, n)
            )
            for kind, n in families
        ]
    )
    names = [family_name(kind, n) for kind, n in families]
    # Left join from the documents: a text too short for any n-gram keeps its row.
    profile = processed.select("doc_id", *keep, "text").join(wide, "doc_id", "left")
    filled = [F.coalesce(name, empty).alias(name) for name in names]
    if as_json:
        filled = [F.to_json(F.coalesce(name, empty)).alias(name) for name in names]
    return profile.select("doc_id", "text", *filled, *keep)


def cells_from_json(profile: DataFrame, names: Sequence[str]) -> DataFrame:
    """Decode JSON cells; null and empty cells become empty arrays."""
    empty = F.array().cast(PROFILE_CELL)
    decoded = {name: F.coalesce(F.from_json(name, PROFILE_CELL), empty) for name in names}
    return profile.withColumns(decoded)


def profile_features(profile: DataFrame, families: Sequence[tuple[str, int]], keep: Sequence[str] = ()) -> DataFrame:
    """Long ``(doc_id, keep..., feature, freq)`` rows of a decoded profile."""

    def named(kind: str, n: int) -> Column:
        def entry(e: Column) -> Column:
            return F.struct(
                feature_name(F.lit(kind), F.lit(n), e["ngram"]).alias("feature"), e["freq"].alias("freq")
            )

        return F.transform(family_name(kind, n), entry)

    tagged = [named(kind, n) for kind, n in families]
    return profile.select("doc_id", *keep, F.explode(F.concat(*tagged)).alias("e")).select(
        "doc_id", *keep, "e.feature", "e.freq"
    )


def corpus_totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences and document frequency of every n-gram."""
    return counts.groupBy(*by, "kind", "n", "ngram").agg(
        F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("docs")
    )


def top_ngrams(counts: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` n-grams with the highest mean relative frequency in each ``by`` group."""
    sums = counts.groupBy(by, "ngram").agg(
        F.sum("cnt").alias("cnt"),
        F.count(F.lit(1)).alias("docs"),
        # Rounded, so that the order of summation cannot decide a tie.
        F.round(F.sum("freq"), 9).alias("weight"),
    )
    # Catalyst limits every partition to its own first k before the rows of a group meet.
    place = Window.partitionBy(by).orderBy(F.desc("weight"), F.asc("ngram"))
    return sums.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def vocabulary(counts: DataFrame) -> DataFrame:
    """Sorted distinct feature names of the given (training) rows with a 0-based index."""
    names = counts.select(feature_name(F.col("kind"), F.col("n"), F.col("ngram")).alias("feature")).distinct()
    placed = sorted_positions(names, F.col("feature"), name="index")
    return placed.withColumn("index", F.col("index") - 1)


def known_features(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Long rows with a vocabulary index; features not seen in the fit are dropped."""
    named = counts.withColumn("feature", feature_name(F.col("kind"), F.col("n"), F.col("ngram")))
    return keyed_lookup(named, vocab, "feature", "doc_id", how="inner")
