"""N-gram extraction and the representation registry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The n-gram kinds and orders of the profile.
CHAR_ORDERS = (2, 3, 4)
SEQUENCE_ORDERS = (1, 2, 3, 4)
SEQUENCE_KINDS = ("word", "lemma", "pos")
FAMILIES = tuple(("char", n) for n in CHAR_ORDERS) + tuple(
    (kind, n) for kind in SEQUENCE_KINDS for n in SEQUENCE_ORDERS
)


def family_name(kind: str, n: int) -> str:
    return f"{kind}_{n}grams"


def char_ngrams(text: Column | str, n: int) -> Column:
    """All overlapping runs of ``n`` code points, blanks included.

    Each match consumes one code point and captures ``n`` by look-ahead: one linear pass,
    surrogate pairs stay whole, and texts shorter than ``n`` give an empty array.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def sequence_ngrams(items: Column | str, n: int) -> Column:
    """All overlapping runs of ``n`` items joined by a space."""
    items = F.col(items) if isinstance(items, str) else items
    if n == 1:
        return items
    windows = F.transform(
        F.sequence(F.lit(1), F.size(items) - (n - 1)),
        lambda i: F.array_join(F.slice(items, i, n), " "),
    )
    return F.when(F.size(items) >= n, windows).otherwise(F.array().cast("array<string>"))


def ngram_total(size: Column, n: int) -> Column:
    """How many n-grams a sequence of ``size`` items has."""
    return F.greatest(size - (n - 1), F.lit(0))


def feature_name(kind: Column, n: Column, ngram: Column) -> Column:
    """``word_1grams::casa``"""
    return F.concat(kind, F.lit("_"), n.cast("string"), F.lit("grams::"), ngram)


def representations() -> dict[str, list[tuple[str, int]]]:
    """The named column sets that are compared: each family alone, each kind, and all."""
    named: dict[str, list[tuple[str, int]]] = {}
    for kind, orders in [("char", CHAR_ORDERS)] + [(k, SEQUENCE_ORDERS) for k in SEQUENCE_KINDS]:
        for n in orders:
            named[family_name(kind, n)] = [(kind, n)]
        joined = "_".join(str(n) for n in orders)
        named[f"{kind}_{joined}grams"] = [(kind, n) for n in orders]
    named["all_ngrams"] = list(FAMILIES)
    return named
