"""Text normalisation, tokenisation and sentence splitting.

Everything is a Column expression that runs inside the JVM.  The one exception is the
canonical composition of Unicode text, for which Spark has no built-in; only texts that
may actually need it are handed to Python.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textgrain.functions.stop_words import words_of

# Patterns that define what a token, a blank and a sentence end are.
BLANKS = r"(?U)[\s\x{1c}-\x{1f}]+"
EDGE_BLANKS = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
WORD_RUN = r"[\p{L}\p{N}_]+"
ALPHA_RUN = r"[\p{L}\p{Nl}\p{No}_]+"
# Possessive: no shorter run of letters is followed by an apostrophe.
SURFACE_TOKEN = r"\p{L}++['’]|[\p{L}\p{N}_]++|\p{S}"
SENTENCE_GAP = r"(?<=[.!?])(?U:[\s\x{1c}-\x{1f}]+)"
ALPHA_MIN_LENGTH = 2
ALPHA_MAX_LENGTH = 15

# Fixed value: no text of characters below U+0300 alone changes when it is composed.  One plain
# range on purpose: a class of many ranges takes most of the time of a whole n-gram query.
OUTSIDE_PLAIN = r"[^\x{0}-\x{2ff}]"
MAYBE_UNCOMPOSED = OUTSIDE_PLAIN

NULL_POLICIES = ("nan", "empty", "keep")


@F.pandas_udf(StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def null_text(text: Column | str, policy: str = "keep") -> Column:
    """Null texts: the literal ``nan``, an empty text, or left null for the caller to drop."""
    if policy not in NULL_POLICIES:
        raise ValueError(f"null policy must be one of {NULL_POLICIES}, not {policy!r}")
    text = _col(text)
    if policy == "keep":
        return text
    return F.coalesce(text, F.lit("nan" if policy == "nan" else ""))


def composed(text: Column | str) -> Column:
    """Canonically composed text; rows that cannot change never leave the JVM."""
    text = _col(text)
    suspect = F.when(text.rlike(OUTSIDE_PLAIN), text)
    return F.coalesce(_compose(suspect), text)


def squeeze_blanks(text: Column | str) -> Column:
    """Every run of white space becomes one space, none at either end."""
    return F.regexp_replace(F.regexp_replace(_col(text), EDGE_BLANKS, ""), BLANKS, " ")


def normalized(text: Column | str, null_policy: str = "nan") -> Column:
    """Composed, blank-squeezed text with its letter case kept."""
    return squeeze_blanks(composed(null_text(text, null_policy)))


def newlines_to_spaces(text: Column | str) -> Column:
    return F.translate(_col(text), "\n", " ")


def word_runs(text: Column | str) -> Column:
    """Lower-cased maximal runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_RUN), F.lit(0))


def alpha_words(text: Column | str) -> Column:
    """Lower-cased alphabetic words of moderate length, accents kept."""
    runs = F.regexp_extract_all(F.lower(_col(text)), F.lit(ALPHA_RUN), F.lit(0))
    return F.filter(
        runs,
        lambda w: F.char_length(w).between(ALPHA_MIN_LENGTH, ALPHA_MAX_LENGTH)
        & ~w.startswith("_"),
    )


def surface_tokens(text: Column | str) -> Column:
    """Words, elided words with their apostrophe, and symbols, in original case."""
    return F.regexp_extract_all(_col(text), F.lit(SURFACE_TOKEN), F.lit(0))


def stop_words(languages: Iterable[str] = ("italian",)) -> list[str]:
    """The package's own stop lists; ``drop_stop_words`` takes any other list as well."""
    return words_of(tuple(languages))


def drop_stop_words(df: DataFrame, tokens: str, stops: Sequence[str], output: str) -> DataFrame:
    """Add ``output``: the tokens whose lower-cased form is no stop word.

    An elided word (``dell'``) is looked up without its apostrophe.
    """
    forms = [w + end for w in stops for end in ("", "'", "’")]
    remover = StopWordsRemover(
        inputCol=tokens, outputCol=output, stopWords=forms, caseSensitive=False, locale="en_US"
    )
    return remover.transform(df)


def sentences(text: Column | str) -> Column:
    """Trimmed non-blank sentences; a null text has none."""
    parts = F.split(F.coalesce(_col(text), F.lit("")), SENTENCE_GAP)
    trimmed = F.transform(parts, lambda s: F.regexp_replace(s, EDGE_BLANKS, ""))
    return F.filter(trimmed, lambda s: s != "")


def one_sentence_per_line(text: Column | str) -> Column:
    return F.array_join(sentences(text), "\n")


def document_key(split: Column | str, number: Column | str) -> Column:
    """``train_00007``"""
    return F.format_string("%s_%05d", _col(split), _col(number))


def truncate_pad(ids: Column | str, length: int, pad: int = 0) -> tuple[Column, Column]:
    """First ``length`` ids padded to that length, and the 0/1 mask of real positions."""
    kept = F.slice(_col(ids), 1, length)
    missing = F.lit(length) - F.size(kept)
    mask = F.concat(
        F.array_repeat(F.lit(1), F.size(kept)),
        F.array_repeat(F.lit(0), missing),
    )
    return F.concat(kept, F.array_repeat(F.lit(pad), missing)), mask
