"""Shared settings of the registered queries and SQL pieces of their oracles."""

from __future__ import annotations

from textgrain.functions.stop_words import words_of

# Stop lists applied by the registered queries.
LANGUAGES = ("english", "french", "german", "italian", "spanish")

CORPUS = """
corpus AS (
  SELECT d.doc_id, d.text, l.quality AS label,
         CASE WHEN d.doc_id % 4 < 2 THEN 'train' WHEN d.doc_id % 4 = 2 THEN 'validation' ELSE 'test' END AS split
  FROM documents d JOIN labels l USING (doc_id))"""

NORMAL = r"trim(regexp_replace(nfc_normalize(text), '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g'))"
WORD_RUNS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
ALPHA_WORDS = (
    r"list_filter(regexp_extract_all(lower(text), '[\p{L}\p{Nl}\p{No}_]+'), "
    r"lambda w: length(w) BETWEEN 2 AND 15 AND w[1] <> '_')"
)
SENTENCES = (
    r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', "
    r"'\1' || chr(1), 'g'), chr(1)), "
    r"lambda s: regexp_replace(s, '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g')), lambda s: s <> '')"
)


def stop_list_sql() -> str:
    return ", ".join(f"('{word}')" for word in words_of(LANGUAGES))


def words_cte(source: str = "documents", keep: str = "") -> str:
    """``words(doc_id, keep, word, text)``: kept surface tokens and their joined text."""
    keep = f", {keep}" if keep else ""
    return f"""
stops(w) AS (VALUES {stop_list_sql()}),
raw_tokens AS (
  SELECT doc_id, unnest(toks) AS form, unnest(range(1, len(toks) + 1)) AS slot
  FROM (SELECT doc_id, regexp_extract_all({NORMAL}, '\\p{{L}}+[''’]|[\\p{{L}}\\p{{N}}_]+|\\p{{S}}') AS toks FROM {source})),
kept AS (
  SELECT doc_id, form, slot FROM raw_tokens
  WHERE rtrim(lower(form), '''’') NOT IN (SELECT w FROM stops)),
grouped AS (SELECT doc_id, list(form ORDER BY slot) AS word FROM kept GROUP BY doc_id),
words AS (
  SELECT d.doc_id{keep}, coalesce(g.word, []) AS word, coalesce(array_to_string(g.word, ' '), '') AS text
  FROM {source} d LEFT JOIN grouped g USING (doc_id))"""


def char_ngrams_cte(n: int, keep: str = "", source: str = "words") -> str:
    """``char{n}(doc_id, kind, n, ngram, cnt, total)`` from the joined text."""
    keep = f", {keep}" if keep else ""
    shifted = ", ".join(f"unnest(ch[{i + 1}:]) AS c{i}" for i in range(n))
    glued = " || ".join(f"c{i}" for i in range(n))
    return f"""
char{n} AS (
  SELECT doc_id{keep}, 'char' AS kind, {n} AS n, {glued} AS ngram, count(*) AS cnt, any_value(total) AS total
  FROM (SELECT doc_id{keep}, {shifted}, greatest(len(ch) - {n - 1}, 0) AS total
        FROM (SELECT doc_id{keep}, regexp_extract_all(text, '(?s).') AS ch FROM {source}))
  WHERE c{n - 1} IS NOT NULL
  GROUP BY ALL_KEYS)""".replace("GROUP BY ALL_KEYS", f"GROUP BY doc_id{keep}, ngram")


def sequence_ngrams_cte(kind: str, n: int, keep: str = "", source: str = "words") -> str:
    """``{kind}{n}(doc_id, kind, n, ngram, cnt, total)`` from an array column."""
    keep = f", {keep}" if keep else ""
    shifted = ", ".join(f"unnest({kind}[{i + 1}:]) AS c{i}" for i in range(n))
    glued = " || ' ' || ".join(f"c{i}" for i in range(n))
    return f"""
{kind}{n} AS (
  SELECT doc_id{keep}, '{kind}' AS kind, {n} AS n, {glued} AS ngram, count(*) AS cnt, any_value(total) AS total
  FROM (SELECT doc_id{keep}, {shifted}, greatest(len({kind}) - {n - 1}, 0) AS total FROM {source})
  WHERE c{n - 1} IS NOT NULL
  GROUP BY doc_id{keep}, ngram)"""


def sql(*ctes: str, final: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",".join(ctes) + "\n" + final
