"""Subsets, text functions and n-gram tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrain.functions import ngrams as ng
from textgrain.functions import text as tx
from textgrain.operators import ngram_tables as nt
from textgrain.operators import subset, suffixes
from textgrain.operators.ordering import by_document
from textgrain.plans.fragments import (
    ALPHA_WORDS,
    CORPUS,
    LANGUAGES,
    NORMAL,
    SENTENCES,
    WORD_RUNS,
    char_ngrams_cte,
    sequence_ngrams_cte,
    sql,
    words_cte,
)
from textgrain.plans.registry import query
from textgrain.session import durable, shared_folder
from textgrain.sources import labelled as readers
from textgrain.sources import sinks
from textgrain.sources.tables import corpus, documents

BALANCED_ROWS = 100


def _processed(spark: SparkSession, folder: str, keep=(), labelled: bool = False) -> DataFrame:
    docs = corpus(spark, folder) if labelled else documents(spark, folder)
    return nt.processed_documents(docs, tx.stop_words(LANGUAGES), keep=keep)


# --- flagship ---------------------------------------------------------------------


@query(
    "class_top_ngrams",
    lambda: sql(
        CORPUS,
        words_cte("corpus", "label"),
        char_ngrams_cte(3, "label"),
        final="""
SELECT label, ngram, cnt, docs, weight, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, ngram) AS rank FROM (
    SELECT label, ngram, sum(cnt)::BIGINT AS cnt, count(*) AS docs, round(sum(cnt / total), 9) AS weight
    FROM char3 GROUP BY label, ngram))
WHERE rank <= 20""",
    ),
)
def class_top_ngrams(spark, folder):
    counts = nt.ngram_counts(_processed(spark, folder, ["label"], labelled=True), [("char", 3)], ["label"])
    return nt.top_ngrams(counts, "label", 20)


# --- subsets ----------------------------------------------------------------------


def _greedy_scan(direction: str) -> str:
    """The scan as it is defined: one row after the other."""
    return sql(
        f"""
seq AS (SELECT doc_id, quality AS label, row_number() OVER (ORDER BY doc_id {direction}) AS i
        FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1)),
scan AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS c0, CAST(0 AS BIGINT) AS c1,
         CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS INT) AS label, false AS taken
  UNION ALL
  SELECT s.i,
         c.c0 + CASE WHEN s.label = 0 AND c.c0 <= c.c1 THEN 1 ELSE 0 END,
         c.c1 + CASE WHEN s.label = 1 AND c.c1 <= c.c0 THEN 1 ELSE 0 END,
         s.doc_id, s.label,
         CASE WHEN s.label = 0 THEN c.c0 <= c.c1 ELSE c.c1 <= c.c0 END
  FROM scan c JOIN seq s ON s.i = c.i + 1
  WHERE c.c0 + c.c1 < {BALANCED_ROWS})""",
        final="SELECT doc_id, label, row_number() OVER (ORDER BY i) AS pick_no FROM scan WHERE taken",
        recursive=True,
    )


@query("balanced_head", lambda: _greedy_scan("ASC"))
def balanced_head(spark, folder):
    return subset.balanced_picks(corpus(spark, folder), BALANCED_ROWS)


@query("balanced_tail", lambda: _greedy_scan("DESC"))
def balanced_tail(spark, folder):
    return subset.balanced_picks(corpus(spark, folder), BALANCED_ROWS, backward=True)


def _balanced_subset_sql(direction: str) -> str:
    return f"""
WITH picks AS ({_greedy_scan(direction)})
SELECT p.doc_id, p.label, p.pick_no, md5(d.text) AS digest,
       row_number() OVER (ORDER BY md5('42-' || p.doc_id), p.doc_id) AS position
FROM picks p JOIN documents d USING (doc_id)"""


def _balanced_subset(spark, folder, mode: str) -> DataFrame:
    rows = subset.balanced_subset(corpus(spark, folder), mode, BALANCED_ROWS)
    return rows.select("doc_id", "label", "pick_no", F.md5("text").alias("digest"), "position")


@query("balanced_train_subset", lambda: _balanced_subset_sql("ASC"))
def balanced_train_subset(spark, folder):
    return _balanced_subset(spark, folder, "train")


@query("balanced_validation_subset", lambda: _balanced_subset_sql("DESC"))
def balanced_validation_subset(spark, folder):
    return _balanced_subset(spark, folder, "validation")


@query("balanced_test_subset", lambda: _balanced_subset_sql("ASC"))
def balanced_test_subset(spark, folder):
    return _balanced_subset(spark, folder, "test")


# --- readers ----------------------------------------------------------------------


def _as_csv(spark, folder, *columns) -> str:
    """The labelled documents as CSV in the shared folder, with the given columns."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    sinks.write_table(corpus(spark, folder).select(*columns), path, "csv")
    return path


_READ = "SELECT md5(text) AS digest, {label} AS label, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2"


def _digests(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.md5("text").alias("digest"), "label").agg(F.count(F.lit(1)).alias("n"))


@query("read_labelled", _READ.format(label="CAST(quality AS VARCHAR)"))
def read_labelled(spark, folder):
    """Documents written as CSV and read back by their column names."""
    return _digests(readers.read_labelled(spark, _as_csv(spark, folder, "doc_id", "text", "label")))


@query("read_positional", _READ.format(label="CAST(quality AS VARCHAR)"))
def read_positional(spark, folder):
    """The same by the places of the columns, under other names."""
    path = _as_csv(spark, folder, F.col("text").alias("a"), F.col("label").alias("b"))
    return _digests(readers.read_positional(spark, path, header=True))


@query("read_trimmed", _READ.format(label="quality"))
def read_trimmed(spark, folder):
    """The same with blanks around the column names and a numeric label."""
    path = _as_csv(spark, folder, F.col("text").alias(" text "), F.col("label").alias("label "))
    return _digests(readers.read_trimmed(spark, path))


@query("class_counts", "SELECT quality AS label, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def class_counts(spark, folder):
    return subset.class_counts(corpus(spark, folder))


@query(
    "shuffled_docs",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42-' || doc_id), doc_id) AS position FROM documents",
)
def shuffled_docs(spark, folder):
    return subset.shuffled_positions(documents(spark, folder).select("doc_id"), "doc_id")


@query(
    "stratified_folds",
    lambda: sql(
        CORPUS,
        final="""
SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42-' || doc_id), doc_id) - 1) % 5 AS INT) AS fold
FROM corpus""",
    ),
)
def stratified_folds(spark, folder):
    return subset.with_folds(corpus(spark, folder).select("doc_id", "label"))


@query(
    "stratified_fraction",
    lambda: sql(
        CORPUS,
        """
ranked AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || doc_id), doc_id) AS r
           FROM corpus WHERE split = 'train'),
shares(train_size) AS (VALUES (0.1::DOUBLE), (0.2::DOUBLE), (0.4::DOUBLE), (0.6::DOUBLE), (0.8::DOUBLE), (1.0::DOUBLE)),
sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM ranked GROUP BY label),
parts AS (SELECT train_size, label, floor(total * train_size) AS keep, n * floor(total * train_size) / total AS exact
          FROM sizes, shares),
quotas AS (
  SELECT train_size, label,
         floor(exact) + CASE WHEN row_number() OVER (PARTITION BY train_size ORDER BY exact - floor(exact) DESC, label)
                              <= keep - sum(floor(exact)) OVER (PARTITION BY train_size) THEN 1 ELSE 0 END AS quota
  FROM parts)""",
        final="SELECT q.train_size, r.doc_id, r.label FROM ranked r JOIN quotas q USING (label) WHERE r.r <= q.quota",
    ),
)
def stratified_fraction(spark, folder):
    train = corpus(spark, folder).filter(F.col("split") == "train").select("doc_id", "label")
    return subset.stratified_fractions(train)


# --- text functions ---------------------------------------------------------------


@query("normalized_text", f"SELECT doc_id, {NORMAL} AS text FROM documents")
def normalized_text(spark, folder):
    return documents(spark, folder).select("doc_id", tx.normalized("text").alias("text"))


def _token_rows(spark, folder, tokens):
    return documents(spark, folder).select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").alias("n"), F.array_join("t", " ").alias("tokens")
    )


def _token_sql(tokens: str) -> str:
    return (
        "SELECT doc_id, CAST(len(t) AS INT) AS n, array_to_string(t, ' ') AS tokens "
        f"FROM (SELECT doc_id, {tokens} AS t FROM documents)"
    )


@query("sif_tokens", _token_sql(WORD_RUNS))
def sif_tokens(spark, folder):
    return _token_rows(spark, folder, tx.word_runs("text"))


@query("alpha_tokens", _token_sql(ALPHA_WORDS))
def alpha_tokens(spark, folder):
    return _token_rows(spark, folder, tx.alpha_words("text"))


@query(
    "word_tokens",
    lambda: sql(words_cte(), final="SELECT doc_id, CAST(len(word) AS INT) AS n, text AS tokens FROM words"),
)
def word_tokens(spark, folder):
    return _processed(spark, folder).select("doc_id", F.size("word").alias("n"), F.col("text").alias("tokens"))


@query(
    "sentences",
    f"SELECT doc_id, CAST(len(s) AS INT) AS n, array_to_string(s, chr(10)) AS lines "
    f"FROM (SELECT doc_id, {SENTENCES} AS s FROM documents)",
)
def sentences(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.size(tx.sentences("text")).alias("n"), tx.one_sentence_per_line("text").alias("lines")
    )


_KEY = "printf('%s_%05d', split, doc_id)"


@query(
    "document_export",
    lambda: sql(CORPUS, final=f"SELECT split, {_KEY} AS filename, array_to_string({SENTENCES}, chr(10)) AS text FROM corpus"),
)
def document_export(spark, folder):
    return sinks.document_export(corpus(spark, folder))


@query("label_mapping", lambda: sql(CORPUS, final=f"SELECT {_KEY} AS filename, label FROM corpus"))
def label_mapping(spark, folder):
    return sinks.label_mapping(corpus(spark, folder))


@query("newline_to_space", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")
def newline_to_space(spark, folder):
    return documents(spark, folder).select("doc_id", tx.newlines_to_spaces("text").alias("text"))


def _pad_sql(length: int) -> str:
    return f"""
SELECT doc_id,
       array_to_string(list_concat(ids[1:{length}], list_transform(range(greatest({length} - len(ids), 0)), lambda i: 0)), ' ') AS ids,
       least(len(ids), {length}) AS real
FROM (SELECT doc_id, list_transform({WORD_RUNS}, lambda w: length(w)) AS ids FROM documents)"""


@query("truncate_pad", _pad_sql(256))
def truncate_pad(spark, folder):
    ids = F.transform(tx.word_runs("text"), lambda w: F.char_length(w))
    docs = documents(spark, folder).select("doc_id", ids.alias("ids"))
    kept, mask = tx.truncate_pad("ids", 256)
    return docs.select(
        "doc_id",
        F.array_join(kept.cast("array<string>"), " ").alias("ids"),
        F.aggregate(mask, F.lit(0), lambda a, m: a + m).cast("long").alias("real"),
    )


# --- n-gram tables ----------------------------------------------------------------

_LONG = "SELECT doc_id, kind, n, ngram, cnt, total, cnt / total AS freq FROM"


def _all_of(tables) -> str:
    return " UNION ALL ".join(f"{_LONG} {table}" for table in tables)


@query(
    "char_ngrams",
    lambda: sql(words_cte(), *[char_ngrams_cte(n) for n in ng.CHAR_ORDERS], final=_all_of(f"char{n}" for n in ng.CHAR_ORDERS)),
)
def char_ngrams(spark, folder):
    return nt.ngram_counts(_processed(spark, folder), [("char", n) for n in ng.CHAR_ORDERS])


@query(
    "word_ngrams",
    lambda: sql(
        words_cte(),
        *[sequence_ngrams_cte("word", n) for n in ng.SEQUENCE_ORDERS],
        final=_all_of(f"word{n}" for n in ng.SEQUENCE_ORDERS),
    ),
)
def word_ngrams(spark, folder):
    return nt.ngram_counts(_processed(spark, folder), [("word", n) for n in ng.SEQUENCE_ORDERS])


@query(
    "absolute_ngrams",
    lambda: sql(
        words_cte(), char_ngrams_cte(2), final="SELECT doc_id, ngram, CAST(cnt AS DOUBLE) AS freq FROM char2"
    ),
)
def absolute_ngrams(spark, folder):
    counts = nt.ngram_counts(_processed(spark, folder), [("char", 2)], relative=False)
    return counts.select("doc_id", "ngram", "freq")


@query(
    "corpus_ngram_totals",
    lambda: sql(
        words_cte(),
        *[char_ngrams_cte(n) for n in ng.CHAR_ORDERS],
        *[sequence_ngrams_cte("word", n) for n in ng.SEQUENCE_ORDERS],
        final="SELECT kind, n, ngram, sum(cnt)::BIGINT AS cnt, count(*) AS docs FROM ("
        + " UNION ALL ".join(
            f"SELECT kind, n, ngram, cnt FROM {t}"
            for t in ("char2", "char3", "char4", "word1", "word2", "word3", "word4")
        )
        + ") GROUP BY kind, n, ngram",
    ),
)
def corpus_ngram_totals(spark, folder):
    families = [("char", n) for n in ng.CHAR_ORDERS] + [("word", n) for n in ng.SEQUENCE_ORDERS]
    return nt.corpus_totals(nt.ngram_counts(_processed(spark, folder), families))


def lexicon(spark, folder) -> DataFrame:
    """Forms of the corpus with a stand-in lemma and part of speech; every tenth is left out."""
    forms = _processed(spark, folder).select(F.explode_outer("word").alias("form")).distinct()
    known = forms.filter(F.col("form").isNotNull() & (F.char_length("form") % 10 != 0))
    last = F.lower(F.substring("form", -1, 1))
    pos = F.when(last.isin("a", "e", "i", "o", "u"), "NOUN").when(last.isin("n", "r", "s", "t"), "VERB").otherwise("ADJ")
    return durable(known.select("form", F.substring("form", 1, 5).alias("lemma"), pos.alias("pos")))


_TAGGED = """
tagged AS (
  SELECT doc_id,
         list(CASE WHEN length(form) % 10 <> 0 THEN left(form, 5) ELSE form END ORDER BY slot) AS lemma,
         list(CASE WHEN length(form) % 10 = 0 THEN 'X'
                   WHEN lower(right(form, 1)) IN ('a','e','i','o','u') THEN 'NOUN'
                   WHEN lower(right(form, 1)) IN ('n','r','s','t') THEN 'VERB' ELSE 'ADJ' END ORDER BY slot) AS pos
  FROM kept GROUP BY doc_id)"""


def _tagged(spark, folder) -> DataFrame:
    return nt.processed_documents(
        documents(spark, folder), tx.stop_words(LANGUAGES), lexicon(spark, folder)
    )


@query(
    "lemma_pos_ngrams",
    lambda: sql(
        words_cte(),
        _TAGGED,
        *[sequence_ngrams_cte(k, n, source="tagged") for k in ("lemma", "pos") for n in ng.SEQUENCE_ORDERS],
        final="SELECT kind, n, ngram, sum(cnt)::BIGINT AS cnt, count(*) AS docs FROM ("
        + " UNION ALL ".join(f"SELECT kind, n, ngram, cnt FROM {k}{n}" for k in ("lemma", "pos") for n in (1, 2, 3, 4))
        + ") GROUP BY kind, n, ngram",
    ),
)
def lemma_pos_ngrams(spark, folder):
    families = [(k, n) for k in ("lemma", "pos") for n in ng.SEQUENCE_ORDERS]
    return nt.corpus_totals(nt.ngram_counts(_tagged(spark, folder), families))


_SUFFIXES = f"""
lexicon AS (
  SELECT DISTINCT form, left(form, 5) AS lemma,
         CASE WHEN lower(right(form, 1)) IN ('a','e','i','o','u') THEN 'NOUN'
              WHEN lower(right(form, 1)) IN ('n','r','s','t') THEN 'VERB' ELSE 'ADJ' END AS pos
  FROM kept WHERE length(form) % 10 <> 0),
ruled AS (
  SELECT form, pos, length(form) - same AS cut, substring(lemma, same + 1) AS added FROM (
    SELECT *, len(list_filter(range(1, least(length(form), length(lemma)) + 1), lambda i: left(form, i) = left(lemma, i))) AS same FROM lexicon)),
rules AS (
  SELECT ending, pos, cut, added, count(*) AS n FROM (
    SELECT unnest(list_transform(range(0, least({suffixes.LONGEST}, length(form)) + 1), lambda k: right(lower(form), k))) AS ending, pos, cut, added FROM ruled)
  GROUP BY ending, pos, cut, added),
parts AS (SELECT ending, pos, sum(n) AS n FROM rules GROUP BY ending, pos),
winners AS (SELECT ending, pos FROM parts QUALIFY row_number() OVER (PARTITION BY ending ORDER BY n DESC, pos) = 1),
support AS (SELECT ending, sum(n) AS forms FROM parts GROUP BY ending),
endings AS (
  SELECT ending, pos, cut, added FROM rules JOIN winners USING (ending, pos) JOIN support USING (ending)
  WHERE forms >= {suffixes.LEAST} OR ending = ''
  QUALIFY row_number() OVER (PARTITION BY ending ORDER BY n DESC, cut, added) = 1),
lacking AS (SELECT DISTINCT form FROM kept WHERE length(form) % 10 = 0),
guessed AS (
  SELECT form, CASE WHEN cut < length(form) THEN left(form, length(form) - cut) || added ELSE form END AS lemma, pos FROM (
    SELECT form, unnest(range(0, least({suffixes.LONGEST}, length(form)) + 1)) AS k FROM lacking)
  JOIN endings ON ending = right(lower(form), k)
  QUALIFY row_number() OVER (PARTITION BY form ORDER BY k DESC) = 1)"""


@query("suffix_lexicon", lambda: sql(words_cte(), _SUFFIXES, final="SELECT form, lemma, pos FROM guessed"))
def suffix_lexicon(spark, folder):
    """Forms that the lexicon lacks, with what their endings say."""
    forms = _processed(spark, folder).select(F.explode("word").alias("form"))
    known = lexicon(spark, folder)
    lacking = forms.distinct().join(known, "form", "left_anti")
    return suffixes.guessed_forms(lacking, suffixes.suffix_table(known))


@query(
    "suffix_tags",
    lambda: sql(
        words_cte(),
        _SUFFIXES,
        "every AS (SELECT form, lemma, pos FROM lexicon UNION ALL SELECT form, lemma, pos FROM guessed)",
        final="SELECT doc_id, pos, count(*) AS cnt, count(DISTINCT lemma) AS lemmas FROM kept JOIN every USING (form) GROUP BY doc_id, pos",
    ),
)
def suffix_tags(spark, folder):
    """Words and lemmas of every part of speech in a document, unknown forms included."""
    words = durable(_processed(spark, folder).select("doc_id", "word"))
    forms = words.select(F.explode("word").alias("form"))
    whole = durable(suffixes.extended_lexicon(forms, lexicon(spark, folder)))
    tagged = nt.tag_words(by_document(words, size=F.size("word") * F.lit(8)), whole)
    entries = tagged.select("doc_id", F.inline(F.arrays_zip("pos", "lemma")))
    return entries.groupBy("doc_id", "pos").agg(F.count(F.lit(1)).alias("cnt"), F.countDistinct("lemma").alias("lemmas"))


# The fifteen families of a profile.
_PROFILE = tuple(ng.representations()["all_ngrams"])


@query(
    "ngram_profile",
    lambda: sql(
        words_cte(),
        _TAGGED,
        *[char_ngrams_cte(n) if k == "char" else sequence_ngrams_cte(k, n, source="words" if k == "word" else "tagged") for k, n in _PROFILE],
        final="SELECT doc_id, family, CAST(row_number() OVER (PARTITION BY doc_id, family ORDER BY cnt DESC, ngram) - 1 AS INT) AS slot, ngram, cnt / total AS freq FROM ("
        + " UNION ALL ".join(f"SELECT '{ng.family_name(k, n)}' AS family, * FROM {k}{n}" for k, n in _PROFILE)
        + ")",
    ),
)
def ngram_profile(spark, folder):
    # Placed again by document: what is read back has lost its place, and the n-grams of the
    # fifteen families would be moved instead of the words.
    words = by_document(durable(_tagged(spark, folder)), size=F.octet_length("text"), most=nt.placed_bytes(_PROFILE))
    profile = nt.ngram_profile(words, _PROFILE)
    named = [
        F.struct(F.lit(ng.family_name(k, n)).alias("family"), F.col(ng.family_name(k, n)).alias("cell"))
        for k, n in _PROFILE
    ]
    return profile.select("doc_id", F.inline(F.array(*named))).select(
        "doc_id", "family", F.posexplode("cell").alias("slot", "e")
    ).select("doc_id", "family", "slot", "e.ngram", "e.freq")


@query(
    "profile_json_features",
    lambda: sql(
        CORPUS,
        words_cte("corpus"),
        sequence_ngrams_cte("word", 1),
        final="SELECT doc_id, 'word_1grams::' || ngram AS feature, cnt / total AS freq FROM word1",
    ),
)
def profile_json_features(spark, folder):
    profile = nt.ngram_profile(_processed(spark, folder, labelled=True), [("word", 1)], as_json=True)
    decoded = nt.cells_from_json(profile, ["word_1grams"])
    return nt.profile_features(decoded, [("word", 1)])


_VOCAB = """
vocab AS (
  SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS index FROM (
    SELECT DISTINCT feature FROM (
      SELECT 'char_2grams::' || ngram AS feature FROM char2 WHERE split = 'train'
      UNION ALL SELECT 'word_1grams::' || ngram FROM word1 WHERE split = 'train')))"""


def _vocab_ctes() -> list[str]:
    return [CORPUS, words_cte("corpus", "split"), char_ngrams_cte(2, "split"), sequence_ngrams_cte("word", 1, "split"), _VOCAB]


def _train_counts(spark, folder) -> DataFrame:
    return nt.ngram_counts(
        _processed(spark, folder, ["split"], labelled=True), [("char", 2), ("word", 1)], ["split"]
    )


@query("feature_vocab", lambda: sql(*_vocab_ctes(), final="SELECT feature, index FROM vocab"))
def feature_vocab(spark, folder):
    return nt.vocabulary(_train_counts(spark, folder).filter(F.col("split") == "train"))


@query(
    "known_features",
    lambda: sql(
        *_vocab_ctes(),
        final="""
SELECT doc_id, index, cnt / total AS freq FROM (
  SELECT doc_id, split, 'char_2grams::' || ngram AS feature, cnt, total FROM char2
  UNION ALL SELECT doc_id, split, 'word_1grams::' || ngram, cnt, total FROM word1) JOIN vocab USING (feature)
WHERE split <> 'train'""",
    ),
)
def known_features(spark, folder):
    counts = _train_counts(spark, folder)
    vocab = nt.vocabulary(counts.filter(F.col("split") == "train"))
    held_out = counts.filter(F.col("split") != "train")
    return nt.known_features(held_out, vocab).select("doc_id", "index", "freq")
