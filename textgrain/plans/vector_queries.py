"""Word-vector pooling, numeric features and scaling."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.functions import text as tx
from textgrain.functions import vectors as vec
from textgrain.operators import features as ft
from textgrain.operators import ngram_tables as nt
from textgrain.operators import pooling, subwords
from textgrain.plans.fragments import (
    ALPHA_WORDS,
    CORPUS,
    SENTENCES,
    WORD_RUNS,
    sequence_ngrams_cte,
    sql,
    words_cte,
)
from textgrain.plans.registry import query
from textgrain.plans.text_queries import _TAGGED, _processed, _tagged
from textgrain.session import durable, shared_folder
from textgrain.sources import labelled, sinks
from textgrain.sources.tables import (
    EMBEDDING_WIDTH,
    corpus,
    documents,
    ranked_word_vectors,
    split_of,
    table,
)
from textgrain.sources.word_vectors import converted_word_vectors, word_vectors

DIGITS = 6


def components(df: DataFrame, *keys: str) -> DataFrame:
    """One row per vector component, rounded."""
    return df.select(*keys, F.posexplode("vec").alias("dim", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), DIGITS) + F.lit(0.0)
    )


def embeddings(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        (F.col("label") >= 5).cast("int").alias("label"),
        split_of("vec_id").alias("split"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


# --- word vectors and pooling -----------------------------------------------------

_RANKED = f"""
ranked AS (
  SELECT token, row_number() OVER (ORDER BY cnt DESC, token) AS rank FROM (
    SELECT token, count(*) AS cnt FROM (SELECT unnest({WORD_RUNS}) AS token FROM documents) GROUP BY token)),
wv AS (SELECT token, embedding AS vec FROM ranked JOIN embeddings ON vec_id = rank - 1)"""

_PROB = f"""
train_tokens AS (SELECT unnest({WORD_RUNS}) AS token FROM corpus WHERE split = 'train'),
prob AS (SELECT token, count(*) AS cnt, count(*) / (SELECT count(*) FROM train_tokens) AS p FROM train_tokens GROUP BY token)"""


def _pairs(tokens: str, source: str = "documents") -> str:
    return f"""
pairs AS (SELECT doc_id, token, count(*) AS cnt FROM (SELECT doc_id, unnest({tokens}) AS token FROM {source}) GROUP BY doc_id, token),
known AS (
  SELECT doc_id, token, cnt, unnest(range(0, 64)) AS dim, unnest(vec)::DOUBLE AS x
  FROM pairs JOIN wv USING (token))"""


def _pooled(value: str, source: str = "documents", width: int = 64) -> str:
    """Every document has every dimension; missing ones are zero."""
    return f"""
SELECT d.doc_id, g.dim::INT AS dim, round(coalesce(v.value, 0), {DIGITS}) + 0.0 AS value
FROM {source} d CROSS JOIN (SELECT unnest(range(0, {width})) AS dim) g
LEFT JOIN ({value}) v ON v.doc_id = d.doc_id AND v.dim = g.dim"""


@query("ranked_word_vectors", lambda: sql(
    _RANKED,
    final=f"SELECT token, (unnest(range(0, 64)))::INT AS dim, round(unnest(vec)::DOUBLE, {DIGITS}) + 0.0 AS value FROM wv",
))
def ranked_words(spark, folder):
    return components(ranked_word_vectors(spark, folder), "token")


@query("word_vector_table", lambda: sql(
    _RANKED,
    final=f"SELECT token, (unnest(range(0, 64)))::INT AS dim, round(unnest(vec)::DOUBLE, {DIGITS}) + 0.0 AS value FROM wv",
))
def word_vector_table(spark, folder):
    """The same vectors by way of a table with a word column and shuffled dimN columns."""
    vectors = ranked_word_vectors(spark, folder)
    order = sorted(range(EMBEDDING_WIDTH), key=str, reverse=True)
    wide = vectors.select(*[F.get("vec", i).alias(f"dim{i}") for i in order], F.col("token").alias("Word"))
    return components(word_vectors(wide), "token")


@query("converted_word_vectors", lambda: sql(
    _RANKED,
    final=f"SELECT token, (unnest(range(0, 64)))::INT AS dim, round(unnest(vec)::DOUBLE, {DIGITS}) + 0.0 AS value FROM wv",
))
def converted_vectors(spark, folder):
    """The same vectors by way of the kept copy of a wide table in files."""
    vectors = ranked_word_vectors(spark, folder)
    wide = durable(vectors.select(F.col("token").alias("word"), *[F.get("vec", i).alias(f"dim{i}") for i in range(EMBEDDING_WIDTH)]))
    return components(converted_word_vectors(spark, wide, f"{shared_folder(spark)}/{uuid.uuid4().hex}"), "token")


@query("unigram_prob", lambda: sql(CORPUS, _PROB, final="SELECT token, cnt, p FROM prob"))
def unigram_prob(spark, folder):
    train = corpus(spark, folder).filter(F.col("split") == "train")
    return pooling.unigram_probabilities(train, tx.word_runs("text"))


@query("mean_pool", lambda: sql(
    _RANKED, _pairs(WORD_RUNS),
    final=_pooled("SELECT doc_id, dim, sum(cnt * x) / sum(cnt) AS value FROM known GROUP BY doc_id, dim"),
))
def mean_pool(spark, folder):
    docs, vectors = documents(spark, folder), ranked_word_vectors(spark, folder)
    return components(pooling.mean_pool(docs, vectors, EMBEDDING_WIDTH, tx.word_runs("text")), "doc_id")


@query("mean_std_pool", lambda: sql(
    _RANKED, _pairs(ALPHA_WORDS),
    """
means AS (SELECT doc_id, dim, sum(cnt * x) / sum(cnt) AS m, sum(cnt) AS w FROM known GROUP BY doc_id, dim),
spreads AS (SELECT k.doc_id, k.dim, sqrt(sum(k.cnt * (k.x - m.m) * (k.x - m.m)) / any_value(m.w)) AS s
            FROM known k JOIN means m ON k.doc_id = m.doc_id AND k.dim = m.dim GROUP BY k.doc_id, k.dim)""",
    final=_pooled(
        "SELECT doc_id, dim, m AS value FROM means UNION ALL SELECT doc_id, dim + 64, s FROM spreads", width=128
    ),
))
def mean_std_pool(spark, folder):
    docs, vectors = documents(spark, folder), ranked_word_vectors(spark, folder)
    return components(pooling.mean_std_pool(docs, vectors, EMBEDDING_WIDTH, tx.alpha_words("text")), "doc_id")


@query("sif_pool", lambda: sql(
    CORPUS, _PROB, _RANKED, _pairs(WORD_RUNS, "corpus"),
    """
weighted AS (SELECT doc_id, dim, x, k.cnt * (0.001::DOUBLE / (0.001::DOUBLE + coalesce(p, 0))) AS w
             FROM known k LEFT JOIN prob USING (token))""",
    final=_pooled("SELECT doc_id, dim, sum(w * x) / sum(w) AS value FROM weighted GROUP BY doc_id, dim", "corpus"),
))
def sif_pool(spark, folder):
    docs, vectors = corpus(spark, folder), ranked_word_vectors(spark, folder)
    tokens = tx.word_runs("text")
    prob = pooling.unigram_probabilities(docs.filter(F.col("split") == "train"), tokens)
    return components(pooling.sif_pool(docs, vectors, EMBEDDING_WIDTH, tokens, prob), "doc_id")


@query("sentence_vectors", lambda: sql(
    _RANKED,
    r"""
pairs AS (SELECT doc_id, token, count(*) AS cnt
          FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\s]+')) AS token FROM documents) GROUP BY doc_id, token),
unit AS (SELECT token, list_transform(vec, lambda x: x::DOUBLE / n) AS vec
         FROM (SELECT token, vec, sqrt(list_sum(list_transform(vec, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM wv)),
known AS (SELECT doc_id, cnt, unnest(range(0, 64)) AS dim, unnest(vec) AS x FROM pairs JOIN unit USING (token))""",
    final=_pooled("SELECT doc_id, dim, sum(cnt * x) / sum(cnt) AS value FROM known GROUP BY doc_id, dim"),
))
def sentence_vectors(spark, folder):
    docs, vectors = documents(spark, folder), ranked_word_vectors(spark, folder)
    tokens = F.regexp_extract_all(tx.newlines_to_spaces("text"), F.lit(r"[^\s]+"), F.lit(0))
    return components(pooling.sentence_vectors(docs, vectors, EMBEDDING_WIDTH, tokens), "doc_id")


# Buckets of the registered queries: few enough that several n-grams share one.
BUCKETS = 5_000


def _buckets(name: str, source: str) -> str:
    """``name(token, bucket, cnt)`` of the distinct tokens of ``source``."""
    grams = ", ".join(
        f"list_transform(range(1, length(m) - {n} + 2), lambda i: substring(m, i, {n}))"
        for n in range(subwords.SHORTEST, subwords.LONGEST + 1)
    )
    code = "('0x' || substring(h, 2 * i - 1, 2))::BIGINT"
    codes = f"list_transform(range(1, length(h) // 2 + 1), lambda i: CASE WHEN {code} < 128 THEN {code} ELSE {code} + 4294967040 END)"
    return f"""
{name}_grams AS (
  SELECT token, unnest(flatten([{grams}])) AS gram FROM (SELECT DISTINCT token, '<' || token || '>' AS m FROM {source})),
{name}_hashed AS (
  SELECT gram, list_reduce(list_prepend({subwords.FNV_OFFSET}::BIGINT, {codes}),
                           lambda s, b: (xor(s, b) * {subwords.FNV_PRIME}) % 4294967296) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT gram, hex(encode(gram)) AS h FROM {name}_grams)),
{name} AS (SELECT token, bucket, count(*) AS cnt FROM {name}_grams JOIN {name}_hashed USING (gram) GROUP BY token, bucket)"""


_SUBWORDS = (
    _RANKED,
    _buckets("known_buckets", "wv"),
    """
bucket_means AS (
  SELECT bucket, dim, sum(cnt * x) / sum(cnt) AS m FROM (
    SELECT bucket, cnt, unnest(range(0, 64)) AS dim, unnest(vec)::DOUBLE AS x FROM known_buckets JOIN wv USING (token))
  GROUP BY bucket, dim),
lacking AS (SELECT token FROM ranked WHERE token NOT IN (SELECT token FROM wv))""",
    _buckets("new_buckets", "lacking"),
    """
guessed AS (SELECT token, dim, sum(cnt * m) / sum(cnt) AS x FROM new_buckets JOIN bucket_means USING (bucket) GROUP BY token, dim)""",
)


def _every_word(spark, folder) -> DataFrame:
    """Vectors of all words of the documents, those without an own one from their n-grams."""
    vectors = ranked_word_vectors(spark, folder)
    words = documents(spark, folder).select(F.explode(tx.word_runs("text")).alias("token"))
    means = durable(subwords.bucket_vectors(vectors, EMBEDDING_WIDTH, BUCKETS))
    return subwords.with_subwords(words, vectors, means, EMBEDDING_WIDTH, BUCKETS)


@query("subword_vectors", lambda: sql(
    *_SUBWORDS,
    final=f"SELECT token, round(sum(x), {DIGITS}) + 0.0 AS total, round(sum(x * (dim + 1)), {DIGITS}) + 0.0 AS moment FROM guessed GROUP BY token",
))
def subword_vectors(spark, folder):
    """The words without an own vector, with two sums over the components of the one they get."""
    found = _every_word(spark, folder).filter(~F.col("known"))
    places = F.array(*[F.lit(float(i + 1)) for i in range(EMBEDDING_WIDTH)])
    ones = F.array_repeat(F.lit(1.0), EMBEDDING_WIDTH)
    sums = {"total": vec.dot("vec", ones), "moment": vec.dot("vec", places)}
    return found.select("token", *[(F.round(x, DIGITS) + F.lit(0.0)).alias(name) for name, x in sums.items()])


@query("subword_mean_pool", lambda: sql(
    *_SUBWORDS,
    """
every AS (
  SELECT token, dim, x FROM guessed
  UNION ALL SELECT token, unnest(range(0, 64)), unnest(vec)::DOUBLE FROM wv),
counts AS (SELECT doc_id, token, count(*) AS cnt FROM (SELECT doc_id, unnest({runs}) AS token FROM documents) GROUP BY doc_id, token)""".format(runs=WORD_RUNS),
    final=_pooled("SELECT doc_id, dim, sum(cnt * x) / sum(cnt) AS value FROM counts JOIN every USING (token) GROUP BY doc_id, dim"),
))
def subword_mean_pool(spark, folder):
    every = durable(_every_word(spark, folder).select("token", "vec"))
    return components(pooling.mean_pool(documents(spark, folder), every, EMBEDDING_WIDTH, tx.word_runs("text")), "doc_id")


@query("masked_mean_pool", """
SELECT doc_id, dim::INT AS dim, round(sum(mask * x) / greatest(sum(mask), 1e-9), 6) + 0.0 AS value FROM (
  SELECT vec_id // 10 AS doc_id, CASE WHEN label < 8 THEN 1 ELSE 0 END AS mask,
         unnest(range(0, 64)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
GROUP BY doc_id, dim""")
def masked_mean_pool(spark, folder):
    states = table(spark, folder, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("doc_id"),
        (F.col("label") < 8).cast("int").alias("mask"),
        F.col("embedding").alias("vec"),
    )
    return components(pooling.masked_mean_pool(states, EMBEDDING_WIDTH), "doc_id")


_DOUBLES = "e AS (SELECT vec_id AS doc_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_NORM = "sqrt(list_sum(list_transform(v, lambda x: x * x)))"


@query("l2_normalize", f"""
WITH {_DOUBLES}
SELECT doc_id, unnest(range(0, 64))::INT AS dim, round(unnest(list_transform(v, lambda x: x / n)), 6) + 0.0 AS value
FROM (SELECT doc_id, v, greatest({_NORM}, 1e-12) AS n FROM e)""")
def l2_normalize(spark, folder):
    rows = embeddings(spark, folder).select("doc_id", vec.unit("vec").alias("vec"))
    return components(rows, "doc_id")


@query("remove_direction", f"""
WITH {_DOUBLES},
axis AS (SELECT list_transform(v, lambda x: x / n) AS a FROM (SELECT v, {_NORM} AS n FROM e WHERE doc_id = 0)),
proj AS (SELECT doc_id, v, a, list_dot_product(v, a) AS s FROM e, axis)
SELECT doc_id, unnest(range(0, 64))::INT AS dim,
       round(unnest(list_transform(list_zip(v, a), lambda z: z[1] - s * z[2])), 6) + 0.0 AS value
FROM proj""")
def remove_direction(spark, folder):
    rows = embeddings(spark, folder)
    first = rows.filter(F.col("doc_id") == 0).select(vec.unit("vec").alias("vec")).first()["vec"]
    return components(pooling.remove_direction(rows, first), "doc_id")


# The Gram matrix over its trace, squared twelve times, is the outer product of the direction
# with itself: weaker directions have shrunk to their 4096th power.
@query("first_direction", """
WITH RECURSIVE x AS (
  SELECT vec_id AS doc_id, unnest(range(0, 64))::INT AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings WHERE vec_id % 4 < 2),
gram AS (SELECT a.dim AS i, b.dim AS j, sum(a.x * b.x) AS v FROM x a JOIN x b USING (doc_id) GROUP BY a.dim, b.dim),
powers AS (
  SELECT 0 AS step, i, j, v / (SELECT sum(v) FROM gram WHERE i = j) AS v FROM gram
  UNION ALL
  SELECT step + 1, i, j, v / sum(CASE WHEN i = j THEN v END) OVER () FROM (
    SELECT a.step, a.i, b.j, sum(a.v * b.v) AS v FROM powers a JOIN powers b ON a.j = b.i WHERE a.step < 12 GROUP BY a.step, a.i, b.j)),
top AS (SELECT i FROM powers WHERE step = 12 AND i = j ORDER BY v DESC LIMIT 1),
axis AS (SELECT j AS dim, v FROM powers WHERE step = 12 AND i = (SELECT i FROM top))
SELECT dim, round(v / (SELECT sqrt(sum(v * v)) FROM axis), 6) + 0.0 AS value FROM axis""")
def first_direction(spark, folder):
    """Leading direction of the training vectors, its sign fixed by the largest component."""
    train = embeddings(spark, folder).filter(F.col("split") == "train")
    axis = pooling.first_direction(train)
    sign = 1.0 if max(axis, key=abs) > 0 else -1.0
    rows = [(i, round(sign * x, DIGITS)) for i, x in enumerate(axis)]
    return spark.createDataFrame(rows, "dim int, value double")


@query("wide_matrix", "SELECT "
       + ", ".join(f"embedding[{i + 1}]::DOUBLE AS emb_{i}" for i in range(64))
       + ", CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label FROM embeddings")
def wide_matrix(spark, folder):
    return sinks.wide_matrix(embeddings(spark, folder), EMBEDDING_WIDTH)


@query("features_and_label", f"""
SELECT vec_id AS doc_id, unnest(range(len(embedding)))::INT AS dim, unnest(embedding)::DOUBLE AS value,
       CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label
FROM embeddings""")
def features_and_label(spark, folder):
    rows = embeddings(spark, folder)
    wide = rows.select("doc_id", *[F.get("vec", i).alias(f"f_{i}") for i in range(EMBEDDING_WIDTH)], "label")
    _, matrix = labelled.features_and_label(wide, exclude=["doc_id"])
    return matrix.select("doc_id", "label", F.posexplode("vec").alias("dim", "value"))


# --- profiles and numeric features ------------------------------------------------

_SURFACE = f"""
surface AS (
  SELECT doc_id, ns AS n_sentences, nt AS n_tokens, ty AS n_types,
         CASE WHEN ns = 0 THEN 0 ELSE nt / ns END AS tokens_per_sentence,
         CASE WHEN nt = 0 THEN 0 ELSE letters / nt END AS chars_per_token,
         CASE WHEN nt = 0 THEN 0 ELSE ty / nt END AS type_token_ratio
  FROM (SELECT doc_id, len({SENTENCES})::INT AS ns, len({WORD_RUNS})::INT AS nt,
               len(list_distinct({WORD_RUNS}))::INT AS ty,
               coalesce(list_sum(list_transform({WORD_RUNS}, lambda w: length(w))), 0) AS letters FROM documents))"""


@query("surface_profile", lambda: sql(_SURFACE, final="SELECT * FROM surface"))
def surface_profile(spark, folder):
    return ft.surface_profile(documents(spark, folder))


@query("pos_shares", lambda: sql(
    words_cte(), _TAGGED,
    final="SELECT doc_id, p AS pos, count(*) / any_value(n) AS share FROM (SELECT doc_id, unnest(pos) AS p, len(pos) AS n FROM tagged) GROUP BY doc_id, p",
))
def pos_shares(spark, folder):
    return ft.pos_shares(_tagged(spark, folder))


@query("coerce_numeric", """
SELECT event_id, value, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS props,
       coalesce(TRY_CAST(event_type AS DOUBLE), 0) AS event_type
FROM events""")
def coerce_numeric(spark, folder):
    events = table(spark, folder, "events")
    raw = events.select("event_id", "value", F.get_json_object("props", "$.k").alias("props"), "event_type")
    return ft.coerce_numeric(raw, ["value", "props", "event_type"])


@query("common_features", lambda: sql(
    _SURFACE,
    final="SELECT doc_id, 'chars_per_token,n_sentences,n_tokens' AS features, chars_per_token, n_sentences, n_tokens FROM surface",
))
def common_features(spark, folder):
    """Columns shared by three profile tables of different shape."""
    profile = ft.surface_profile(documents(spark, folder))
    first = profile.drop("type_token_ratio").withColumn("label", F.lit(0))
    second = profile.drop("n_types")
    third = profile.drop("tokens_per_sentence").withColumn("filename", F.lit(""))
    names = ft.common_features(first, second, third, exclude=[*ft.NOT_FEATURES, "doc_id"])
    return profile.select("doc_id", F.lit(",".join(names)).alias("features"), *names)


@query("remap_labels", lambda: sql(
    CORPUS, _SURFACE,
    final="""
SELECT printf('%s_%05d', CASE WHEN s.doc_id % 4 < 2 THEN 'train' WHEN s.doc_id % 4 = 2 THEN 'validation' ELSE 'test' END, s.doc_id) AS filename,
       n_tokens, label FROM surface s LEFT JOIN corpus c USING (doc_id)""",
))
def remap_labels(spark, folder):
    profile = ft.surface_profile(documents(spark, folder)).withColumn("split", split_of())
    broken = profile.select(tx.document_key("split", "doc_id").alias("ilename"), "n_tokens")
    mapping = sinks.label_mapping(corpus(spark, folder))
    return ft.remap_labels(broken, mapping).select("filename", "n_tokens", "label")


@query("label_encode", """
SELECT doc_id, lang AS decoded, (dense_rank() OVER (ORDER BY lang) - 1)::DOUBLE AS code FROM documents""")
def label_encode(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("label"))
    encoder, decoder = ft.label_codes(docs)
    coded = decoder.transform(encoder.transform(docs))
    return coded.select("doc_id", "code", F.col("code_label").alias("decoded"))


@query("standardize", """
WITH x AS (SELECT vec_id AS doc_id, unnest(range(0, 64)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s FROM x WHERE doc_id % 4 < 2 GROUP BY dim)
SELECT doc_id, dim::INT AS dim, round((x - m) / s, 6) + 0.0 AS value FROM x JOIN m USING (dim)""")
def standardize(spark, folder):
    rows = embeddings(spark, folder)
    scaler = ft.fit_scaler(rows.filter(F.col("split") == "train"))
    return components(rows.select("doc_id", scaler.centred("vec").alias("vec")), "doc_id")


@query("scale_only", """
WITH x AS (SELECT vec_id AS doc_id, unnest(range(0, 64)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT dim, stddev_pop(x) AS s FROM x WHERE doc_id % 4 < 2 GROUP BY dim)
SELECT doc_id, dim::INT AS dim, round(x / s, 6) + 0.0 AS value FROM x JOIN m USING (dim)""")
def scale_only(spark, folder):
    from pyspark.ml.functions import array_to_vector

    rows = embeddings(spark, folder)
    scaler = ft.fit_scaler(rows.filter(F.col("split") == "train"))
    stage = scaler.scale_only("v", "scaled")
    scaled = stage.transform(rows.select("doc_id", array_to_vector("vec").alias("v")))
    return components(scaled.select("doc_id", vector_to_array("scaled").alias("vec")), "doc_id")


def _train_word_counts(spark, folder) -> DataFrame:
    counts = nt.ngram_counts(_processed(spark, folder, ["split"], labelled=True), [("word", 1)], ["split"])
    return counts.withColumn("feature", F.concat(F.lit("word_1grams::"), "ngram"))


_DEVIATIONS = """
train_docs AS (SELECT count(*)::DOUBLE AS size FROM corpus WHERE split = 'train'),
deviations AS (
  SELECT feature, CASE WHEN var <= 0 THEN 1 ELSE sqrt(var) END AS std FROM (
    SELECT 'word_1grams::' || ngram AS feature,
           sum(cnt / total * cnt / total) / any_value(size) - pow(sum(cnt / total) / any_value(size), 2) AS var
    FROM word1, train_docs WHERE split = 'train' GROUP BY ngram))"""


@query("standardize_sparse", lambda: sql(
    CORPUS, words_cte("corpus", "split"), sequence_ngrams_cte("word", 1, "split"), _DEVIATIONS,
    final="SELECT feature, round(std, 9) AS std FROM deviations",
))
def standardize_sparse(spark, folder):
    train = _train_word_counts(spark, folder).filter(F.col("split") == "train")
    n = corpus(spark, folder).filter(F.col("split") == "train").count()
    return ft.sparse_deviations(train, n).select("feature", F.round("std", 9).alias("std"))
