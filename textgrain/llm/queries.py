"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrain.llm import oracles
from textgrain.llm.chat_windows import chat_windows, read_windows
from textgrain.llm.chosen_path import near_components
from textgrain.llm.common import read_table
from textgrain.llm.conversation_repair import damaged, repair_digests
from textgrain.llm.language import fit_languages, identify_languages
from textgrain.llm.multi_index import nearest_neighbours
from textgrain.llm.ordinal_quality import KEPT_FROM, fit_quality, grade_documents
from textgrain.llm.phrase_automata import phrase_digests
from textgrain.llm.piece_encoding import decode_ids, encode_texts
from textgrain.llm.string_tiling import contamination
from textgrain.llm.suffix_buckets import removal_digests
from textgrain.llm.token_counts import token_counts
from textgrain.llm.warc import read_archives, write_archives
from textgrain.llm.whitening import fit_whitening, whiten
from textgrain.session import durable

Query = Callable[[SparkSession, str], DataFrame]


# A conversation whose texts hold the marks of common templates.
MARKED_TEXT = r"\### Assistant: </turn> ok"


def op1_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED_TEXT), (-7, 1, "assistant", MARKED_TEXT)], "conv_id long, turn long, role string, text string")
    return read_windows(durable(chat_windows(turns.unionByName(marked))))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op3_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "text")
    model = fit_quality(docs, read_table(spark, folder, "labels", "doc_id", "quality", "toxic"))
    return grade_documents(docs, model).select("doc_id", "expected_grade", "tail", (F.col("tail") >= KEPT_FROM).alias("kept"))


def op4_suffix_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return removal_digests(read_table(spark, folder, "documents", "doc_id", "text"))


def op5_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "text")
    return contamination(docs, read_table(spark, folder, "benchmark", "item_id", "text"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    return identify_languages(docs, fit_languages(docs))


def op7_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_texts(read_table(spark, folder, "documents", "doc_id", "text"), model)
    decoded = decode_ids(encoded, model, output="decoded")
    return decoded.select("doc_id", "n_bytes", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(read_table(spark, folder, "documents", "doc_id", "text"), size=2)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages", "page_id", "url", "html")
    archives = durable(write_archives(pages))
    return read_archives(archives, with_payload=False).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


def op10_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, folder, "embeddings", "vec_id", "embedding"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return repair_digests(damaged(turns), turns)


def op12_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_digests(read_table(spark, folder, "documents", "doc_id", "text"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings", "vec_id", "embedding")
    return whiten(vectors, fit_whitening(vectors))


QUERIES: dict[str, Query] = {
    "op1_chat_windows": op1_chat_windows,
    "op2_token_counts": op2_token_counts,
    "op3_ordinal_quality": op3_ordinal_quality,
    "op4_suffix_buckets": op4_suffix_buckets,
    "op5_string_tiling": op5_string_tiling,
    "op6_language": op6_language,
    "op7_piece_encoding": op7_piece_encoding,
    "op8_chosen_path": op8_chosen_path,
    "op9_warc": op9_warc,
    "op10_multi_index": op10_multi_index,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_whitening": op13_whitening,
}

# DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_chat_windows": oracles.CHAT_WINDOWS,
    "op8_chosen_path": oracles.CHOSEN_PATH,
    "op9_warc": oracles.WARC,
    "op11_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op12_phrase_automata": oracles.PHRASE_AUTOMATA,
}
