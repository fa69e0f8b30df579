"""Word-vector tables."""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

# Accepted names of the word column.
WORD_COLUMNS = ("key", "word", "token", "term")
MANIFEST = "fingerprint string, folder string"


def word_vectors(table: DataFrame) -> DataFrame:
    """``(token, vec)`` from a table with a word column and ``dim0 .. dimN`` columns.

    Dimensions are ordered by their number, not by their name or position.
    """
    words = [c for c in table.columns if c.lower() in WORD_COLUMNS]
    dims = {int(c[3:]): c for c in table.columns if re.fullmatch(r"dim\d+", c.lower())}
    if not words or not dims:
        raise ValueError(f"no word column or no dimN columns among {table.columns}")
    vec = F.array(*[F.col(f"`{dims[i]}`").cast("float") for i in sorted(dims)])
    return table.select(F.col(f"`{words[0]}`").alias("token"), vec.alias("vec"))


def source_fingerprint(source: DataFrame) -> str:
    """Names the files that ``source`` reads, with their sizes and times, and its columns.

    The contents are not read, and the files are listed and combined by Spark in any order.
    A source that reads no files is named by its columns alone.
    """
    columns = hashlib.md5(source.schema.json().encode()).hexdigest()
    files = source.inputFiles()
    if not files:
        return columns
    stated = source.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    code = F.xxhash64("path", "length", "modificationTime")
    sums = stated.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(code), F.bit_xor(F.xxhash64(code, F.lit(1)))).first()
    return "-".join([*map(str, sums), columns])


def converted_word_vectors(spark: SparkSession, source: DataFrame, path: str) -> DataFrame:
    """The converted table of ``source``, kept below ``path``; converts it only if files changed.

    Every conversion is a folder of its own.  The manifest gets a row with the fingerprint of
    the source once the folder is whole, so an interrupted write is never read and is simply
    done again.  Changed, added and removed source files give another fingerprint.  Copies of
    earlier states stay for jobs that still read them, and count again if the files come back.
    A source that reads no files is converted once.
    """
    fingerprint = source_fingerprint(source)
    folder = _converted_folder(spark, path, fingerprint)
    if folder is None:
        folder = f"{path}/tables/{uuid.uuid4().hex}"
        word_vectors(source).write.parquet(folder)
        if source_fingerprint(source) != fingerprint:
            raise RuntimeError("the source changed while it was converted")
        row = spark.createDataFrame([(fingerprint, folder)], MANIFEST)
        row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return spark.read.parquet(folder)


def _converted_folder(spark: SparkSession, path: str, fingerprint: str) -> str | None:
    try:
        manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return manifest.filter(F.col("fingerprint") == fingerprint).agg(F.min("folder")).first()[0]
