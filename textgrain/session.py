"""Session defaults and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "textgrain") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(2 * cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names.

    Only a one-process run (``local[n]``, as in tests) may do without: it gets a new folder
    that is deleted when the process ends.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="textgrain-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


class Scratch:
    """Tables written by ``durable`` inside a ``with`` block of ``scratch``."""

    def __init__(self) -> None:
        self.paths: dict[str, SparkSession] = {}
        self.kept: dict[str, SparkSession] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave the table behind ``df`` in place: what the block returns still reads it.

        A block around this one then decides about the table.
        """
        path = getattr(df, "_durable_path", None)
        if path in self.paths:
            self.kept[path] = self.paths.pop(path)
        return df

    def clear(self) -> None:
        for path, spark in self.paths.items():
            _delete(spark, path)
        self.paths.clear()


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_open = threading.local()


@contextmanager
def scratch() -> Iterator[Scratch]:
    """Delete, at the end of the block, the tables that this thread wrote in it and did not keep."""
    blocks = _open.__dict__.setdefault("blocks", [])
    blocks.append(Scratch())
    try:
        yield blocks[-1]
    finally:
        done = blocks.pop()
        done.clear()
        if blocks:
            blocks[-1].paths.update(done.kept)


def discard(table: DataFrame) -> None:
    """Delete a table of ``durable`` that nothing reads any more."""
    path = table._durable_path
    _delete(table.sparkSession, path)
    for block in getattr(_open, "blocks", ()):
        block.paths.pop(path, None)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Used where a value depends on the physical layout (partition numbers) and where many
    jobs read the same rows: a lost executor then re-reads the written rows instead of
    recomputing them, columns are pruned, and the size of the table is known.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._durable_path = path
    for block in getattr(_open, "blocks", ())[-1:]:
        block.paths[path] = df.sparkSession
    return table
