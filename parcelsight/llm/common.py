"""Helpers shared by the operators: shared folders, stored tables, worker paths, null-safe columns."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space of the contracts: space and the ASCII control blanks.
BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from the place the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, not yet made, below the one that driver and executors share.

    The cluster names that folder in spark.checkpoint.dir. Only a local session without the
    setting (tests) gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = Path(tempfile.mkdtemp(prefix="llm-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends there."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1_024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, which bounds what a worker holds besides them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def released(batches: Iterator[pa.RecordBatch], own: Callable[[], None] = lambda: None) -> Iterator[pa.RecordBatch]:
    """The same batches; after the last, `own` lets go of what the task kept, and what the process
    holds unused goes back to the machine. A Python worker outlives its tasks, so it
    would add up what each of them needed at most."""
    try:
        yield from batches
    finally:
        own()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # other C libraries return memory by themselves
            ctypes.CDLL(None).malloc_trim(0)


def whole_row(df: DataFrame) -> Column:
    """All columns of a table as one, `_row`, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an integer id written as text, as a long. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))
