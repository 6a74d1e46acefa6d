"""Tables in the shared scratch folder, and Python stages whose code travels with them."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybook import session

_SHIPPED: set[str] = set()


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a frame in the cluster's shared folder and read it back.

    Expensive stages then run once, and a lost executor costs no more than its tasks.
    """
    spark = df.sparkSession
    path = session.scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="run-tallybook-"), "tallybook_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors.

    Spark keeps its Python workers; each gives its freed memory back after a task, so that idle
    ones hold little.
    """
    ship_code(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)
