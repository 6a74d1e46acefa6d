"""The incremental run as a stream over a folder of event files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook import schema
from tallybook.plans.incremental import run_incremental
from tallybook.sources import event_files, folders
from tallybook.sources.ledger_store import MARKS, LedgerStore


def read_event_stream(
    spark: SparkSession,
    path: str,
    layout: str = "objects",
    pattern: str | None = schema.EVENT_FILE_PATTERN,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New event files as raw (source_key, value) rows.

    With `archive`, files of finished batches are moved there, which keeps the listing
    of the landing folder short.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if layout == "objects":
        reader = reader.option("wholetext", "true")
    elif layout == "lines":
        pattern = None
    else:
        raise ValueError(f"unknown layout {layout!r}; use 'objects' or 'lines'")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.load(path).select(event_files.file_key().alias("source_key"), "value")
    if pattern is None:
        return rows
    return rows.filter(event_files.name_matches(F.col("source_key"), pattern))


class StreamMarks:
    """The watermarks one stream run works with, kept until the run completes.

    Files arrive in any order, so a later batch may hold rows older than an earlier
    one. All batches of a run, also after a crash, therefore use the watermarks from
    its start; the next run takes fresh ones.
    """

    def __init__(self, store: LedgerStore):
        self.store = store
        self.spark = store.spark
        self.folder = f"{store.root}/stream"
        names = folders.children(self.spark, self.folder)
        done = [int(n.removeprefix("done-")) for n in names if n.startswith("done-")]
        self.number = max(done, default=0) + 1
        self.path = f"{self.folder}/marks-{self.number}"

    def frame(self) -> DataFrame:
        if not folders.exists(self.spark, f"{self.path}/_SUCCESS"):
            self.store.marks().write.mode("overwrite").parquet(self.path)
        return self.spark.read.schema(MARKS).parquet(self.path)

    def complete(self) -> None:
        folders.touch(self.spark, f"{self.folder}/done-{self.number}")


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """A name kept in the checkpoint folder; a new or replaced checkpoint is a new stream."""
    folder = f"{checkpoint}/stream-identity"
    if not folders.children(spark, folder):
        folders.touch(spark, f"{folder}/{uuid.uuid4().hex}")
    return folders.children(spark, folder)[0]


def extend_ledgers(
    raw_stream: DataFrame, store: LedgerStore, checkpoint: str
) -> StreamingQuery:
    """Process everything that is there now, batch by batch, then stop.

    Each batch is the store run named after it and the stream, so a replayed batch adds
    nothing, and streams with checkpoints of their own never share a name. Its quarantined
    and late rows are kept beside the ledgers. Returns the finished query.
    """
    run = StreamMarks(store)
    marks = run.frame()
    stream = stream_identity(store.spark, checkpoint)

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{stream}-batch-{batch_id:09d}"
        result = run_incremental(batch, store, run_id, marks)
        if result.status != "ok":
            raise RuntimeError(f"batch {batch_id}: {result.status}")
        result.keep(store)
        result.discard()

    query = (
        raw_stream.writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    run.complete()
    return query
