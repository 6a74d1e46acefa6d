"""Landing folders of one-object files: listed, picked and read in tasks.

The listing is a Spark job per folder level, so no list of files is ever held by the driver, and files of
zero bytes are rows like all others. What earlier runs took is removed by a join before any file is
opened. Files are opened through Arrow's file systems (local, hdfs, s3, gs and what else they know).
"""

from __future__ import annotations

import contextlib
import os
import random
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook import schema, session
from tallybook.sources.event_files import file_key, select_event_files

LISTING = "source_key string, size bigint, modified timestamp"
_ENTRY = "source_key string, is_folder boolean, size bigint, modified timestamp"
_BATCH = 4096  # listed entries or contents sent at once
_READ_BYTES = 4 << 20  # contents sent at once, and those of the files opened last
_OPEN_AT_ONCE = 16  # files a task reads at the same time from a remote store
_FILES_A_TASK = 10_000
_LOCAL = arrow_fs.LocalFileSystem()
_SPENT, _CLAIMED = ".spent", ".claimed"  # below a landing; hidden names are not listed


def is_local(uri: str) -> bool:
    """Whether a folder or file key lies on local storage, whose disk holds a block and a node per file."""
    return uri.startswith(("/", "file:")) or urlsplit(uri).scheme in ("", "file")


def _open(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and inner path of a folder or file key; a plain path is local."""
    if is_local(uri):
        return _LOCAL, uri.removeprefix("file:")
    return arrow_fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _children(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """Key, whether a folder, size and modification time in microseconds; hidden names are skipped."""
    files, path = _open(folder)
    if isinstance(files, arrow_fs.LocalFileSystem):
        with os.scandir(path) as entries:
            for e in entries:
                if e.name[0] not in "._":
                    s = e.stat()
                    yield f"{folder}/{e.name}", e.is_dir(), s.st_size, s.st_mtime_ns // 1000
        return
    for info in files.get_file_info(arrow_fs.FileSelector(path)):
        if info.base_name[0] not in "._":
            is_folder = info.type == arrow_fs.FileType.Directory
            yield (
                f"{folder}/{info.base_name}", is_folder, info.size or 0, (info.mtime_ns or 0) // 1000
            )


def _entry_batch(rows: list[tuple[str, bool, int, int]]) -> pa.RecordBatch:
    keys, folders, sizes, times = (list(c) for c in zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.string()),
            pa.array(folders, pa.bool_()),
            pa.array(sizes, pa.int64()),
            pa.array(times, pa.timestamp("us", "UTC")),
        ],
        ["source_key", "is_folder", "size", "modified"],
    )


def _list_batches(batches):
    for batch in batches:
        for folder in batch.column("source_key").to_pylist():
            rows = []
            for entry in _children(folder):
                rows.append(entry)
                if len(rows) == _BATCH:
                    yield _entry_batch(rows)
                    rows = []
            yield _entry_batch(rows)


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """source_key, size and modified of every file at any depth, those of zero bytes included.

    One job per level of folders; each task lists some folders of that level. The driver learns only
    whether there is a further level. Names that start with a dot or underscore are skipped.
    """
    session.ship_code(spark)
    root = path.rstrip("/")
    if not urlsplit(root).scheme:
        root = f"file:{os.path.abspath(root)}"
    level = spark.createDataFrame([(root,)], "source_key string")
    files: DataFrame | None = None
    while True:
        staged = session.scratch_path(spark, "listing")
        level.mapInArrow(_list_batches, _ENTRY).write.parquet(staged)
        found = spark.read.schema(_ENTRY).parquet(staged)
        here = found.where("NOT is_folder").drop("is_folder")
        files = here if files is None else files.unionAll(here)
        folders = found.where("is_folder").select("source_key")
        if folders.isEmpty():
            return files
        level = folders.repartition(spark.sparkContext.defaultParallelism * 4)


def untaken(listing: DataFrame, taken: DataFrame | None) -> DataFrame:
    """Files that no earlier run took; one that was written anew since then counts as new.

    Both sides are spread by the whole file key, so no folder or day crowds a task.
    """
    if taken is None:
        return listing
    return listing.join(taken.select(listing.columns), listing.columns, "left_anti")


def _read_local(path: str) -> bytes:
    """A whole small file; the bare calls cost half of what a file object does."""
    file = os.open(path, os.O_RDONLY)
    try:
        parts = []
        while part := os.read(file, 1 << 16):
            parts.append(part)
        return b"".join(parts)
    finally:
        os.close(file)


def _write_local(
    path: str, data: bytes, modified: int | None = None, spare: str | None = None
) -> None:
    """A whole small file, out of a spare one if there is one, with its time in microseconds if given."""
    if spare is not None:
        with contextlib.suppress(OSError):  # a repeated task's file is there already
            os.link(spare, path)
        os.unlink(spare)
    file = os.open(path, os.O_WRONLY | os.O_CREAT, 0o666)
    try:
        size = len(data)
        while data:
            data = data[os.write(file, data) :]
        os.ftruncate(file, size)
        if modified is not None:
            os.utime(file, ns=(modified * 1000, modified * 1000))
    finally:
        os.close(file)


def _content(key: str) -> bytes:
    files, path = _open(key)
    if isinstance(files, arrow_fs.LocalFileSystem):
        return _read_local(path)
    with files.open_input_stream(path) as stream:
        return stream.read()


def _text_batch(keys: list[str], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array(texts, pa.string())], ["source_key", "value"]
    )


def _read_batches(batches):
    """Local files one after the other, as threads would only wait for each other; remote ones together.

    Rows go on in large batches, since each batch costs Spark about as much as dozens of checked rows.
    """
    with ThreadPoolExecutor(_OPEN_AT_ONCE) as pool:
        for batch in batches:
            keys = batch.column("source_key").to_pylist()
            texts, first, size = [], 0, 0
            for low in range(0, len(keys), 4 * _OPEN_AT_ONCE):
                some = keys[low : low + 4 * _OPEN_AT_ONCE]
                for content in map(_content, some) if is_local(some[0]) else pool.map(_content, some):
                    texts.append(content.decode("utf-8", "replace"))
                    size += len(content)
                if size >= _READ_BYTES or len(texts) >= _BATCH:
                    yield _text_batch(keys[first : first + len(texts)], texts)
                    texts, first, size = [], first + len(texts), 0
            if texts:
                yield _text_batch(keys[first:], texts)


def read_objects(files: DataFrame, n_files: int) -> DataFrame:
    """Raw (source_key, value) rows of one-object files, one per listed file.

    Files are dealt over tasks by ranges of their keys, so a task stays within few folders. From a remote
    store it opens some at a time, as waiting takes most of the time of a small file there. A file that is
    gone since it was listed fails the run.
    """
    spark = files.sparkSession
    session.ship_code(spark)
    if n_files == 0:
        return spark.createDataFrame([], "source_key string, value string")
    cores = spark.sparkContext.defaultParallelism
    tasks = min(n_files, max(cores * 2, n_files // _FILES_A_TASK))
    return files.select("source_key").repartitionByRange(tasks, "source_key").mapInArrow(
        _read_batches, "source_key string, value string"
    )


def read_lines(files: DataFrame) -> DataFrame:
    """Raw rows of JSON-lines files; a line is a row. Such files are large and few.

    Spark's own reader splits them, and like Spark's index the driver holds their paths.
    """
    spark = files.sparkSession
    paths = [r["source_key"] for r in files.select("source_key").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "source_key string, value string")
    return spark.read.text(paths).select(file_key().alias("source_key"), "value")


def select_landed(
    listing: DataFrame, layout: str, pattern: str | None = schema.EVENT_FILE_PATTERN
) -> DataFrame:
    """The listed files that belong to the log; only one-object files have a name form."""
    if layout not in ("objects", "lines"):
        raise ValueError(f"unknown layout {layout!r}; use 'objects' or 'lines'")
    if layout == "lines" or pattern is None:
        return listing
    return select_event_files(listing, pattern=pattern)


def _write_batches(batches, root: str):
    files, _ = _open(root)
    local = is_local(root)
    spares = _Spares(_open(root)[1]) if local else None
    made: set[str] = set()
    for batch in batches:
        names, values = (batch.column(c).to_pylist() for c in ("name", "value"))
        times = [None] * len(names)
        if "modified" in batch.schema.names:
            times = batch.column("modified").cast(pa.int64()).to_pylist()
        for name, value, modified in zip(names, values, times, strict=True):
            _, path = _open(f"{root}/{name}")
            folder = os.path.dirname(path)
            if folder not in made:
                files.create_dir(folder)
                made.add(folder)
            data = (value or "").encode()
            if local:
                _write_local(path, data, modified, spares.take())
                continue
            with files.open_output_stream(path) as out:
                out.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])
    if local:
        spares.give_back()


def _by_folder(rows: DataFrame) -> DataFrame:
    folder = F.regexp_extract("name", "(?s)^(.*)/", 1)
    kept = [c for c in ("name", "value", "modified") if c in rows.columns]
    return rows.select(*kept, folder.alias("folder")).hint("rebalance", "folder")


def write_objects(rows: DataFrame, path: str) -> int:
    """Write (name, value) rows as one file each below a folder; returns how many were written.

    Names may hold folders. A null value makes an empty file; a repeated task writes the same files
    again, so names must differ. Rows are rebalanced by folder, as tasks that make files in one folder
    wait for each other; a folder with very many files is still split over tasks. A column `modified`
    gives the files their times, on local storage alone; there the folder is made even for no rows.
    """
    spark = rows.sparkSession
    session.ship_code(spark)
    root = path if urlsplit(path).scheme else f"file:{os.path.abspath(path)}"
    if is_local(root):
        os.makedirs(_open(root)[1], exist_ok=True)
    elif "modified" in rows.columns:
        raise ValueError(f"files below {root} get their times from the store")
    written = _by_folder(rows).mapInArrow(partial(_write_batches, root=root), "n bigint")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def spend_landing(path: str) -> None:
    """Set aside all files below a local folder: no listing finds them, and those written there next take them over.

    That bounds a landing that passes through a disk in parts. Deleting the files would, too, but on ext4
    without a journal and with `discard` a written file took 1.5 ms to delete, and the next one up to
    1.2 ms to make; taking one over takes 0.1 ms. Only entries of the folder itself are moved.
    """
    if not is_local(path):
        raise ValueError(f"{path} is not on local storage")
    root = _open(path.rstrip("/"))[1]
    pool = f"{root}/{_SPENT}"
    loose = f"{pool}/{uuid.uuid4().hex}"
    os.makedirs(pool, exist_ok=True)
    with os.scandir(root) as entries:
        for e in list(entries):
            if e.name[0] in "._":
                continue
            if e.is_dir():
                os.rename(e.path, f"{pool}/{uuid.uuid4().hex}")
            else:
                os.makedirs(loose, exist_ok=True)
                os.rename(e.path, f"{loose}/{e.name}")


class _Spares:
    """Spent files for one task to take over. It claims them by folder, as a rename succeeds for one task only.

    What a failed task had claimed is left unused: one of its files may be in place already.
    """

    def __init__(self, root: str):
        self._root = root
        pool = f"{root}/{_SPENT}"
        self._folders = os.listdir(pool) if os.path.isdir(pool) else []
        random.shuffle(self._folders)
        self._claimed = None
        self._files: list[str] = []

    def take(self) -> str | None:
        while not self._files and self._folders:
            self.give_back()
            self._claim(self._folders.pop())
        return self._files.pop() if self._files else None

    def _claim(self, name: str) -> None:
        claimed = f"{self._root}/{_CLAIMED}-{uuid.uuid4().hex}"
        try:
            os.rename(f"{self._root}/{_SPENT}/{name}", claimed)
        except FileNotFoundError:  # another task has it
            return
        self._claimed = claimed
        self._files = [f"{d}/{n}" for d, _, names in os.walk(claimed) for n in names]

    def give_back(self) -> None:
        """Put back what is left of the claimed folder."""
        if self._files:
            os.rename(self._claimed, f"{self._root}/{_SPENT}/{uuid.uuid4().hex}")
        elif self._claimed:
            for folder, _, _ in os.walk(self._claimed, topdown=False):
                os.rmdir(folder)
        self._claimed, self._files = None, []
