"""Event logs: folders of JSON event files, their names, and their content.

Two layouts are read. In 'objects' every file holds one JSON object, whose file name
repeats its main fields. In 'lines' every line is one object; that is the layout for
volumes at which one file per event would make listing the bottleneck.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallybook import schema

# --- fixed values: fields of an event file name ---------------------------------
NAME_FIELDS_PATTERN = (
    r"log-(submit|pass-qc|not-pass-qc|delete)"
    r"-(\d{8}-\d{6})-(\d+)-([\w\-]+)-([\w]+)-(\d{4}-\d{2}-\d{2})\.json$"
)
NAME_TIME_FORMAT = "yyyyMMdd-HHmmss"

_UNICODE = "(?U)"


def name_matches(key: Column, pattern: str = schema.EVENT_FILE_PATTERN) -> Column:
    return key.rlike(_UNICODE + pattern)


def file_key() -> Column:
    """The scanned file's path as plain text; Spark reports it percent-encoded."""
    return _plain_path(F.col("_metadata.file_path"))


def _plain_path(encoded: Column) -> Column:
    plain = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """source_key, size and modified of every non-empty file at any depth.

    Content is not read: the scan keeps only the file metadata columns.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        file_key().alias("source_key"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def select_event_files(
    listing: DataFrame, prefix: str = "", pattern: str = schema.EVENT_FILE_PATTERN
) -> DataFrame:
    """Listing rows under a prefix whose key has the event-file form."""
    if prefix:
        listing = listing.filter(F.col("source_key").startswith(prefix))
    return listing.filter(name_matches(F.col("source_key"), pattern))


def filename_fields(listing: DataFrame) -> DataFrame:
    """Add the fields written in each event file name.

    For pruning only: a ptid in a name may differ from the one in the content.
    """

    def part(group: int) -> Column:
        return F.regexp_extract("source_key", _UNICODE + NAME_FIELDS_PATTERN, group)

    return listing.withColumns(
        {
            "name_action": part(1),
            "name_time": F.to_timestamp_ntz(part(2), F.lit(NAME_TIME_FORMAT)),
            "name_adcid": part(3).try_cast("int"),
            "name_project": part(4),
            "name_ptid": part(5),
            "name_visit_date": part(6),
        }
    )


def select_by_name(
    listing: DataFrame,
    action: str | None = None,
    on_date: date | None = None,
    month: date | None = None,
    adcid: int | None = None,
    project: str | None = None,
    ptid: str | None = None,
    visit_date: str | None = None,
) -> DataFrame:
    """Event files picked by name alone; every given condition must hold."""
    named = filename_fields(select_event_files(listing))
    day = F.to_date("name_time")
    wanted = {
        "action": (F.col("name_action"), action),
        "on_date": (day, on_date),
        "month": (F.trunc(day, "month"), month.replace(day=1) if month else None),
        "adcid": (F.col("name_adcid"), adcid),
        "project": (F.col("name_project"), project),
        "ptid": (F.col("name_ptid"), ptid),
        "visit_date": (F.col("name_visit_date"), visit_date),
    }
    for column, value in wanted.values():
        if value is not None:
            named = named.filter(column == F.lit(value))
    return named


def newer_by_name(listing: DataFrame, last: datetime) -> DataFrame:
    """Event files named later than the last processed second."""
    named = filename_fields(select_event_files(listing))
    return named.filter(F.col("name_time") > F.lit(str(last)).cast("timestamp_ntz"))


def modified_since(
    listing: DataFrame,
    since: datetime | None = None,
    prefix: str = "",
    max_keys: int | None = None,
) -> DataFrame:
    """Files under a prefix modified at or after a time.

    max_keys, when asked for, bounds the listing in key order before the time filter.
    """
    if prefix:
        listing = listing.filter(F.col("source_key").startswith(prefix))
    if max_keys is not None:
        listing = listing.orderBy("source_key").limit(max_keys)
    if since is not None:
        kind = listing.schema["modified"].dataType
        listing = listing.filter(F.col("modified") >= F.lit(str(since)).cast(kind))
    return listing


def read_event_files(
    spark: SparkSession,
    path: str,
    layout: str = "objects",
    pattern: str | None = schema.EVENT_FILE_PATTERN,
    named_from: datetime | None = None,
    with_empty: bool = True,
) -> DataFrame:
    """Raw (source_key, value) rows of an event log.

    The pattern and `named_from` act on file metadata, so files they exclude are
    dropped while planning and never opened. `named_from` keeps names at or after
    that second. One-object files of zero bytes are rows with empty text, which no rule
    takes; `with_empty=False` saves their listing.
    """
    if layout == "objects":
        reader = spark.read.option("wholetext", "true")
    elif layout == "lines":
        reader, pattern = spark.read, None
    else:
        raise ValueError(f"unknown layout {layout!r}; use 'objects' or 'lines'")
    rows = reader.option("recursiveFileLookup", "true").text(path)
    key = file_key()
    if pattern is not None:
        rows = rows.filter(name_matches(key, pattern))
    if named_from is not None:
        rows = rows.filter(_named_since(F.col("_metadata.file_name"), named_from))
    rows = rows.select(key.alias("source_key"), "value")
    if layout == "lines" or not with_empty:
        return rows
    empty = empty_event_files(spark, path, pattern)
    if named_from is not None:
        empty = empty.filter(_named_since(F.col("source_key"), named_from))
    return rows.unionAll(empty)


def _named_since(name: Column, moment: datetime) -> Column:
    stamp = F.regexp_extract(name, r"-(\d{8}-\d{6})-[^/]*\z", 1)
    return stamp >= moment.strftime("%Y%m%d-%H%M%S")


def empty_event_files(
    spark: SparkSession, path: str, pattern: str | None = schema.EVENT_FILE_PATTERN
) -> DataFrame:
    """Raw rows, with empty text, for event files of zero bytes.

    Spark's scans skip such files silently; here they are what the file index lists
    and the scan does not return. The driver holds that index, as Spark itself does; a log
    too long to list belongs in the lines layout.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    index = spark.createDataFrame([(f,) for f in files.inputFiles()], "value string")
    indexed = index.select(_plain_path(F.col("value")).alias("source_key"))
    if pattern is not None:
        indexed = select_event_files(indexed, pattern=pattern)
    found = list_files(spark, path).select("source_key")
    missing = indexed.join(found, "source_key", "left_anti")
    return missing.select("source_key", F.lit("").alias("value"))
