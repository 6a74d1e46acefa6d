"""CSV reports, parquet/JSON tables, and checked writes."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tallybook.operators.validation import SchemaMismatch, require_schema
from tallybook.sources import folders

# --- fixed values: codecs, formats, modes, environments ---------------------------
CODECS = ("snappy", "gzip", "lz4", "zstd", "uncompressed")
FORMATS = ("parquet", "json", "csv")
MODES = ("overwrite", "append")
ENVIRONMENTS = ("dev", "staging", "prod")

_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_SPARK_CODEC = {"lz4": "lz4_raw"}


def read_csv_report(
    spark: SparkSession,
    path: str,
    declared: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """A CSV report with a header. Types are inferred unless declared.

    Inference reads the files twice; declare the schema for large reports. Quoted
    line breaks need whole-file reads; multi_line=False splits large files instead.
    """
    reader = spark.read.option("header", "true").option("multiLine", multi_line)
    reader = reader.option("quote", '"').option("escape", '"')
    if declared is not None:
        return reader.schema(declared).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def read_json(spark: SparkSession, path: str, declared=None, multi_line: bool = True) -> DataFrame:
    """JSON objects or arrays of objects, one row per object."""
    reader = spark.read.option("multiLine", multi_line)
    if declared is not None:
        reader = reader.schema(declared)
    return reader.json(path)


def read_json_since(
    spark: SparkSession,
    path: str,
    declared: T.StructType | str,
    since: datetime | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """JSON files modified at or after a time; older files are not opened.

    The schema is declared, because inference would open every file.
    """
    rows = read_json(spark, path, declared, multi_line)
    if since is None:
        return rows
    changed = F.col("_metadata.file_modification_time")
    bound = F.lit(str(since)).cast("timestamp")
    return rows.filter(changed >= bound).select(*rows.columns)


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "snappy",
    declared: T.StructType | None = None,
    mode: str = "overwrite",
) -> None:
    """Write with a codec; with a declared schema, columns and types must match it."""
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}; use one of {CODECS}")
    if declared is not None:
        require_schema(df, declared)
    writer = df.write.mode(mode).option("compression", _SPARK_CODEC.get(codec, codec))
    writer.parquet(path)


def append_checked(df: DataFrame, path: str, codec: str = "snappy") -> None:
    """Append rows to a parquet table that has the same columns and types.

    Columns are matched by name. New files are added and old ones are not rewritten.
    """
    spark = df.sparkSession
    if folders.exists(spark, path):
        existing = spark.read.parquet(path)
        require_schema(df, existing.schema)
        df = df.select(existing.columns)
    write_parquet(df, path, codec, mode="append")


def load_report(
    new: DataFrame, path: str, mode: str = "overwrite", environment: str | None = None
) -> int:
    """Write report rows over or after what is there; returns the new rows' count.

    With an environment, ``path`` is ``root/name.parquet`` and the table goes to
    ``root/environment/name.parquet``.
    """
    if environment is not None:
        root, _, name = path.rstrip("/").rpartition("/")
        path = report_path(root, environment, name)
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    spark = new.sparkSession
    if mode == "append" and folders.exists(spark, path):
        existing = spark.read.parquet(path)
        if existing.columns != new.columns:
            raise SchemaMismatch(f"existing columns {existing.columns}, new {new.columns}")
        require_schema(new, existing.schema)
    seen = Observation("report_rows")
    counted = new.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).parquet(path)
    return seen.get["rows"]


def write_format(df: DataFrame, path: str, fmt: str) -> None:
    """Write as parquet, json or csv (csv with header)."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; use one of {FORMATS}")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt != "parquet":  # text keeps milliseconds only, unless told
        writer = writer.option("timestampFormat", f"{_MICROSECONDS}XXX")
        writer = writer.option("timestampNTZFormat", _MICROSECONDS)
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.save(path)


def write_by_date(df: DataFrame, when: Column, path: str) -> None:
    """Partition output by year, month and day of a timestamp.

    Rows are first rebalanced by day, so each day gets few files and a very large
    day is still split over several tasks.
    """
    dated = df.withColumns(
        {
            "year": F.date_format(when, "yyyy"),
            "month": F.date_format(when, "MM"),
            "day": F.date_format(when, "dd"),
        }
    )
    parts = ("year", "month", "day")
    dated.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(path)


def report_path(root: str, environment: str, name: str) -> str:
    """Path of a report's table below a root folder, kept apart by environment."""
    problems = []
    if environment not in ENVIRONMENTS:
        problems.append(f"environment must be one of {ENVIRONMENTS}")
    if not re.fullmatch(r"[^/].*\.parquet/*", name):
        problems.append("name must be a relative path ending in .parquet")
    if problems:
        raise ValueError("; ".join(problems))
    return "/".join(part.rstrip("/") for part in (root, environment, name))
