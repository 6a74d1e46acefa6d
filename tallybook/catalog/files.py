"""Listings, reads and writes of files, checked by reading back."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tallybook import schema, session
from tallybook.catalog.base import listing, query, table
from tallybook.sources import event_files, reports

_PATTERN = schema.EVENT_FILE_PATTERN
_SELECTED = f"SELECT * FROM listing WHERE regexp_matches(source_key, '{_PATTERN}')"


_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@query("src_filename_select", _SELECTED)
def src_filename_select(spark, sf_dir):
    return event_files.select_event_files(listing(spark, sf_dir), prefix="prod/")


@query(
    "src_filename_meta",
    f"""SELECT event_id, source_key, action AS name_action,
        date_trunc('second', modified) AS name_time, pipeline_adcid AS name_adcid,
        project_label AS name_project, ptid AS name_ptid, visit_date AS name_visit_date
        FROM ({_SELECTED}) s""",
)
def src_filename_meta(spark, sf_dir):
    named = event_files.filename_fields(
        event_files.select_event_files(listing(spark, sf_dir))
    )
    return named.select(
        "event_id",
        "source_key",
        *[c for c in named.columns if c.startswith("name_")],
    )


@query(
    "src_filename_prune",
    f"""SELECT event_id, source_key FROM ({_SELECTED}) s WHERE action = 'pass-qc'
        AND CAST(modified AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
        AND project_label = 'ingest-form-dvcid'""",
)
def src_filename_prune(spark, sf_dir):
    picked = event_files.select_by_name(
        listing(spark, sf_dir),
        action="pass-qc",
        month=date(2024, 1, 1),
        project="ingest-form-dvcid",
    )
    return picked.select("event_id", "source_key")


@query(
    "src_filename_incremental",
    f"""SELECT event_id, source_key FROM ({_SELECTED}) s
        WHERE date_trunc('second', modified) > TIMESTAMP '2024-01-15 10:00:00'""",
)
def src_filename_incremental(spark, sf_dir):
    fresh = event_files.newer_by_name(listing(spark, sf_dir), datetime(2024, 1, 15, 10))
    return fresh.select("event_id", "source_key")


@query(
    "src_modified_since",
    """SELECT event_id, source_key, size, modified FROM listing
       WHERE modified >= TIMESTAMP '2024-01-20 00:00:00'""",
)
def src_modified_since(spark, sf_dir):
    fresh = event_files.modified_since(
        listing(spark, sf_dir), datetime(2024, 1, 20), prefix="prod/"
    )
    return fresh.select("event_id", "source_key", "size", "modified")


# --- round trips ----------------------------------------------------------------------


@query("csv_ingest", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_ingest(spark, sf_dir):
    path = session.scratch_path(spark, "csv")
    customers = table(spark, sf_dir, "customer")
    reports.write_format(customers, path, "csv")
    # one line per row here, so large files may be split
    return reports.read_csv_report(spark, path, customers.schema, multi_line=False)


@query("csv_append", "SELECT * FROM customer")
def csv_append(spark, sf_dir):
    source = session.scratch_path(spark, "report")
    target = session.scratch_path(spark, "table")
    customers = table(spark, sf_dir, "customer")
    positive = F.col("c_acctbal") >= 0
    for name, part, mode in (("a", positive, "overwrite"), ("b", ~positive, "append")):
        reports.write_format(customers.filter(part), f"{source}/{name}", "csv")
        new = reports.read_csv_report(
            spark, f"{source}/{name}", customers.schema, multi_line=False
        )
        reports.load_report(new, target, mode)
    return spark.read.parquet(target)


@query("json_roundtrip", "SELECT * FROM events")
def json_roundtrip(spark, sf_dir):
    path = session.scratch_path(spark, "json")
    events = table(spark, sf_dir, "events")
    reports.write_format(events, path, "json")
    return reports.read_json(spark, path, events.schema, multi_line=False)


@query(
    "json_since",
    "SELECT * FROM events WHERE event_id % 2 = 1",
)
def json_since(spark, sf_dir):
    """JSON payloads landed in two steps; the second load opens only the newer files."""
    path = session.scratch_path(spark, "payloads")
    events = table(spark, sf_dir, "events")
    events.where("event_id % 2 = 0").write.option("timestampNTZFormat", _MICROSECONDS).json(path)
    modified = F.max("_metadata.file_modification_time")
    last = spark.read.format("binaryFile").load(path).agg(modified).first()[0]
    time.sleep(1.1)  # file times may be whole seconds
    events.where("event_id % 2 = 1").write.mode("append").option(
        "timestampNTZFormat", _MICROSECONDS
    ).json(path)
    since = last + timedelta(milliseconds=1)
    return reports.read_json_since(spark, path, events.schema, since, multi_line=False)


@query("format_roundtrip", "SELECT * FROM supplier")
def format_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    declared = rows.schema
    for fmt in reports.FORMATS:
        path = session.scratch_path(spark, fmt)
        reports.write_format(rows, path, fmt)
        reader = spark.read.schema(declared).format(fmt)
        rows = (reader.option("header", "true") if fmt == "csv" else reader).load(path)
    return rows


@query("parquet_codecs", "SELECT * FROM part")
def parquet_codecs(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    declared = rows.schema
    for codec in reports.CODECS:
        path = session.scratch_path(spark, codec)
        reports.write_parquet(rows, path, codec, declared)
        rows = spark.read.parquet(path)
    return rows


@query("append_checked", "SELECT * FROM orders")
def append_checked(spark, sf_dir):
    path = session.scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") == "F"
    reports.append_checked(orders.filter(done), path)
    reports.append_checked(orders.filter(~done).select(*reversed(orders.columns)), path)
    return spark.read.parquet(path)


@query(
    "date_partitioned_sink",
    """SELECT *, strftime(ts, '%Y') AS year,
       strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events""",
)
def date_partitioned_sink(spark, sf_dir):
    path = session.scratch_path(spark, "by-date")
    events = table(spark, sf_dir, "events")
    reports.write_by_date(events, F.col("ts"), path)
    parts = "year string, month string, day string"
    declared = ", ".join(f"`{c}` {kind}" for c, kind in events.dtypes)
    return spark.read.schema(f"{declared}, {parts}").parquet(path)


@query(
    "report_locations",
    """SELECT e.environment, n.* FROM nation n,
       (SELECT UNNEST(['dev', 'staging', 'prod']) AS environment) e
       WHERE e.environment = 'prod' OR n.n_regionkey < 2""",
)
def report_locations(spark, sf_dir):
    """One report per environment, each below its own folder of the same root."""
    root, nation = session.scratch_path(spark, "reports"), table(spark, sf_dir, "nation")
    rows = None
    for environment in reports.ENVIRONMENTS:
        part = nation if environment == "prod" else nation.where("n_regionkey < 2")
        reports.load_report(part, f"{root}/nation.parquet/", environment=environment)
        back = spark.read.parquet(reports.report_path(root, environment, "nation.parquet"))
        back = back.select(F.lit(environment).alias("environment"), "*")
        rows = back if rows is None else rows.unionByName(back)
    return rows
