"""Tables the registered queries share, and the register itself."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybook import session

Query = Callable[[SparkSession, str], DataFrame]

_REGISTER: dict[str, tuple[Query, str | None]] = {}

# The generic `events` table seen as visit events. One text serves both engines.
VISIT_EVENTS = """
SELECT event_id,
 CASE event_type WHEN 'purchase' THEN 'pass-qc' WHEN 'error' THEN 'not-pass-qc'
                 WHEN 'view' THEN 'delete' ELSE 'submit' END AS action,
 CASE user_id % 3 WHEN 0 THEN 'adrc' WHEN 1 THEN 'dvcid' ELSE 'leads' END AS study,
 CAST(user_id % 40 + 1 AS INT) AS pipeline_adcid,
 CONCAT(CASE WHEN user_id % 10 = 7 THEN 'sandbox-' ELSE 'ingest-' END,
        CASE WHEN event_id % 4 = 0 THEN 'dicom' ELSE 'form' END,
        CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN '-dvcid' ELSE '-leads' END) AS project_label,
 CONCAT('center', LPAD(CAST(user_id % 12 AS VARCHAR(4)), 2, '0')) AS center_label,
 CASE WHEN event_id % 4 = 0 THEN 'dicom-scheduler' ELSE 'form-scheduler' END AS gear_name,
 CAST(110000 + user_id AS VARCHAR(10)) AS ptid,
 CAST(CAST(DATE_TRUNC('week', ts) AS DATE) AS VARCHAR(10)) AS visit_date,
 CASE WHEN user_id % 6 = 0 THEN NULL
      ELSE LPAD(CAST(EXTRACT(WEEK FROM ts) AS VARCHAR(4)), 2, '0') END AS visit_number,
 CASE WHEN event_id % 4 = 0 THEN 'dicom' ELSE 'form' END AS datatype,
 CASE WHEN event_id % 4 = 0 THEN NULL
      ELSE CASE user_id % 4 WHEN 0 THEN 'UDS' WHEN 1 THEN 'FTLD' WHEN 2 THEN 'LBD' ELSE 'MDS' END
      END AS module,
 CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'I' WHEN 2 THEN 'F' WHEN 3 THEN 'M'
                   ELSE 'A' END AS packet,
 ts AS timestamp
FROM {events}
"""

# Compact timestamp as written in event file names.
NAME_TIME = """CONCAT(REPLACE(SUBSTR(CAST({ts} AS STRING), 1, 10), '-', ''), '-',
                      REPLACE(SUBSTR(CAST({ts} AS STRING), 12, 8), ':', ''))"""

_SOURCE_KEY = f"""
CONCAT('prod/log-', action, '-', {NAME_TIME.format(ts="timestamp")}, '-',
       CAST(pipeline_adcid AS STRING), '-', project_label, '-', ptid, '-', visit_date, '.json')
"""

# One file per event, some with names that are not event files.
LISTING = f"""
SELECT event_id, action, pipeline_adcid, project_label, ptid, visit_date, timestamp AS modified,
 CAST(event_id % 9 * 100 AS BIGINT) AS size,
 CASE event_id % 7
   WHEN 0 THEN REPLACE({_SOURCE_KEY}, '.json', '.txt')
   WHEN 1 THEN REPLACE({_SOURCE_KEY}, 'log-', 'audit-')
   ELSE {_SOURCE_KEY} END AS source_key
FROM {{visit_events}}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VISIT_EVENTS, events=table(spark, sf_dir, "events"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LISTING, visit_events=visit_events(spark, sf_dir))


def _with_tables(sql: str, extra: dict[str, str]) -> str:
    """Put the shared tables an SQL text uses in front of it."""
    shared = {
        "visit_events": VISIT_EVENTS.format(events="events"),
        "listing": LISTING.format(visit_events="visit_events"),
        **extra,
    }
    used: list[str] = []

    def need(text: str, inside: str | None = None) -> None:
        for name, body in shared.items():
            if name != inside and name not in used and re.search(rf"\b{name}\b", text):
                need(body, name)
                used.append(name)

    need(sql)
    if not used:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({shared[n]})" for n in used) + "\n" + sql


def query(name: str, sql: str | None = None, **tables: str):
    """Register a query, with the SQL that checks it and helper tables for that SQL."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.configure(spark), sf_dir)

        if name in _REGISTER:
            raise ValueError(f"query {name} is registered twice")
        _REGISTER[name] = (run, _with_tables(sql, tables) if sql else None)
        return run

    return register


def registry() -> dict[str, tuple[Query, str | None]]:
    return dict(_REGISTER)
