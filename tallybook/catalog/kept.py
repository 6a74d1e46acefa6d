"""Results that are kept up as events arrive: visit states of a stream, report counts of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook import schema, session
from tallybook.catalog.base import query, visit_events
from tallybook.operators import validation
from tallybook.plans import incremental
from tallybook.plans.report_views import ColumnProfiles, ReportCounts
from tallybook.sources.ledger_store import LedgerStore
from tallybook.streaming import visit_state

_KEY = "ptid, visit_date, visit_number"
_SCORE = """CAST(CASE WHEN visit_number IS NULL THEN 0 ELSE 1 END
  + CASE WHEN module IS NULL THEN 0 ELSE 1 END
  + CASE WHEN packet IS NULL THEN 0 ELSE 1 END AS INT)"""


def _landed_stream(spark, sf_dir, shuffled: bool):
    """Events as a stream of parquet files: in order of their ids, or shuffled and partly twice."""
    events = visit_events(spark, sf_dir)
    folder = session.scratch_path(spark, "event-files")
    if shuffled:
        events.repartition(6, F.xxhash64("event_id")).write.parquet(folder)
        again = events.where("event_id % 5 = 0").repartition(2, F.xxhash64("timestamp"))
        again.write.mode("append").parquet(folder)
    else:
        events.repartitionByRange(4, "event_id").write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3)
    return stream.parquet(folder)


@query(
    "stream_visit_states",
    f"""SELECT {_KEY}, MAX(timestamp) AS timestamp, ARG_MAX(action, (timestamp, event_id)) AS action,
        ARG_MAX(score, (timestamp, event_id)) AS latest_score, MAX(score) AS max_score,
        COALESCE(BOOL_OR(score < before), FALSE) AS ever_drops
        FROM (SELECT *, {_SCORE} AS score, LAG({_SCORE}) OVER (
              PARTITION BY {_KEY} ORDER BY timestamp, event_id) AS before FROM visit_events) t
        GROUP BY {_KEY}""",
)
def stream_visit_states(spark, sf_dir):
    """Latest event and completeness of every visit from a stream of shuffled and repeated files."""
    target = session.scratch_path(spark, "visit-states")
    visit_state.follow_visits(
        _landed_stream(spark, sf_dir, shuffled=True),
        target,
        session.scratch_path(spark, "visit-stream"),
        ["event_id"],
    )
    states = visit_state.visit_states(spark, target)
    return states.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# --- report counts over three runs ---------------------------------------------------------

_CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
# The first run sees only even events, so odd ones before a ledger's watermark are late from then on.
_RUNS = {
    "production": "SELECT * FROM visit_events WHERE project_label NOT LIKE 'sandbox-%'",
    "run_one": f"""SELECT * FROM production
      WHERE timestamp < TIMESTAMP '{_CUTS[0]}' AND event_id % 2 = 0""",
    "marks_one": """SELECT study, datatype, MAX(timestamp) AS watermark FROM run_one
      GROUP BY study, datatype""",
    "run_two": f"""SELECT p.* FROM production p LEFT JOIN marks_one m
      ON p.study = m.study AND p.datatype = m.datatype WHERE timestamp < TIMESTAMP '{_CUTS[1]}'
      AND (m.watermark IS NULL OR p.timestamp > m.watermark)""",
    "kept_two": "SELECT * FROM run_one UNION ALL SELECT * FROM run_two",
    "marks_two": """SELECT study, datatype, MAX(timestamp) AS watermark FROM kept_two
      GROUP BY study, datatype""",
    "kept": """SELECT * FROM kept_two UNION ALL SELECT p.* FROM production p LEFT JOIN marks_two m
      ON p.study = m.study AND p.datatype = m.datatype
      WHERE m.watermark IS NULL OR p.timestamp > m.watermark""",
}


def _three_runs(spark, sf_dir) -> ReportCounts:
    """Three runs with counts after each; the first two tables are folded into one."""
    store = LedgerStore(spark, session.scratch_path(spark, "ledgers"))
    reports = ReportCounts(store)
    events = visit_events(spark, sf_dir).where("project_label NOT LIKE 'sandbox-%'")
    at = F.col("timestamp")
    first, second = (F.lit(c).cast("timestamp_ntz") for c in _CUTS)
    parts = (events.where((at < first) & (F.col("event_id") % 2 == 0)), events.where(at < second), events)
    for number, part in enumerate(parts):
        rows = validation.conform(part)
        store.append(incremental.new_events(rows, store.marks()), f"run{number}")
        reports.refresh()
        if number == 1:
            reports.fold()
    return reports


@query(
    "kept_counts",
    """SELECT study, action, module, COUNT(*) AS n_events FROM kept GROUP BY study, action, module""",
    **_RUNS,
)
def kept_counts(spark, sf_dir):
    return _three_runs(spark, sf_dir).by("study", "action", "module")


@query(
    "kept_pass_rate",
    """SELECT center_label, COUNT(*) FILTER (WHERE action = 'pass-qc') AS passed,
       COUNT(*) FILTER (WHERE action = 'not-pass-qc') AS not_passed,
       CAST(COUNT(*) FILTER (WHERE action = 'pass-qc') AS DOUBLE)
         / COUNT(*) FILTER (WHERE action IN ('pass-qc', 'not-pass-qc')) AS pass_rate
       FROM kept GROUP BY center_label
       HAVING COUNT(*) FILTER (WHERE action IN ('pass-qc', 'not-pass-qc')) > 0""",
    **_RUNS,
)
def kept_pass_rate(spark, sf_dir):
    return _three_runs(spark, sf_dir).pass_rate("center_label")


@query("kept_packets", "SELECT DISTINCT packet FROM kept WHERE packet IS NOT NULL", **_RUNS)
def kept_packets(spark, sf_dir):
    return _three_runs(spark, sf_dir).values("packet")


_TEXT_COLUMNS = [c for c in schema.LEDGER_COLUMNS if c != "timestamp"]


@query(
    "kept_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls,
        MIN(CAST({c} AS VARCHAR)) AS least, MAX(CAST({c} AS VARCHAR)) AS greatest,
        TRUE AS estimate_is_near FROM kept"""
        for c in _TEXT_COLUMNS
    ),
    **_RUNS,
)
def kept_profile(spark, sf_dir):
    """Column profiles merged from three runs; the estimate is held against an exact count."""
    store = _three_runs(spark, sf_dir).store
    kept = ColumnProfiles(store)
    kept.refresh()
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact"))
        for c in _TEXT_COLUMNS
    ]
    exact = store.events().agg(F.array(*cells).alias("c")).select(F.inline("c"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.col("exact") * 0.05, F.lit(1))
    return kept.current().join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", "least", "greatest", near.alias("estimate_is_near")
    )
