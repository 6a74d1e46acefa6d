"""Monthly-report queries: filters, counts, lists, rates and timing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallybook.catalog.base import query, visit_events
from tallybook.operators import calendar, counts, filters, timing
from tallybook.operators import visits as visit_ops

# --- filters --------------------------------------------------------------------


@query("filter_sandbox", "SELECT * FROM visit_events WHERE NOT starts_with(project_label, 'sandbox-')")
def filter_sandbox(spark, sf_dir):
    return filters.drop_sandbox(visit_events(spark, sf_dir))


@query(
    "sandbox_count",
    """SELECT COUNT(*) AS total_events,
       COUNT(*) FILTER (WHERE project_label LIKE 'sandbox-%') AS filtered_count,
       COUNT(*) FILTER (WHERE project_label NOT LIKE 'sandbox-%') AS remaining
       FROM visit_events""",
)
def sandbox_count(spark, sf_dir):
    return counts.sandbox_count(visit_events(spark, sf_dir))


@query("filter_center", "SELECT * FROM visit_events WHERE center_label = 'center03'")
def filter_center(spark, sf_dir):
    return filters.by_center(visit_events(spark, sf_dir), "center03")


@query(
    "filter_center_action",
    "SELECT * FROM visit_events WHERE center_label = 'center03' AND action = 'pass-qc'",
)
def filter_center_action(spark, sf_dir):
    return filters.by_center_and_action(visit_events(spark, sf_dir), "center03", "pass-qc")


@query("filter_packet", "SELECT * FROM visit_events WHERE packet = 'I'")
def filter_packet(spark, sf_dir):
    return filters.by_packet(visit_events(spark, sf_dir), "I")


@query(
    "range_visit_date",
    "SELECT * FROM visit_events WHERE visit_date BETWEEN '2024-01-08' AND '2024-01-15'",
)
def range_visit_date(spark, sf_dir):
    return filters.by_date_range(visit_events(spark, sf_dir), "2024-01-08", "2024-01-15")


@query("range_open_start", "SELECT * FROM visit_events WHERE visit_date <= '2024-01-08'")
def range_open_start(spark, sf_dir):
    return filters.by_date_range(visit_events(spark, sf_dir), end="2024-01-08")


@query("range_open_end", "SELECT * FROM visit_events WHERE visit_date >= '2024-01-15'")
def range_open_end(spark, sf_dir):
    return filters.by_date_range(visit_events(spark, sf_dir), start="2024-01-15")


@query(
    "range_timestamp_dates",
    """SELECT * FROM visit_events WHERE timestamp >= TIMESTAMP '2024-01-10 00:00:00'
       AND timestamp <= TIMESTAMP '2024-01-12 23:59:59.999999'""",
)
def range_timestamp_dates(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    return filters.by_date_range(events, "2024-01-10", "2024-01-12", "timestamp")


@query(
    "range_timestamp",
    """SELECT * FROM visit_events WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 06:00:00'
       AND TIMESTAMP '2024-01-20 18:30:00'""",
)
def range_timestamp(spark, sf_dir):
    return filters.by_timestamp_range(
        visit_events(spark, sf_dir), datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 18, 30)
    )


@query("qc_subset", "SELECT * FROM visit_events WHERE action IN ('pass-qc', 'not-pass-qc')")
def qc_subset(spark, sf_dir):
    return filters.qc_outcomes(visit_events(spark, sf_dir))


@query(
    "visit_lookup",
    """SELECT e.* FROM visit_events e WHERE EXISTS (SELECT 1 FROM visit_events f
       WHERE f.action = 'not-pass-qc' AND f.center_label = 'center06' AND f.ptid = e.ptid
       AND f.visit_date = e.visit_date AND f.visit_number IS NOT DISTINCT FROM e.visit_number)""",
)
def visit_lookup(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    failed = filters.by_center_and_action(events, "center06", "not-pass-qc")
    return visit_ops.events_of_visits(events, failed)


# --- counts and lists -------------------------------------------------------------


@query(
    "count_action", "SELECT COUNT(*) AS count FROM visit_events WHERE action = 'submit'"
)
def count_action(spark, sf_dir):
    return counts.count_action(visit_events(spark, sf_dir), "submit")


@query(
    "count_not_pass_qc", "SELECT COUNT(*) AS count FROM visit_events WHERE action = 'not-pass-qc'"
)
def count_not_pass_qc(spark, sf_dir):
    return counts.count_not_pass_qc(visit_events(spark, sf_dir))


@query("action_counts", "SELECT action, COUNT(*) AS count FROM visit_events GROUP BY action")
def action_counts(spark, sf_dir):
    return counts.action_counts(visit_events(spark, sf_dir))


@query(
    "count_center_action",
    """SELECT COUNT(*) AS count FROM visit_events
       WHERE center_label = 'center05' AND action = 'delete'""",
)
def count_center_action(spark, sf_dir):
    return counts.count_center_action(visit_events(spark, sf_dir), "center05", "delete")


@query("packet_counts", "SELECT packet, COUNT(*) AS count FROM visit_events GROUP BY packet")
def packet_counts(spark, sf_dir):
    return counts.packet_counts(visit_events(spark, sf_dir))


@query(
    "multi_field_counts",
    """SELECT module, packet, action, COUNT(*) AS count FROM visit_events
       GROUP BY module, packet, action""",
)
def multi_field_counts(spark, sf_dir):
    return counts.counts_by(visit_events(spark, sf_dir), ["module", "packet", "action"])


@query("centers_list", "SELECT DISTINCT center_label FROM visit_events")
def centers_list(spark, sf_dir):
    return counts.centers(visit_events(spark, sf_dir))


@query("actions_list", "SELECT DISTINCT action FROM visit_events")
def actions_list(spark, sf_dir):
    return counts.actions(visit_events(spark, sf_dir))


@query("packets_list", "SELECT DISTINCT packet FROM visit_events WHERE packet IS NOT NULL")
def packets_list(spark, sf_dir):
    return counts.packets(visit_events(spark, sf_dir))


_RATE = """CAST(COUNT(*) FILTER (WHERE action = 'pass-qc') AS DOUBLE)
  / NULLIF(COUNT(*) FILTER (WHERE action IN ('pass-qc', 'not-pass-qc')), 0)"""
_HAS_QC = "COUNT(*) FILTER (WHERE action IN ('pass-qc', 'not-pass-qc')) > 0"


@query("pass_rate", f"SELECT {_RATE} AS pass_rate FROM visit_events")
def pass_rate(spark, sf_dir):
    return counts.pass_rate(visit_events(spark, sf_dir))


@query(
    "pass_rate_center",
    f"""SELECT center_label, {_RATE} AS pass_rate FROM visit_events
        GROUP BY center_label HAVING {_HAS_QC}""",
)
def pass_rate_center(spark, sf_dir):
    return counts.pass_rate(visit_events(spark, sf_dir), ["center_label"])


@query(
    "pass_rate_module",
    f"""SELECT module, {_RATE} AS pass_rate FROM visit_events
        GROUP BY module HAVING {_HAS_QC}""",
)
def pass_rate_module(spark, sf_dir):
    return counts.pass_rate(visit_events(spark, sf_dir), ["module"])


@query(
    "qc_center_module",
    """SELECT center_label, module, action, COUNT(*) AS count FROM visit_events
       WHERE action IN ('pass-qc', 'not-pass-qc') GROUP BY center_label, module, action""",
)
def qc_center_module(spark, sf_dir):
    return counts.qc_counts_by_center_module(visit_events(spark, sf_dir))


@query(
    "watermarks",
    """SELECT study, datatype, MAX(timestamp) AS watermark FROM visit_events
       GROUP BY study, datatype""",
)
def watermarks(spark, sf_dir):
    return counts.watermarks(visit_events(spark, sf_dir))


@query(
    "global_cutoff",
    """SELECT MIN(w) AS cutoff FROM (SELECT MAX(timestamp) AS w FROM visit_events
       GROUP BY study, datatype) t""",
)
def global_cutoff(spark, sf_dir):
    return counts.global_cutoff(visit_events(spark, sf_dir))


@query(
    "ledger_counts",
    "SELECT COUNT(*) AS event_count, COUNT(*) = 0 AS is_empty FROM visit_events",
)
def ledger_counts(spark, sf_dir):
    return counts.ledger_counts(visit_events(spark, sf_dir))


@query(
    "group_counts",
    """SELECT study, datatype, COUNT(*) AS event_count FROM visit_events
       WHERE project_label NOT LIKE 'sandbox-%' GROUP BY study, datatype""",
)
def group_counts(spark, sf_dir):
    return counts.group_counts(filters.drop_sandbox(visit_events(spark, sf_dir)))


# --- timing -----------------------------------------------------------------------

_SUBMIT_DAYS = """SELECT *, date_diff('day', CAST(visit_date AS DATE), CAST(timestamp AS DATE))
  AS days_from_visit_to_submit FROM visit_events WHERE action = 'submit'"""
_QC_DAYS = """SELECT *, date_diff('day', CAST(visit_date AS DATE), CAST(timestamp AS DATE))
  AS days_from_visit_to_qc FROM visit_events WHERE action = 'pass-qc'"""


@query("submit_timing", _SUBMIT_DAYS)
def submit_timing(spark, sf_dir):
    return timing.submit_timing(visit_events(spark, sf_dir))


@query("qc_timing", _QC_DAYS)
def qc_timing(spark, sf_dir):
    return timing.qc_timing(visit_events(spark, sf_dir))


@query(
    "qc_timing_center_range",
    _QC_DAYS + " AND center_label = 'center04' AND visit_date BETWEEN '2024-01-01' AND '2024-01-15'",
)
def qc_timing_center_range(spark, sf_dir):
    events = filters.by_center(visit_events(spark, sf_dir), "center04")
    return timing.qc_timing(filters.by_date_range(events, "2024-01-01", "2024-01-15"))


@query("submit_timing_packet", _SUBMIT_DAYS + " AND packet = 'I'")
def submit_timing_packet(spark, sf_dir):
    return timing.submit_timing(filters.by_packet(visit_events(spark, sf_dir), "I"))


# --- calendar ----------------------------------------------------------------------

_SPAN = """SELECT ptid, visit_date, visit_number, MIN(timestamp) AS a, MAX(timestamp) AS b
  FROM visit_events GROUP BY ptid, visit_date, visit_number"""


@query(
    "business_days",
    """SELECT ptid, visit_date, visit_number,
       (SELECT COUNT(*) FROM generate_series(CAST(a AS DATE)::TIMESTAMP, CAST(b AS DATE)::TIMESTAMP,
        INTERVAL 1 DAY) g(d) WHERE isodow(d) < 6) AS business_days FROM visit_span""",
    visit_span=_SPAN,
)
def business_days(spark, sf_dir):
    spans = calendar.turnaround(visit_events(spark, sf_dir), visit_ops.KEY)
    return spans.select(*visit_ops.KEY, "business_days")


@query(
    "duration_text",
    """SELECT ptid, visit_date, visit_number, s AS seconds,
       CASE WHEN s = 0 THEN '0s' ELSE concat_ws(' ',
         CASE WHEN s // 3600 > 0 THEN concat(s // 3600, 'h') END,
         CASE WHEN s % 3600 // 60 > 0 THEN concat(s % 3600 // 60, 'm') END,
         CASE WHEN s % 60 > 0 THEN concat(s % 60, 's') END) END AS duration
       FROM (SELECT *, (epoch_us(b) - epoch_us(a)) // 1000000 AS s FROM visit_span) t""",
    visit_span=_SPAN,
)
def duration_text(spark, sf_dir):
    spans = calendar.turnaround(visit_events(spark, sf_dir), visit_ops.KEY)
    return spans.select(*visit_ops.KEY, "seconds", "duration")


@query(
    "daily_gap_fill",
    """SELECT CAST(d AS DATE) AS day, COUNT(e.event_id) AS events
       FROM (SELECT unnest(generate_series(MIN(CAST(timestamp AS DATE))::TIMESTAMP,
             MAX(CAST(timestamp AS DATE))::TIMESTAMP, INTERVAL 1 DAY)) AS d
             FROM gappy) s
       LEFT JOIN gappy e ON CAST(e.timestamp AS DATE) = CAST(s.d AS DATE) GROUP BY d""",
    gappy="""SELECT event_id, timestamp + to_days(CAST(day(timestamp) AS INTEGER)) AS timestamp
             FROM visit_events""",
)
def daily_gap_fill(spark, sf_dir):
    """Each event is moved by its day of month, so that every other day is empty."""
    events = visit_events(spark, sf_dir)
    moved = F.col("timestamp") + F.make_dt_interval(F.dayofmonth("timestamp"))
    return calendar.daily_gap_fill(events.withColumn("timestamp", moved))


@query(
    "monthly_business_report",
    """SELECT CAST(d AS DATE) AS day, CAST(date_trunc('month', d) AS DATE) AS month,
       (SELECT COUNT(*) FROM generate_series(date_trunc('month', d),
          date_trunc('month', d) + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY) g(x)
        WHERE isodow(x) < 6) AS business_days_in_month,
       strftime(d, '%Y/%m/%d') AS day_path,
       COUNT(e.event_id) AS events,
       COUNT(e.event_id) FILTER (WHERE e.action = 'pass-qc') AS passed,
       COUNT(e.event_id) FILTER (WHERE e.action = 'not-pass-qc') AS failed
       FROM (SELECT unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 DAY,
                                           INTERVAL 1 DAY)) AS d
             FROM (SELECT DISTINCT date_trunc('month', timestamp) AS m FROM visit_events) t) s
       LEFT JOIN visit_events e ON CAST(e.timestamp AS DATE) = CAST(s.d AS DATE)
       WHERE isodow(d) < 6 GROUP BY d""",
)
def monthly_business_report(spark, sf_dir):
    return calendar.monthly_business_report(visit_events(spark, sf_dir))
