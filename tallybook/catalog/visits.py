"""Per-visit queries: latest state, history, completeness, missing steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.catalog.base import query, table, visit_events
from tallybook.operators import sequences, visits

TIES = ("event_id",)
_KEY = "ptid, visit_date, visit_number"
_LATEST = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY {_KEY} ORDER BY timestamp DESC, event_id DESC) AS rn FROM visit_events) t
  WHERE rn = 1"""
_SCORE = """CAST(CASE WHEN visit_number IS NULL THEN 0 ELSE 1 END
  + CASE WHEN module IS NULL THEN 0 ELSE 1 END
  + CASE WHEN packet IS NULL THEN 0 ELSE 1 END AS INT)"""


@query("latest_per_visit", _LATEST)
def latest_per_visit(spark, sf_dir):
    return visits.latest_per_visit(visit_events(spark, sf_dir), TIES)


@query(
    "visits_by_status", f"SELECT action, COUNT(*) AS visits FROM ({_LATEST}) l GROUP BY action"
)
def visits_by_status(spark, sf_dir):
    return visits.visits_by_status(visit_events(spark, sf_dir), TIES)


@query(
    "latest_global", "SELECT * FROM visit_events ORDER BY timestamp DESC, event_id DESC LIMIT 1"
)
def latest_global(spark, sf_dir):
    return visits.latest_event(visit_events(spark, sf_dir), TIES)


@query(
    "extreme_events",
    """SELECT *, timestamp = (SELECT MIN(timestamp) FROM visit_events) AS is_earliest
       FROM visit_events WHERE timestamp IN ((SELECT MIN(timestamp) FROM visit_events),
                                             (SELECT MAX(timestamp) FROM visit_events))""",
)
def extreme_events(spark, sf_dir):
    return visits.extreme_events(visit_events(spark, sf_dir))


@query(
    "visit_versions",
    f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY {_KEY} ORDER BY timestamp, event_id) AS version,
        COUNT(*) OVER (PARTITION BY {_KEY}) AS n_versions FROM visit_events""",
)
def visit_versions(spark, sf_dir):
    return visits.versions(visit_events(spark, sf_dir), TIES)


@query("completeness", f"SELECT *, {_SCORE} AS completeness FROM visit_events")
def completeness(spark, sf_dir):
    return visits.completeness(visit_events(spark, sf_dir))


@query(
    "completeness_drops",
    f"""SELECT {_KEY}, COUNT(*) AS n_events,
        ARG_MAX(score, (timestamp, event_id)) AS latest_score, MAX(score) AS max_score,
        COALESCE(BOOL_OR(score < before), FALSE) AS ever_drops,
        ARG_MAX(score, (timestamp, event_id)) = MAX(score) AS latest_is_max
        FROM (SELECT *, {_SCORE} AS score, LAG({_SCORE}) OVER (
              PARTITION BY {_KEY} ORDER BY timestamp, event_id) AS before FROM visit_events) t
        GROUP BY {_KEY}""",
)
def completeness_drops(spark, sf_dir):
    return visits.completeness_trend(visit_events(spark, sf_dir), TIES)


@query(
    "repeated_actions",
    f"""SELECT {_KEY}, action, COUNT(*) AS n_events, MIN(timestamp) AS first_at,
        MAX(timestamp) AS last_at FROM visit_events GROUP BY {_KEY}, action HAVING COUNT(*) > 1""",
)
def repeated_actions(spark, sf_dir):
    return visits.repeated_actions(visit_events(spark, sf_dir))


@query(
    "failed_then_passed",
    f"""SELECT {_KEY}, MIN(timestamp) FILTER (WHERE action = 'not-pass-qc') AS first_failed_at,
        MAX(timestamp) FILTER (WHERE action = 'pass-qc') AS last_passed_at
        FROM visit_events GROUP BY {_KEY}
        HAVING MAX(timestamp) FILTER (WHERE action = 'pass-qc')
             > MIN(timestamp) FILTER (WHERE action = 'not-pass-qc')""",
)
def failed_then_passed(spark, sf_dir):
    return visits.failed_then_passed(visit_events(spark, sf_dir))


_STEPS = f"""SELECT {_KEY}, COUNT(*) FILTER (WHERE action = 'submit') AS submits,
  COUNT(*) FILTER (WHERE action IN ('pass-qc', 'not-pass-qc')) AS outcomes
  FROM visit_events GROUP BY {_KEY}"""


@query("missing_submit", f"SELECT * FROM ({_STEPS}) s WHERE submits = 0 AND outcomes > 0")
def missing_submit(spark, sf_dir):
    return visits.missing_submit(visit_events(spark, sf_dir))


@query("missing_outcome", f"SELECT * FROM ({_STEPS}) s WHERE submits > 0 AND outcomes = 0")
def missing_outcome(spark, sf_dir):
    return visits.missing_outcome(visit_events(spark, sf_dir))


@query(
    "last_write_wins",
    """SELECT name, event_id, props, ts FROM (SELECT *, CONCAT('user-', user_id, '/', event_type,
         '.json') AS name, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
         ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1""",
)
def last_write_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.concat(F.lit("user-"), "user_id", F.lit("/"), "event_type", F.lit(".json"))
    written = events.select(name.alias("name"), "event_id", "props", "ts")
    return visits.last_write_wins(written, "name", ["ts", "event_id"])


def _letters(pattern: str) -> str:
    """SQL for the non-overlapping matches of a pattern over a visit's events, as letters."""
    return f"""SELECT {_KEY}, n_matches FROM (SELECT {_KEY}, CAST(LEN(regexp_extract_all(
        STRING_AGG(CASE action WHEN 'submit' THEN 's' WHEN 'pass-qc' THEN 'p'
          WHEN 'not-pass-qc' THEN 'f' ELSE 'd' END, '' ORDER BY timestamp, event_id),
        '{pattern}')) AS BIGINT) AS n_matches FROM visit_events GROUP BY {_KEY}) t
      WHERE n_matches > 0"""


@query("sequence_corrected", _letters("sf+p"))
def sequence_corrected(spark, sf_dir):
    """Visits whose submit failed once or more and then passed, one event right after the other."""
    return sequences.matches(
        visit_events(spark, sf_dir), ["submit", "not-pass-qc+", "pass-qc"], TIES
    )


@query("sequence_resubmitted", _letters("s+ps"))
def sequence_resubmitted(spark, sf_dir):
    return sequences.matches(visit_events(spark, sf_dir), ["submit+", "pass-qc", "submit"], TIES)
