"""What happened to each visit.

A visit is (ptid, visit_date, visit_number); a NULL visit_number is a value. Apart
from numbering, everything is an aggregate that combines before its shuffle, so no
visit is ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallybook import schema
from tallybook.operators import joins, ranking

KEY = list(schema.VISIT_KEY)


def latest_per_visit(df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Each visit's most recent event; `ties` orders equal timestamps."""
    return ranking.latest_per_key(df, KEY, ["timestamp", *ties])


def visits_by_status(df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Visits per action of their latest event."""
    slim = df.select(*KEY, "action", "timestamp", *ties)
    return latest_per_visit(slim, ties).groupBy("action").agg(
        F.count(F.lit(1)).alias("visits")
    )


def latest_event(df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The most recent event of all."""
    newest = [F.col(c).desc_nulls_last() for c in ("timestamp", *ties)]
    return df.orderBy(*newest).limit(1)


def extreme_events(df: DataFrame) -> DataFrame:
    """All events at the earliest and at the latest timestamp, ties included."""
    first = df.agg(F.min("timestamp")).scalar()
    last = df.agg(F.max("timestamp")).scalar()
    when = F.col("timestamp")
    return df.filter((when == first) | (when == last)).withColumn(
        "is_earliest", when == first
    )


def versions(df: DataFrame, ties: Sequence[str] = (), **limits) -> DataFrame:
    """Every event with its version number within the visit and the visit's total."""
    return ranking.number_within(df, KEY, ["timestamp", *ties], **limits)


def completeness_score() -> Column:
    """How many of the optional fields are filled, 0 to 3."""
    return sum((F.col(c).isNotNull().cast("int") for c in schema.NULLABLE), F.lit(0))


def completeness(df: DataFrame) -> DataFrame:
    return df.withColumn("completeness", completeness_score())


def completeness_trend(df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Per visit: does the score ever drop, and is the latest score the highest?

    A score drops somewhere exactly when some event with a higher score precedes one
    with a lower score, so the first event per score and the last event per score
    decide it, with no ordered pass over the visit.
    """
    levels = range(len(schema.NULLABLE) + 1)
    at = F.struct("timestamp", *ties)
    score = F.col("completeness")
    first = {s: F.min(F.when(score == s, at)) for s in levels}
    last = {s: F.max(F.when(score == s, at)) for s in levels}
    per_visit = (
        completeness(df.select(*KEY, "module", "packet", "timestamp", *ties))
        .groupBy(*KEY)
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.max("completeness").alias("max_score"),
            F.max_by("completeness", at).alias("latest_score"),
            *[first[s].alias(f"_first{s}") for s in levels],
            *[last[s].alias(f"_last{s}") for s in levels],
        )
    )
    drops = F.lit(False)
    for high in levels:
        for low in range(high):
            drops = drops | F.coalesce(
                F.col(f"_first{high}") < F.col(f"_last{low}"), F.lit(False)
            )
    return per_visit.select(
        *KEY,
        "n_events",
        "latest_score",
        "max_score",
        drops.alias("ever_drops"),
        (F.col("latest_score") == F.col("max_score")).alias("latest_is_max"),
    )


def repeated_actions(df: DataFrame) -> DataFrame:
    """Visit and action pairs that occur more than once."""
    return (
        df.groupBy(*KEY, "action")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.min("timestamp").alias("first_at"),
            F.max("timestamp").alias("last_at"),
        )
        .filter("n_events > 1")
    )


def failed_then_passed(df: DataFrame) -> DataFrame:
    """Visits that passed QC after an earlier failure."""
    when = F.col("timestamp")
    action = F.col("action")
    return (
        df.groupBy(*KEY)
        .agg(
            F.min(F.when(action == "not-pass-qc", when)).alias("first_failed_at"),
            F.max(F.when(action == "pass-qc", when)).alias("last_passed_at"),
        )
        .filter("last_passed_at > first_failed_at")
    )


def _submits_and_outcomes(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY).agg(
        F.count_if(F.col("action") == "submit").alias("submits"),
        F.count_if(F.col("action").isin(*schema.QC_ACTIONS)).alias("outcomes"),
    )


def missing_submit(df: DataFrame) -> DataFrame:
    """Visits with a QC outcome but no submit."""
    return _submits_and_outcomes(df).filter("submits = 0 AND outcomes > 0")


def missing_outcome(df: DataFrame) -> DataFrame:
    """Visits with a submit but no QC outcome."""
    return _submits_and_outcomes(df).filter("submits > 0 AND outcomes = 0")


def events_of_visits(df: DataFrame, visits: DataFrame) -> DataFrame:
    """Events belonging to any of the listed visits, NULL visit numbers matching."""
    return joins.null_safe_semi(df, visits, KEY)


def events_of_visit(
    df: DataFrame, ptid: str, visit_date: str, visit_number: str | None
) -> DataFrame:
    return df.filter(
        (F.col("ptid") == ptid)
        & (F.col("visit_date") == visit_date)
        & F.col("visit_number").eqNullSafe(F.lit(visit_number).cast("string"))
    )


def last_write_wins(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """One row per object name: the one written last."""
    return ranking.latest_per_key(df, [name], order)
