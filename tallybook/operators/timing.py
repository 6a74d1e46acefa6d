"""Days from a visit to what happened to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybook.functions import dates


def _days_to_action(df: DataFrame, action: str, name: str) -> DataFrame:
    visit = dates.try_date(F.col("visit_date"))
    done = F.to_date("timestamp")
    return df.filter(F.col("action") == action).withColumn(
        name, dates.days_between(visit, done)
    )


def submit_timing(df: DataFrame) -> DataFrame:
    """Submit rows with days since the visit; NULL for an impossible visit date."""
    return _days_to_action(df, "submit", "days_from_visit_to_submit")


def qc_timing(df: DataFrame) -> DataFrame:
    """QC-pass rows with days since the visit; NULL for an impossible visit date."""
    return _days_to_action(df, "pass-qc", "days_from_visit_to_qc")
