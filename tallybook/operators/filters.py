"""Row filters over a ledger. All reach the parquet scan as pushed filters."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tallybook import schema


def is_sandbox() -> Column:
    return F.col("project_label").startswith(schema.SANDBOX_PREFIX)


def drop_sandbox(df: DataFrame) -> DataFrame:
    """Keep production rows only."""
    return df.filter(~is_sandbox())


def by_center(df: DataFrame, center: str) -> DataFrame:
    return df.filter(F.col("center_label") == center)


def by_center_and_action(df: DataFrame, center: str, action: str) -> DataFrame:
    return df.filter((F.col("center_label") == center) & (F.col("action") == action))


def by_packet(df: DataFrame, packet: str) -> DataFrame:
    """Rows of one packet; a NULL packet never matches."""
    return df.filter(F.col("packet") == packet)


def qc_outcomes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("action").isin(*schema.QC_ACTIONS))


def by_date_range(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    field: str = "visit_date",
) -> DataFrame:
    """Rows dated from start to end, both included, either may be open.

    visit_date is compared as text; for timestamp the end day counts in full.
    """
    if field == "visit_date":
        if start is not None:
            df = df.filter(F.col(field) >= start)
        if end is not None:
            df = df.filter(F.col(field) <= end)
        return df
    if field == "timestamp":
        kind = df.schema["timestamp"].dataType
        if start is not None:
            df = df.filter(F.col(field) >= F.lit(str(date.fromisoformat(start))).cast(kind))
        if end is not None:
            day_after = date.fromisoformat(end) + timedelta(days=1)
            df = df.filter(F.col(field) < F.lit(str(day_after)).cast(kind))
        return df
    raise ValueError(f"cannot filter by {field!r}; use 'visit_date' or 'timestamp'")


def by_timestamp_range(
    df: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rows with start <= timestamp <= end, either may be open."""
    kind = df.schema["timestamp"].dataType
    if start is not None:
        df = df.filter(F.col("timestamp") >= F.lit(start.isoformat(" ")).cast(kind))
    if end is not None:
        df = df.filter(F.col("timestamp") <= F.lit(end.isoformat(" ")).cast(kind))
    return df
