"""Calendar reports: every day gets a row, with or without events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions import dates


def date_spine(bounds: DataFrame, start: Column, end: Column, name: str = "day") -> DataFrame:
    """One row per day from start to end, both included, for each row of bounds.

    A reversed range is an error.
    """
    checked = F.when(start <= end, end).otherwise(
        F.raise_error(F.lit("start date must be before or equal to end date")).cast("date")
    )
    days = F.sequence(start, checked, F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))


def daily_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("action") == "pass-qc").alias("passed"),
        F.count_if(F.col("action") == "not-pass-qc").alias("failed"),
    )


def daily_gap_fill(df: DataFrame) -> DataFrame:
    """Events per day from the first day to the last, empty days as 0."""
    counts = daily_counts(df)
    bounds = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).filter(
        F.col("lo").isNotNull()
    )
    spine = date_spine(bounds, F.col("lo"), F.col("hi"))
    return spine.join(counts, "day", "left").select(
        "day", F.coalesce("events", F.lit(0)).cast("bigint").alias("events")
    )


def monthly_business_report(df: DataFrame) -> DataFrame:
    """Every business day of every month touched by the events, with its counts."""
    counts = daily_counts(df)
    months = counts.select(dates.month_start(F.col("day")).alias("month")).distinct()
    days = date_spine(months, F.col("month"), dates.month_end(F.col("month"))).filter(
        dates.is_business_day(F.col("day"))
    )

    def number(c: str) -> Column:
        return F.coalesce(c, F.lit(0)).cast("bigint").alias(c)

    return days.join(counts, "day", "left").select(
        "day",
        dates.month_start(F.col("day")).alias("month"),
        dates.business_days(
            dates.month_start(F.col("day")), dates.month_end(F.col("day"))
        ).alias("business_days_in_month"),
        F.date_format("day", "yyyy/MM/dd").alias("day_path"),
        number("events"),
        number("passed"),
        number("failed"),
    )


def turnaround(df: DataFrame, keys: list[str]) -> DataFrame:
    """Business days and plain duration from a visit's first to its last event."""
    span = df.groupBy(*keys).agg(
        F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at")
    )
    seconds = F.timestamp_diff("SECOND", F.col("first_at"), F.col("last_at"))
    return span.select(
        *keys,
        dates.business_days(F.to_date("first_at"), F.to_date("last_at")).alias("business_days"),
        seconds.alias("seconds"),
        dates.duration_text(seconds).alias("duration"),
    )
