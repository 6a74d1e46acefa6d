"""Run metrics: one row per run in, derived rates and roll-ups out.

Run table: start_time, end_time, records_processed, records_failed, bytes_processed,
output_files_created, errors (array of text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.operators.validation import Rule, error_list


def duration_seconds() -> Column:
    """Seconds from start to end, with fraction."""
    micros = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time"))
    return micros / 1_000_000


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def run_errors() -> Column:
    """Rule messages for a run row."""
    counts = ("records_processed", "records_failed", "bytes_processed", "output_files_created")
    return error_list(
        [
            Rule("end_time must be after start_time", F.col("end_time") < F.col("start_time")),
            *[Rule(f"{c} must not be negative", F.col(c) < 0) for c in counts],
        ]
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Add duration, totals, success percentage and throughput to each run."""
    total = F.col("records_processed") + F.col("records_failed")
    seconds = F.col("duration_seconds")
    return runs.withColumn("duration_seconds", duration_seconds()).withColumns(
        {
            "total_records": total,
            "success_rate": _ratio(F.col("records_processed") * 100, total),
            "records_per_second": _ratio(F.col("records_processed"), seconds),
            "bytes_per_second": _ratio(F.col("bytes_processed"), seconds),
        }
    )


def run_summary(runs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rounded report line per run."""
    return run_metrics(runs).select(
        *keep,
        F.round("duration_seconds", 2).alias("duration_seconds"),
        "records_processed",
        "records_failed",
        F.round("success_rate", 2).alias("success_rate_percent"),
        F.round("records_per_second", 2).alias("records_per_second"),
        F.round("bytes_per_second", 2).alias("bytes_per_second"),
        "bytes_processed",
        "output_files_created",
        F.size("errors").cast("bigint").alias("error_count"),
    )


def roll_up(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Many runs as one: earliest start, latest end, summed counts, error count.

    The messages themselves stay rows (see run_error_rows): joined into one value
    they would pass through one task.
    """
    def total(c: str) -> Column:
        return F.sum(c).cast("bigint").alias(c)

    aggs = [
        F.count(F.lit(1)).alias("runs"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        total("records_processed"),
        total("records_failed"),
        total("bytes_processed"),
        total("output_files_created"),
        F.sum(F.size("errors")).cast("bigint").alias("error_count"),
    ]
    return runs.groupBy(*by).agg(*aggs) if by else runs.agg(*aggs)


def run_error_rows(runs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every error message of every run, in run order by its position."""
    return runs.select(*keep, "start_time", F.posexplode("errors").alias("position", "error"))
