"""Counts, lists and rates over a ledger.

Every aggregate here combines partially before its shuffle, so a center or action
that holds most of the rows still arrives as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallybook import schema
from tallybook.operators import filters


def count_action(df: DataFrame, action: str) -> DataFrame:
    return df.agg(F.count_if(F.col("action") == action).alias("count"))


def count_not_pass_qc(df: DataFrame) -> DataFrame:
    return count_action(df, "not-pass-qc")


def count_center_action(df: DataFrame, center: str, action: str) -> DataFrame:
    return filters.by_center_and_action(df, center, action).agg(
        F.count(F.lit(1)).alias("count")
    )


def counts_by(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows per combination of fields, sorted by them; NULL is a value."""
    return df.groupBy(*fields).agg(F.count(F.lit(1)).alias("count")).orderBy(*fields)


def action_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, ["action"])


def packet_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, ["packet"])


def distinct_values(df: DataFrame, field: str, keep_null: bool = True) -> DataFrame:
    """Sorted distinct values of one column."""
    values = df.select(field)
    if not keep_null:
        values = values.filter(F.col(field).isNotNull())
    return values.distinct().orderBy(field)


def centers(df: DataFrame) -> DataFrame:
    return distinct_values(df, "center_label")


def actions(df: DataFrame) -> DataFrame:
    return distinct_values(df, "action")


def packets(df: DataFrame) -> DataFrame:
    return distinct_values(df, "packet", keep_null=False)


def _pass_rate() -> Column:
    passed = F.count_if(F.col("action") == "pass-qc")
    return (passed / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("pass_rate")


def pass_rate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of QC outcomes that passed, overall or per group.

    Groups without QC rows are absent; overall without QC rows it is NULL.
    """
    qc = filters.qc_outcomes(df)
    return qc.groupBy(*by).agg(_pass_rate()) if by else qc.agg(_pass_rate())


def qc_counts_by_center_module(df: DataFrame) -> DataFrame:
    return counts_by(filters.qc_outcomes(df), ["center_label", "module", "action"])


def ledger_counts(df: DataFrame) -> DataFrame:
    """Event count and emptiness."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("event_count"), (n == 0).alias("is_empty"))


def group_counts(df: DataFrame) -> DataFrame:
    """Events per (study, datatype)."""
    return counts_by(df, schema.GROUP_KEY).withColumnRenamed("count", "event_count")


def watermarks(df: DataFrame) -> DataFrame:
    """Latest timestamp per ledger."""
    return df.groupBy(*schema.GROUP_KEY).agg(F.max("timestamp").alias("watermark"))


def global_cutoff(df: DataFrame) -> DataFrame:
    """The earliest of the ledgers' latest timestamps; NULL without ledgers."""
    return watermarks(df).agg(F.min("watermark").alias("cutoff"))


def sandbox_count(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    gone = F.count_if(filters.is_sandbox())
    return df.agg(
        n.alias("total_events"), gone.alias("filtered_count"), (n - gone).alias("remaining")
    )
