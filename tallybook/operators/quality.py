"""Data-quality reports for any table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybook.functions import text


def null_report(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULL count and percentage.

    One scan, one partial aggregate; the single result row is turned into rows.
    """
    kinds = dict(df.dtypes)
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    long = one.unpivot("_rows", df.columns, "column", "null_count")
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return long.select(
        "column",
        kind[F.col("column")].alias("data_type"),
        F.col("_rows").alias("total_rows"),
        "null_count",
        F.when(F.col("_rows") > 0, F.col("null_count") * 100 / F.col("_rows"))
        .otherwise(F.lit(0.0))
        .alias("null_percentage"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that have at least one exact copy; every copy counts."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_copies") > 1, F.col("_copies"))), F.lit(0))
        .cast("bigint")
        .alias("duplicate_rows"),
    )


def clean_customers(df: DataFrame) -> DataFrame:
    """Tidy customer text and drop rows without an id or a name.

    Expects customer_id, name, email, phone, address and notes; a missing value is ''.
    """
    raw = {
        c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        for c in ("customer_id", "name", "email", "phone", "address", "notes")
    }
    return df.select(
        text.strip_whitespace(raw["customer_id"]).alias("customer_id"),
        text.collapse_whitespace(raw["name"]).alias("name"),
        F.lower(text.strip_whitespace(raw["email"])).alias("email"),
        text.digits_of(raw["phone"]).alias("phone"),
        text.collapse_whitespace(raw["address"]).alias("address"),
        text.truncate(text.collapse_whitespace(raw["notes"]), 500).alias("notes"),
    ).filter((F.col("customer_id") != "") & (F.col("name") != ""))


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """Rows in, rows kept, and the kept percentage, in one scan."""
    kept = (
        (text.strip_whitespace(F.coalesce(F.col("customer_id").cast("string"), F.lit(""))) != "")
        & (text.collapse_whitespace(F.coalesce(F.col("name"), F.lit(""))) != "")
    )
    return raw.agg(
        F.count(F.lit(1)).alias("input_records"), F.count_if(kept).alias("output_records")
    ).withColumn(
        "cleaned_percentage",
        F.when(
            F.col("input_records") > 0, F.col("output_records") * 100 / F.col("input_records")
        ).otherwise(F.lit(0.0)),
    )
