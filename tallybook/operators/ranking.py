"""Ordering within groups that may be very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tallybook import session

MAX_GROUP_ROWS = 5_000_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the given order; NULL keys form a group.

    Spark turns the rank filter into a group limit on both sides of the shuffle, so
    each map task sends one row per key, however many rows a key has.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    )


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    number: str = "version",
    total: str = "n_versions",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Number the rows of each key from 1 by the given order, and add the key's total.

    The largest group is measured first (one partial aggregate over the key columns).
    Where it fits a task, a window does it. Otherwise rows are range-partitioned by
    key and order, which spreads a large group over many slices; rows are numbered
    inside each slice, and the counts of the earlier slices are added.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= max_group_rows:
        group = W.partitionBy(*keys)
        return df.withColumn(
            number, F.row_number().over(group.orderBy(*order)).cast("bigint")
        ).withColumn(total, F.count(F.lit(1)).over(group))
    return _number_by_slices(df, keys, order, number, total)


def _number_by_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], number: str, total: str
) -> DataFrame:
    spark = df.sparkSession
    # Written once: slice bounds come from sampling, so both reads below must see
    # the same slices even when an executor is lost in between.
    path = session.scratch_path(spark, "slices")
    ranged = df.repartitionByRange(*keys, *order)
    ranged.withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    sliced = spark.read.parquet(path)

    chunk = ["_slice", *keys]
    per_chunk = sliced.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_n"))
    by_key = W.partitionBy(*keys)  # at most one row per slice
    earlier = by_key.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *[F.col(c).alias(f"_o_{c}") for c in chunk],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(by_key).alias(total),
    )
    numbered = sliced.withColumn(
        "_in_slice", F.row_number().over(W.partitionBy(*chunk).orderBy(*order))
    )
    on = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in chunk]
    return numbered.join(offsets, on).select(
        *df.columns,
        (F.col("_before") + F.col("_in_slice")).cast("bigint").alias(number),
        F.col(total),
    )
