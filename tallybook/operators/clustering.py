"""Rows laid out along a space-filling curve.

A file that holds a narrow range of the curve holds a narrow range of each clustered column, so filters on
any of them leave out most files by their statistics, which a plain sort gives only for its first column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 10  # cells of each column: 2 ** BITS
MOST_VALUES = 1 << BITS  # different values of a ranked column


def curve(cells: Sequence[Column], bits: int = BITS) -> Column:
    """One number from several cell numbers, their bits dealt in turn, the highest first."""
    terms = [
        F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)), bit * len(cells) + i)
        for bit in range(bits)
        for i, cell in enumerate(reversed(cells))
    ]
    out = terms[0]
    for term in terms[1:]:
        out = out.bitwiseOR(term)
    return out


def time_cell(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """Which of the equal parts between the first and last time a row falls in; NULL is in the first."""
    micros = F.unix_micros(F.col(column).cast("timestamp"))
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    if low is None or low == high:
        return F.lit(0).cast("bigint")
    width = (high - low) / (1 << bits)
    part = F.floor((micros - low) / width)
    return F.coalesce(F.least(part, F.lit((1 << bits) - 1)), F.lit(0)).cast("bigint")


def with_ranks(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the place of a column's value among its sorted different values, spread over all cells.

    NULL has the first. For columns of few values, such as centers; the list is checked and broadcast.
    """
    values = [r[0] for r in df.select(column).distinct().orderBy(column).limit(MOST_VALUES + 1).collect()]
    if len(values) > MOST_VALUES:
        raise ValueError(f"{column} has over {MOST_VALUES} values; cluster by another column")
    kind = df.schema[column].dataType.simpleString()
    table = df.sparkSession.createDataFrame(
        [(v, (i << BITS) // len(values)) for i, v in enumerate(values)],
        f"_value {kind}, `{name}` bigint",
    )
    same = F.col(column).eqNullSafe(F.col("_value"))
    return df.join(F.broadcast(table), same).drop("_value")


def clustered(df: DataFrame, time: str, label: str, files: int, first: Sequence[str] = ()) -> DataFrame:
    """Rows range-partitioned and sorted along a curve through time and a label column.

    Columns in ``first`` come before the curve. The number of files bounds how narrow their ranges get.
    """
    cell, rank = "_time_cell", "_label_rank"
    placed = with_ranks(df.withColumn(cell, time_cell(df, time)), label, rank)
    placed = placed.withColumn("_curve", curve([F.col(cell), F.col(rank)]))
    order = [*first, "_curve", time]
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(
        cell, rank, "_curve"
    )
