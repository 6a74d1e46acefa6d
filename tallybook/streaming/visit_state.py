"""The state of every visit, kept up by a stream.

Each visit has a state of fixed size in Spark's state store: its latest event, and the first and last time
of each completeness score. All of it are minima and maxima, so Spark's own streaming aggregation keeps it,
events may arrive in any order, and events that arrive again change nothing. Every batch of events is kept
in a narrow form, and every batch of states holds the visits it changed; an event that came after a later
one of its visit was already known is found from the batches when it is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook import schema
from tallybook.operators import ranking, visits
from tallybook.sources import folders

_LEVELS = range(len(schema.NULLABLE) + 1)
_EVENT = "ptid string, visit_date string, visit_number string, action string, score int, at string"
_STATE = (
    "ptid string, visit_date string, visit_number string, at string, action string, score int,"
    " max_score int, ever_drops boolean"
)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_LOWEST = Decimal(2**63)  # shifts any bigint to a number that is not negative


def _sortable(number: Column) -> Column:
    """A bigint as 20 digits that sort like it."""
    shifted = number.cast("decimal(20,0)") + F.lit(_LOWEST)
    return F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0")


def _ordered(when: Column, ties: Sequence[str]) -> Column:
    """A text that sorts like (time, ties)."""
    return F.concat(_sortable(F.unix_micros(when)), *[_sortable(F.col(c)) for c in ties])


def _moment(at: Column) -> Column:
    shifted = F.substring(at, 1, 20).cast("decimal(20,0)") - F.lit(_LOWEST)
    return F.timestamp_micros(shifted.cast("bigint"))


def visit_moves(events: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """What of each event its visit's state needs.

    Needs the ledger columns; ``ties``, whole numbers, order events of one time; what still ties goes
    by the action.
    """
    return events.select(
        *schema.VISIT_KEY,
        "action",
        visits.completeness_score().alias("score"),
        _ordered(F.col("timestamp").cast("timestamp"), ties).alias("at"),
    )


def visit_changes(moves: DataFrame) -> DataFrame:
    """Stream of changed visits, with the state each was left in. NULL visit numbers are a value."""
    of_level = [F.when(F.col("score") == s, F.col("at")) for s in _LEVELS]
    state = moves.groupBy(*schema.VISIT_KEY).agg(
        F.max(F.struct("at", "action", "score")).alias("last"),
        F.max("score").alias("max_score"),
        *[F.min(at).alias(f"first{s}") for s, at in zip(_LEVELS, of_level, strict=True)],
        *[F.max(at).alias(f"last{s}") for s, at in zip(_LEVELS, of_level, strict=True)],
    )
    # A level that no event had is NULL and drops nothing.
    drops = [
        F.coalesce(F.col(f"first{high}") < F.col(f"last{low}"), F.lit(False))
        for high in _LEVELS
        for low in range(high)
    ]
    return state.select(
        *schema.VISIT_KEY, "last.*", "max_score", reduce(Column.__or__, drops).alias("ever_drops")
    )


def _drain(rows: DataFrame, mode: str, path: str, checkpoint: str) -> StreamingQuery:
    """Write what there is now, each batch to a folder of its own; a repeated batch replaces it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def follow_visits(
    events: DataFrame, target: str, checkpoint: str, ties: Sequence[str] = ()
) -> StreamingQuery:
    """Process the events that are there now, batch by batch, then stop.

    The events' batches are written first, and the states are kept up from what was written, so the
    source is read once. Each batch writes a folder of its own below ``target``; a batch that is
    repeated after a crash replaces it, and events that reach the states twice change nothing.
    Returns the finished query over the events.
    """
    spark = events.sparkSession
    moved = f"{target}/events"
    query = _drain(visit_moves(events, ties), "append", moved, f"{checkpoint}/events")
    if not folders.exists(spark, moved):
        return query
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        moves = spark.readStream.schema(f"{_EVENT}, batch bigint").parquet(moved)
        _drain(visit_changes(moves), "update", f"{target}/states", f"{checkpoint}/states")
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    return query


def _batches(spark: SparkSession, path: str, columns: str) -> DataFrame:
    rows = spark.read.option("basePath", path).schema(f"{columns}, batch bigint").parquet(path)
    return rows.withColumn("timestamp", _moment(F.col("at")))


def visit_states(spark: SparkSession, target: str) -> DataFrame:
    """Each visit as the stream last left it: latest event and course of its completeness."""
    states = _batches(spark, f"{target}/states", _STATE)
    return ranking.latest_per_key(states, list(schema.VISIT_KEY), ["batch"]).select(
        *schema.VISIT_KEY,
        "timestamp",
        "action",
        F.col("score").alias("latest_score"),
        "max_score",
        "ever_drops",
    )


def late_arrivals(spark: SparkSession, target: str) -> DataFrame:
    """Events that came when their visit already knew a later one, replays among them.

    A visit's batches are one row each, with the latest event of the batches before; only its
    events of later batches are held against that.
    """
    events = _batches(spark, f"{target}/events", _EVENT)
    key = list(schema.VISIT_KEY)
    earlier = Window.partitionBy(*key).orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    known = (
        events.groupBy(*key, "batch")
        .agg(F.max("at").alias("newest"))
        .withColumn("already", F.max("newest").over(earlier))
        .where("already IS NOT NULL")
        .drop("newest")
    )
    same = reduce(
        Column.__and__, [F.col(f"e.{c}").eqNullSafe(F.col(f"k.{c}")) for c in [*key, "batch"]]
    )
    late = events.alias("e").join(known.alias("k"), same & (F.col("e.at") < F.col("k.already")))
    return late.select(*[f"e.{c}" for c in key], "e.timestamp", "e.action", "e.batch")
