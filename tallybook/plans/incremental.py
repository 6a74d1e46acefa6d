"""The incremental ledger run.

raw JSON -> checked rows (staged once) -> production rows -> split at each ledger's
watermark -> one append. Late rows, quarantined rows and counts are kept as tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook import schema, session
from tallybook.operators import filters, validation
from tallybook.sources import folders
from tallybook.sources.ledger_store import LedgerStore

# --- fixed values: run outcomes -----------------------------------------------------
OK, PARTIAL, FAILED = "ok", "partial", "failed"


@dataclass(frozen=True)
class RunResult:
    """Outcome of a run. All frames read the staged tables of the run."""

    run_id: str
    status: str
    counts: DataFrame  # one row: files retrieved / ok / failed, sandbox rows
    groups: DataFrame  # one row per ledger: events, new and late events, status, error
    errors: DataFrame  # source_key, errors
    late: DataFrame  # ledger rows at or before their watermark
    staging: str  # folder of the staged tables

    def keep(self, store: LedgerStore) -> None:
        """Store the quarantined and the late rows beside the ledgers."""
        store.set_aside("quarantine", self.errors, self.run_id)
        store.set_aside("late", self.late, self.run_id)

    def discard(self) -> None:
        """Delete the staged tables; the frames cannot be read afterwards."""
        folders.remove(self.counts.sparkSession, self.staging)


def split_by_watermark(events: DataFrame, marks: DataFrame) -> DataFrame:
    """Add `is_new`: later than the ledger's watermark, or no ledger yet.

    Marks hold one row per ledger. Spark broadcasts them where their measured size allows
    it, else adaptive execution splits a ledger that holds most of the events.
    """
    marks = marks.select(
        F.col("study").alias("_study"), F.col("datatype").alias("_datatype"), "watermark"
    )
    same = (F.col("study") == F.col("_study")) & (F.col("datatype") == F.col("_datatype"))
    return (
        events.join(marks, same, "left")
        .withColumn(
            "is_new",
            F.col("watermark").isNull() | (F.col("timestamp") > F.col("watermark")),
        )
        .drop("_study", "_datatype", "watermark")
    )


def new_events(events: DataFrame, marks: DataFrame) -> DataFrame:
    return split_by_watermark(events, marks).filter("is_new").drop("is_new")


def late_events(events: DataFrame, marks: DataFrame) -> DataFrame:
    """Events a run leaves out because their ledger has already moved past them."""
    return split_by_watermark(events, marks).filter("NOT is_new").drop("is_new")


def merge(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows and new rows, nothing removed."""
    return ledger.unionByName(new)


def stage(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Write rows once and read them back; no later step computes them again.

    They are read in the given session: the rows of a stream's batch come from a
    session of the stream's own, which may have adaptive execution switched off.
    """
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def run_incremental(
    raw: DataFrame,
    store: LedgerStore,
    run_id: str | None = None,
    marks: DataFrame | None = None,
    strict: bool = False,
) -> RunResult:
    """Extend the ledgers by the raw (source_key, value) rows.

    `marks` replaces the store's own watermarks (a stream keeps one set for all of
    its batches). Nothing is written to the store when no event is new.
    """
    staging = session.scratch_path(store.spark, "run")
    staged = stage_checked(store.spark, raw, f"{staging}/checked", strict)
    return run_staged(staged, store, staging, run_id, marks)


def stage_checked(spark: SparkSession, raw: DataFrame, path: str, strict: bool = False) -> DataFrame:
    """Check raw (source_key, value) rows and write them once."""
    slim = raw.select("source_key", "value")
    return stage(spark, validation.check_visit_events(slim, strict), path)


def run_staged(
    staged: DataFrame,
    store: LedgerStore,
    staging: str,
    run_id: str | None = None,
    marks: DataFrame | None = None,
) -> RunResult:
    """Extend the ledgers by rows that were checked and written; `staging` is the folder they are in."""
    spark = store.spark
    run_id = run_id or uuid.uuid4().hex
    valid = validation.valid_rows(staged)
    # Stored, so that the result frames keep the watermarks of this run after its append.
    marked = stage(spark, store.marks() if marks is None else marks, f"{staging}/marks")
    split = split_by_watermark(filters.drop_sandbox(valid), marked)

    groups = split.groupBy(*schema.GROUP_KEY).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_new").alias("new_events"),
        F.count_if(~F.col("is_new")).alias("late_events"),
    )
    groups = stage(spark, groups, f"{staging}/groups")
    expected = groups.agg(F.coalesce(F.sum("new_events"), F.lit(0))).first()[0]
    fresh = split.filter("is_new").drop("is_new", "source_key")
    failures, reason = _append(fresh, store, run_id, expected, groups)
    outcome = _group_rows(groups, failures, reason)
    return RunResult(
        run_id=run_id,
        status=overall_status(outcome).first()["status"] if failures else OK,
        counts=_run_counts(staged),
        groups=outcome,
        errors=validation.error_rows(staged),
        late=split.filter("NOT is_new").drop("is_new", "source_key"),
        staging=staging,
    )


def _append(
    fresh: DataFrame, store: LedgerStore, run_id: str, expected: int, groups: DataFrame
) -> tuple[dict[tuple[str, str], str], str | None]:
    """Append all ledgers in one job; if that fails, one by one.

    Returns the error text per failed ledger, and why the one job failed. A repeated run id continues where it
    stopped: ledgers that were saved one by one stay saved and are not added again.
    """
    reason = None
    if expected == 0:
        return {}, reason
    one_by_one = store.committed_parts(run_id)
    if not one_by_one:
        try:
            _append_exactly(fresh, store, run_id, expected)
            return {}, reason
        except Exception as e:
            if store.is_committed(run_id):
                raise
            reason = str(e).split("\n")[0]
    failures = {}
    for group in groups.filter("new_events > 0").toLocalIterator():
        mine = fresh.filter(
            (F.col("study") == group.study) & (F.col("datatype") == group.datatype)
        )
        part = store.part_id(run_id, group.study, group.datatype)
        try:
            _append_exactly(mine, store, part, group.new_events)
        except Exception as e:
            failures[(group.study, group.datatype)] = str(e).split("\n")[0]
    return failures, reason


def _append_exactly(rows: DataFrame, store: LedgerStore, run_id: str, expected: int) -> None:
    written = store.append(rows, run_id)
    if written != expected:
        raise RuntimeError(f"run {run_id} holds {written} rows, expected {expected}")


def _group_rows(groups: DataFrame, failures: dict, reason: str | None = None) -> DataFrame:
    """Group counts with status; unchanged ledgers are 'unchanged'.

    A ledger that had to be saved by itself keeps why the job for all of them failed.
    """
    failed = groups.sparkSession.createDataFrame(
        [(s, d, e) for (s, d), e in failures.items()],
        "study string, datatype string, failure string",
    )
    is_new = F.col("new_events") > 0
    return (
        groups.join(failed, list(schema.GROUP_KEY), "left")
        .withColumn(
            "error", F.coalesce("failure", F.when(is_new, F.lit(reason).cast("string")))
        )
        .withColumn(
            "status",
            F.when(F.col("failure").isNotNull(), "failed")
            .when(is_new, "saved")
            .otherwise("unchanged"),
        )
        .drop("failure")
    )


def _run_counts(staged: DataFrame) -> DataFrame:
    ok = F.size("errors") == 0
    n = F.count(F.lit(1))
    return staged.agg(
        n.alias("files_retrieved"),
        F.count_if(ok).alias("files_ok"),
        F.count_if(~ok).alias("files_failed"),
        F.count_if(ok & filters.is_sandbox()).alias("filtered_events"),
    )


def overall_status(groups: DataFrame) -> DataFrame:
    """ok, partial or failed, with the number of ledgers saved and failed."""
    saved = F.count_if(F.col("status") == "saved")
    failed = F.count_if(F.col("status") == "failed")
    return groups.agg(
        saved.alias("groups_processed"), failed.alias("groups_failed")
    ).withColumn(
        "status",
        F.when(F.col("groups_failed") == 0, OK)
        .when(F.col("groups_processed") > 0, PARTIAL)
        .otherwise(FAILED),
    )
