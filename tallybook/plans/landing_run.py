"""Incremental runs over a landing folder that open only files no earlier run took.

listing (in tasks) -> without the taken files -> read -> incremental run -> the files are noted as taken

A landing whose files do not fit the disk together is opened part by part (`LandingIntake`), and its ledgers
are extended once, when all parts were read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook import schema, session
from tallybook.plans.incremental import OK, RunResult, run_staged, stage, stage_checked
from tallybook.sources import landing
from tallybook.sources.ledger_store import LedgerStore

TAKEN = "taken"


@dataclass(frozen=True)
class LandingRun:
    """Outcome of a run over a landing folder."""

    run_id: str
    status: str
    n_files: int  # files opened by this run
    files: DataFrame  # their source_key, size and modified
    result: RunResult | None  # None where there was nothing to open


class LandingIntake:
    """A run over a landing of which only a part lies there at a time.

    `open` lists what is there, opens the files that no earlier run took, and writes their rows checked; its
    files may then go. `close` extends the ledgers by the rows of all parts, under the watermarks of that
    moment. Nothing is in the store before. A file must not lie in two parts of a run.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: LedgerStore,
        run_id: str | None = None,
        layout: str = "objects",
        pattern: str | None = schema.EVENT_FILE_PATTERN,
        strict: bool = False,
    ):
        self.spark, self.store = spark, store
        self.run_id = run_id or uuid.uuid4().hex
        self.layout, self.pattern, self.strict = layout, pattern, strict
        self.n_files = 0
        self._taken = store.aside(TAKEN)
        self._staging = session.scratch_path(spark, "run")
        self._fresh = session.scratch_path(spark, "fresh-files")
        self._parts = 0
        self._checked: list[str] = []
        self._columns = None

    def open(self, path: str) -> int:
        """Take in the files that lie below a folder now; returns how many of them were new."""
        listed = landing.list_landing(self.spark, path)
        wanted = landing.select_landed(listed, self.layout, self.pattern)
        fresh = stage(
            self.spark,
            landing.untaken(wanted, _near(self._taken, listed)),
            f"{self._fresh}/{self._parts}",
        )
        self._parts += 1
        n_files = fresh.count()
        if n_files:
            if self.layout == "lines":
                raw = landing.read_lines(fresh)
            else:
                raw = landing.read_objects(fresh, n_files)
            place = f"{self._staging}/checked/{self._parts}"
            self._columns = stage_checked(self.spark, raw, place, self.strict).schema
            self._checked.append(place)
            self.n_files += n_files
        return n_files

    def close(self) -> LandingRun:
        """Extend the ledgers, keep quarantined and late rows, and note the files as taken."""
        parts = [f"{self._fresh}/{i}" for i in range(self._parts)]
        fresh = self.spark.read.schema(landing.LISTING).parquet(*parts)
        if self.n_files == 0:
            return LandingRun(self.run_id, OK, 0, fresh, None)
        staged = self.spark.read.schema(self._columns).parquet(*self._checked)
        result = run_staged(staged, self.store, self._staging, self.run_id)
        result.keep(self.store)
        if result.status == OK:
            # In key order, so that a later run over a part reads little of it.
            self.store.set_aside(TAKEN, fresh.sort("source_key"), self.run_id)
        return LandingRun(self.run_id, result.status, self.n_files, fresh, result)


def _near(taken: DataFrame | None, listed: DataFrame) -> DataFrame | None:
    """Taken files between the first and the last listed key; no others can be among the listed."""
    if taken is None:
        return None
    low, high = listed.agg(F.min("source_key"), F.max("source_key")).first()
    return taken.where(F.col("source_key").between(low, high))


def run_landing(
    spark: SparkSession,
    path: str,
    store: LedgerStore,
    run_id: str | None = None,
    layout: str = "objects",
    pattern: str | None = schema.EVENT_FILE_PATTERN,
    strict: bool = False,
) -> LandingRun:
    """Extend the ledgers by the files that came since the last run.

    A file is known by its path, size and time: one written anew is read again, and what it repeats is
    late by then. Without new files nothing is opened, parsed or written. Quarantined and late rows are
    kept in the store, since the next run does not see their files again. Files are noted as taken
    last, and only if every ledger was saved: after a crash or a partial failure the next run reads
    them again, and the ledgers that were saved already leave the repeated rows out.
    """
    intake = LandingIntake(spark, store, run_id, layout, pattern, strict)
    intake.open(path)
    return intake.close()
