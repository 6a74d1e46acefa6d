"""Report counts that are kept up run by run.

Every committed run of a store gets one small table of partial counts, made from that run's rows alone.
Counts over disjoint rows add up, so a report is a sum over those tables and never reads the ledger
again. When many runs have gathered, their tables are folded into one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tallybook import schema
from tallybook.operators import profiles
from tallybook.sources.ledger_store import LedgerStore

DIMENSIONS = (*schema.GROUP_KEY, "center_label", "module", "packet", "action")
_COUNTS, _FOLDED, _FOLDED_RUNS = "counts", "counts-folded", "counts-folded-runs"


def partial_counts(events: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Events and their first and last time per combination of the dimensions."""
    return events.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )


def merged(parts: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Partial counts of any runs, summed to some of their dimensions; NULL is a value."""
    return parts.groupBy(*fields).agg(
        F.sum("n_events").alias("n_events"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


class ReportCounts:
    """The kept counts of one store."""

    def __init__(self, store: LedgerStore):
        self.store = store

    def _folded(self) -> tuple[str | None, set[str]]:
        """The fold that covers most runs, and those runs."""
        covered = self.store.aside(_FOLDED_RUNS)
        if covered is None:
            return None, set()
        latest = (
            covered.groupBy(F.col("run").cast("string").alias("fold"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "fold")
            .first()["fold"]
        )
        runs = covered.where(F.col("run").cast("string") == latest).select("covered_run")
        return latest, {r["covered_run"] for r in runs.toLocalIterator()}

    def refresh(self) -> int:
        """Count the runs that have no counts yet, each from its own rows; returns how many."""
        have = set(self.store.finished_runs(_COUNTS)) | self._folded()[1]
        missing = [r for r in self.store.committed_runs() if r not in have]
        for run in missing:
            self.store.set_aside(_COUNTS, partial_counts(self.store.events(runs=[run])), run)
        return len(missing)

    def parts(self) -> DataFrame:
        """Partial counts that together cover every counted run once."""
        fold, covered = self._folded()
        single = [r for r in self.store.finished_runs(_COUNTS) if r not in covered]
        columns = [*DIMENSIONS, "n_events", "first_at", "last_at"]
        empty = partial_counts(self.store.events(runs=[])).select(columns)
        rows = self.store.aside_runs(_COUNTS, single, empty.schema)
        if fold is not None:
            rows = rows.unionByName(self.store.aside_runs(_FOLDED, [fold], empty.schema))
        return rows

    def fold(self) -> None:
        """Replace the tables of all counted runs by one; readers see either, never both.

        The list of covered runs is written last and decides which fold is read.
        """
        _, covered = self._folded()
        runs = sorted(covered | set(self.store.finished_runs(_COUNTS)))
        if not runs or set(runs) == covered:
            return
        name = "fold-" + hashlib.sha256("\0".join(runs).encode()).hexdigest()[:16]
        self.store.set_aside(_FOLDED, merged(self.parts(), DIMENSIONS), name)
        listed = self.store.spark.createDataFrame([(r,) for r in runs], "covered_run string")
        self.store.set_aside(_FOLDED_RUNS, listed, name)

    def by(self, *fields: str) -> DataFrame:
        """Event counts by any of the dimensions, sorted by them."""
        return merged(self.parts(), fields).select(*fields, "n_events").orderBy(*fields)

    def values(self, field: str) -> DataFrame:
        """Sorted values of a dimension, NULL left out."""
        found = merged(self.parts(), [field]).select(field)
        return found.where(F.col(field).isNotNull()).orderBy(field)

    def pass_rate(self, *fields: str) -> DataFrame:
        """Passed share of all QC outcomes by some dimensions; groups without outcomes are absent."""

        def of(action: str):
            return F.coalesce(F.sum(F.when(F.col("action") == action, F.col("n_events"))), F.lit(0))

        passed, failed = (of(a) for a in ("pass-qc", "not-pass-qc"))
        return (
            self.parts()
            .groupBy(*fields)
            .agg(passed.alias("passed"), failed.alias("not_passed"))
            .where("passed + not_passed > 0")
            .withColumn(
                "pass_rate", F.col("passed").cast("double") / (F.col("passed") + F.col("not_passed"))
            )
        )


class ColumnProfiles:
    """Column profiles of one store, kept per run."""

    KIND = "profiles"

    def __init__(self, store: LedgerStore):
        self.store = store

    def refresh(self) -> int:
        """Profile the runs that have no profile yet; returns how many."""
        have = set(self.store.finished_runs(self.KIND))
        missing = [r for r in self.store.committed_runs() if r not in have]
        for run in missing:
            rows = self.store.events(runs=[run])
            self.store.set_aside(self.KIND, profiles.profile(rows), run)
        return len(missing)

    def current(self) -> DataFrame:
        """One row per ledger column, over all profiled runs."""
        runs = self.store.finished_runs(self.KIND)
        columns = T.StructType.fromDDL(profiles.COLUMNS)
        parts = self.store.aside_runs(self.KIND, runs, columns)
        return profiles.estimates(profiles.merge_profiles(parts))
