"""Ledgers on shared storage.

Every run adds its rows in a folder of its own, partitioned by study and datatype:

    <root>/events/run=<id>/by_study=<study>/by_datatype=<datatype>/*.parquet
    <root>/marks/run=<id>/*.parquet      latest timestamp and count per ledger
    <root>/<kind>/run=<id>/*.parquet     rows set aside: quarantine, late, taken (the files read)

A run counts once Spark's own success marker is in its folder, so readers never see
part of a run and a failed run is simply repeated. Nothing that is read is ever
overwritten. Watermarks come from the small marks tables; no run has to scan the
history to find where it stopped.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tallybook import schema
from tallybook.operators.clustering import clustered
from tallybook.operators.validation import conform
from tallybook.sources import folders

MARKS = T.StructType(
    [
        T.StructField("study", T.StringType()),
        T.StructField("datatype", T.StringType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("event_count", T.LongType()),
    ]
)
_PART = "~part-"
# Each row group tells which participants it cannot hold; the filter's size follows their number.
_BLOOM = {
    "parquet.bloom.filter.enabled#ptid": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
LOOKED_UP = 10  # participants that a scan's filter can name; Spark pushes no longer lists as equalities
_BY = {"by_study": "study", "by_datatype": "datatype"}


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema.LEDGER)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One ledger from a parquet path, in ledger types; empty when the path is missing.

    Only a missing path means empty. Any other failure raises, so that a later save
    cannot replace history that merely could not be read.
    """
    try:
        return conform(spark.read.parquet(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty_ledger(spark)
        raise


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An SQL table over a saved ledger; dropping it leaves the files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def check_template(template: str) -> str:
    """The template itself, or an error naming the placeholders it lacks."""
    missing = [p for p in ("{study}", "{datatype}") if p not in template]
    if missing:
        raise ValueError(f"template lacks placeholders: {', '.join(missing)}")
    return template


def template_key(template: str, study: str, datatype: str) -> str:
    return check_template(template).format(study=study, datatype=datatype)


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _run_path(self, kind: str, run_id: str) -> str:
        return f"{self.root}/{kind}/run={run_id}"

    def _finished_runs(self, kind: str) -> list[str]:
        """Runs whose folder carries Spark's success marker."""
        marks = folders.matching(self.spark, f"{self.root}/{kind}/run=*/_SUCCESS")
        return [m.split("/")[-2].removeprefix("run=") for m in marks]

    def finished_runs(self, kind: str) -> list[str]:
        """Runs that have set rows of a kind aside."""
        return self._finished_runs(kind)

    def _finished(self, kind: str, run_id: str) -> bool:
        return folders.exists(self.spark, f"{self._run_path(kind, run_id)}/_SUCCESS")

    def is_committed(self, run_id: str) -> bool:
        return self._finished("events", run_id)

    def committed_runs(self) -> list[str]:
        return self._finished_runs("events")

    @staticmethod
    def part_id(run_id: str, study: str, datatype: str) -> str:
        """Run id for one ledger of a run that is saved ledger by ledger."""
        digest = hashlib.sha256(f"{study}\0{datatype}".encode()).hexdigest()
        return f"{run_id}{_PART}{digest[:16]}"

    def committed_parts(self, run_id: str) -> list[str]:
        """Parts of this run; no other run's id can look like one."""
        return [r for r in self.committed_runs() if r.rpartition(_PART)[0] == run_id]

    def exists(self) -> bool:
        return bool(self.committed_runs())

    def events(
        self,
        study: str | None = None,
        datatype: str | None = None,
        runs: Sequence[str] | None = None,
    ) -> DataFrame:
        """Ledger rows of the committed runs; study and datatype prune folders."""
        runs = self.committed_runs() if runs is None else runs
        if not runs:
            return empty_ledger(self.spark)
        stored = T.StructType(
            [*schema.LEDGER.fields, *[T.StructField(c, T.StringType()) for c in _BY]]
        )
        rows = (
            self.spark.read.schema(stored)
            .option("basePath", f"{self.root}/events")
            .parquet(*[self._run_path("events", r) for r in runs])
        )
        if study is not None:
            rows = rows.filter(_in_folder("by_study", study) & (F.col("study") == study))
        if datatype is not None:
            rows = rows.filter(
                _in_folder("by_datatype", datatype) & (F.col("datatype") == datatype)
            )
        return rows.select(*schema.LEDGER_COLUMNS)

    def events_of(self, ptids: Sequence[str], **ledger: str) -> DataFrame:
        """Events of a few participants; row groups whose Bloom filter knows none are not read.

        For more than ``LOOKED_UP`` join with ``joins.null_safe_semi`` instead.
        """
        if not 0 < len(ptids) <= LOOKED_UP:
            raise ValueError(f"name 1 to {LOOKED_UP} participants, or join with a table of them")
        return self.events(**ledger).filter(F.col("ptid").isin(*ptids))

    def create_view(self, name: str) -> None:
        """Offer the committed ledger rows to SQL."""
        self.events().createOrReplaceTempView(name)

    def marks(self) -> DataFrame:
        """Watermark and event count per ledger."""
        runs = self.committed_runs()
        with_marks = set(self._finished_runs("marks"))
        noted = [r for r in runs if r in with_marks]
        scanned = [r for r in runs if r not in with_marks]
        parts = self.spark.createDataFrame([], MARKS)
        if noted:
            paths = [self._run_path("marks", r) for r in noted]
            parts = self.spark.read.schema(MARKS).parquet(*paths)
        if scanned:
            parts = parts.unionByName(_marks_of(self.events(runs=scanned)))
        return parts.groupBy(*schema.GROUP_KEY).agg(
            F.max("watermark").alias("watermark"),
            F.sum("event_count").alias("event_count"),
        )

    def append(self, rows: DataFrame, run_id: str, files: int | None = None) -> int:
        """Add rows as one run and return how many there are.

        A committed run id is not written again: with the same rows, or none, nothing
        happens; with other rows it raises, as they would be lost.

        Rows are rebalanced by ledger: small ledgers share tasks, and a ledger holding
        most of the rows is split over many. Each file is sorted by time, so row-group
        statistics prune time ranges. With ``files``, rows are laid out over about as many ranges
        along a curve through time and center instead, so filters on either leave files out.
        """
        path = self._run_path("events", run_id)
        if self.is_committed(run_id):
            _require_same(conform(rows), self.events(runs=[run_id]), run_id)
        else:
            placed = conform(rows).withColumns({by: F.col(c) for by, c in _BY.items()})
            if files is None:
                laid = placed.hint("rebalance", *_BY).sortWithinPartitions(*_BY, "timestamp")
            else:
                laid = clustered(placed, "timestamp", "center_label", files, list(_BY))
            (
                laid.write.mode("overwrite")
                .options(**_BLOOM)
                .partitionBy(*_BY)
                .parquet(path)
            )
        if not self._finished("marks", run_id):
            marks = _marks_of(self.events(runs=[run_id]))
            marks.write.mode("overwrite").parquet(self._run_path("marks", run_id))
        noted = self.spark.read.schema(MARKS).parquet(self._run_path("marks", run_id))
        return noted.agg(F.coalesce(F.sum("event_count"), F.lit(0))).first()[0]

    def set_aside(self, kind: str, rows: DataFrame, run_id: str) -> None:
        """Keep rows of a run that do not go into the ledgers, under the same rule."""
        path = self._run_path(kind, run_id)
        if self._finished(kind, run_id):
            _require_same(rows, self.spark.read.schema(rows.schema).parquet(path), run_id)
        else:
            rows.write.mode("overwrite").parquet(path)

    def aside(self, kind: str) -> DataFrame | None:
        """All rows of a kind that were set aside, with their run; None if there are none."""
        runs = self._finished_runs(kind)
        if not runs:
            return None
        reader = self.spark.read.option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*[self._run_path(kind, r) for r in runs])

    def aside_runs(self, kind: str, runs: Sequence[str], columns: T.StructType) -> DataFrame:
        """Rows of a kind that some runs set aside, without their run; none for no runs."""
        if not runs:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*[self._run_path(kind, r) for r in runs])

    def rewrite(
        self, target_root: str, run_id: str = "rewrite", files: int | None = None
    ) -> LedgerStore:
        """Copy all committed rows into a fresh store as one run, and check the count.

        With ``files``, the copy is clustered by time and center over about so many files.
        """
        if folders.exists(self.spark, target_root):
            raise ValueError(f"{target_root} already exists; rewrite needs a fresh folder")
        target = LedgerStore(self.spark, target_root)
        written = target.append(self.events(), run_id, files)
        expected = self.marks().agg(F.coalesce(F.sum("event_count"), F.lit(0))).first()[0]
        if written != expected:
            raise RuntimeError(f"rewrote {written} rows of {expected}")
        return target

    def export(self, target_root: str, template: str) -> list[str]:
        """Write each ledger as its own parquet table at its template path.

        One pruned read per ledger; the loop is over ledgers, never over rows.
        """
        check_template(template)
        paths = []
        for group in self.marks().toLocalIterator():
            path = f"{target_root}/{template_key(template, group.study, group.datatype)}"
            written = save_ledger(self.events(group.study, group.datatype), path)
            if written != group.event_count:
                raise RuntimeError(f"exported {written} rows of {group.event_count} to {path}")
            paths.append(path)
        return sorted(paths)


def save_ledger(rows: DataFrame, path: str) -> int:
    """Replace one ledger table and return its row count.

    The new table is written and counted beside the old one, which is moved away only then, so
    a crash leaves one of the two whole. Rows are spread without a key, so equal
    timestamps or copies cannot crowd one task, and each file is sorted by time.
    """
    spark = rows.sparkSession
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    seen = Observation("ledger_rows")
    spread = conform(rows).observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance")
    spread.sortWithinPartitions("timestamp").write.parquet(fresh)
    written = spark.read.schema(schema.LEDGER).parquet(fresh).count()
    if written != seen.get["rows"]:
        raise RuntimeError(f"{fresh} holds {written} rows of {seen.get['rows']}")
    if folders.exists(spark, path):
        folders.rename(spark, path, old)
    folders.rename(spark, fresh, path)
    folders.remove(spark, old)
    return written


def _in_folder(by: str, value: str) -> Column:
    """Folder filter; an empty value is stored in the null folder."""
    return F.col(by).isNull() if value == "" else F.col(by) == value


def _content(rows: DataFrame) -> tuple:
    """Count and order-free digest of rows."""
    each = F.xxhash64(*[F.col(c).cast("string") for c in rows.columns])
    low = F.sum(F.pmod(each, F.lit(1 << 31)))
    return tuple(rows.agg(F.count(F.lit(1)), F.bit_xor(each), low).first())


def _require_same(rows: DataFrame, stored: DataFrame, run_id: str) -> None:
    new = _content(rows)
    if new[0] and new != _content(stored.select(rows.columns)):
        raise ValueError(f"run {run_id} is committed with other rows")


def _marks_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*schema.GROUP_KEY).agg(
        F.max("timestamp").alias("watermark"), F.count(F.lit(1)).alias("event_count")
    )
