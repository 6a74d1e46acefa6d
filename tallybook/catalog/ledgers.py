"""Ledger storage, incremental runs and the stream, over the whole event table."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallybook import schema, session
from tallybook.catalog.base import query, table, visit_events
from tallybook.catalog.ingest import EXPECTED_ERRORS, EXPECTED_VALID, ledger_view, raw_events
from tallybook.operators import counts, filters, validation
from tallybook.plans import incremental, landing_run
from tallybook.sources import event_files, folders, landing
from tallybook.sources.ledger_store import LedgerStore, load_ledger, save_ledger, template_key
from tallybook.streaming import event_stream

_CUT = "2024-01-16 00:00:00"
_LEDGER = """action, study, pipeline_adcid, project_label, center_label, gear_name, ptid,
 visit_date, visit_number, datatype, module, packet, timestamp"""
_PRODUCTION = f"SELECT {_LEDGER} FROM visit_events WHERE project_label NOT LIKE 'sandbox-%'"
# What an ordered sequence of runs over the raw JSON leaves in the ledgers.
_EXPECTED_LEDGER = f"""SELECT {_LEDGER} FROM expected_valid
  WHERE project_label NOT LIKE 'sandbox-%'"""


def _fresh_store(spark) -> LedgerStore:
    return LedgerStore(spark, session.scratch_path(spark, "ledgers"))


def _production(spark, sf_dir) -> DataFrame:
    return filters.drop_sandbox(visit_events(spark, sf_dir))


@query("ledger_roundtrip", _PRODUCTION)
def ledger_roundtrip(spark, sf_dir):
    path = f"{session.scratch_path(spark, 'ledger')}/events.parquet"
    save_ledger(_production(spark, sf_dir), path)
    return ledger_view(load_ledger(spark, path))


@query(
    "ledger_empty",
    "SELECT study, datatype, COUNT(*) AS event_count FROM visit_events GROUP BY study, datatype",
)
def ledger_empty(spark, sf_dir):
    missing = load_ledger(spark, session.scratch_path(spark, "no-ledger"))
    new = validation.conform(visit_events(spark, sf_dir))
    return counts.group_counts(incremental.merge(missing, new))


# Every ninth event is of a study without a name, which is a ledger as any other.
_NAMED = f"""SELECT * REPLACE (CASE WHEN EXTRACT(DAY FROM timestamp) % 9 = 0 THEN '' ELSE study END
 AS study) FROM ({_PRODUCTION}) q"""


def _named(spark, sf_dir) -> DataFrame:
    unnamed = F.dayofmonth("timestamp") % 9 == 0
    return _production(spark, sf_dir).withColumn(
        "study", F.when(unnamed, "").otherwise(F.col("study"))
    )


@query("partitioned_sink", f"SELECT study AS ledger, {_LEDGER} FROM ({_NAMED}) p")
def partitioned_sink(spark, sf_dir):
    """Every ledger of a store, each read by its own pruned filter."""
    store = _fresh_store(spark)
    store.append(_named(spark, sf_dir), "first")
    ledgers = [
        store.events(g.study, g.datatype).withColumn("ledger", F.lit(g.study))
        for g in store.marks().collect()
    ]
    return ledger_view(functools.reduce(DataFrame.unionByName, ledgers), "ledger")


@query(
    "template_sink",
    f"SELECT datatype AS folder, {_LEDGER} FROM ({_NAMED}) p",
)
def template_sink(spark, sf_dir):
    """Every ledger, exported to its template path and read back."""
    store = _fresh_store(spark)
    store.append(_named(spark, sf_dir), "first")
    target = session.scratch_path(spark, "exported")
    paths = store.export(target, "{datatype}/of-{study}/events.parquet")
    folder = F.regexp_extract(F.input_file_name(), "/(form|dicom)/of-[^/]*/events.parquet/", 1)
    rows = spark.read.parquet(*paths).withColumn("folder", folder)
    return ledger_view(rows, "folder")


@query(
    "ledger_sorted",
    f"SELECT {_LEDGER}, 0 AS out_of_order FROM ({_PRODUCTION}) p",
)
def ledger_sorted(spark, sf_dir):
    """Rows of a stored ledger, flagged when the row before them in the file is later."""
    path = session.scratch_path(spark, "sorted")
    save_ledger(_production(spark, sf_dir), path)
    stored = spark.read.parquet(path).withColumns(
        {"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")}
    )
    before = F.lag("timestamp").over(W.partitionBy("file").orderBy("row"))
    late = F.coalesce((F.col("timestamp") < before).cast("int"), F.lit(0))
    return ledger_view(stored.withColumn("out_of_order", late), "out_of_order")


@query(
    "scan_pruned",
    """SELECT center_label, action, timestamp FROM visit_events
       WHERE project_label NOT LIKE 'sandbox-%' AND center_label = 'center02'""",
)
def scan_pruned(spark, sf_dir):
    store = _fresh_store(spark)
    store.append(_production(spark, sf_dir), "first")
    picked = filters.by_center(store.events(), "center02")
    return picked.select(
        "center_label", "action", F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    )


@query(
    "sql_center_action",
    """SELECT center_label, action, COUNT(*) AS event_count FROM visit_events
       WHERE project_label NOT LIKE 'sandbox-%' AND visit_date >= '2024-01-08'
       GROUP BY center_label, action""",
)
def sql_center_action(spark, sf_dir):
    store = _fresh_store(spark)
    store.append(_production(spark, sf_dir), "first")
    return spark.sql(
        """SELECT center_label, action, COUNT(*) AS event_count FROM {ledger}
           WHERE visit_date >= '2024-01-08' GROUP BY center_label, action
           ORDER BY center_label, action""",
        ledger=store.events(),
    )


@query(
    "ledger_clustered",
    f"""SELECT {_LEDGER} FROM visit_events WHERE project_label NOT LIKE 'sandbox-%'
        AND center_label = 'center05' AND timestamp >= TIMESTAMP '{_CUT}'""",
)
def ledger_clustered(spark, sf_dir):
    """One center from a day on, from a compact store laid out along time and center."""
    store = _fresh_store(spark)
    for half in (0, 1):
        part = _production(spark, sf_dir).where(F.col("event_id") % 2 == half)
        store.append(part, f"run{half}")
    compact = store.rewrite(session.scratch_path(spark, "compact"), files=16)
    picked = filters.by_center(compact.events(), "center05")
    return ledger_view(picked.where(F.col("timestamp") >= F.lit(_CUT).cast("timestamp")))


_FEW = ("110007", "110042", "110013", "119999")


@query(
    "participant_lookup",
    f"""SELECT {_LEDGER} FROM visit_events WHERE project_label NOT LIKE 'sandbox-%'
        AND ptid IN {_FEW}""",
)
def participant_lookup(spark, sf_dir):
    """Events of four participants from a stored ledger, through its Bloom filters."""
    store = _fresh_store(spark)
    store.append(_production(spark, sf_dir), "first")
    return ledger_view(store.events_of(_FEW))


# --- watermarks -----------------------------------------------------------------------

_EARLY_MARKS = f"""SELECT study, datatype, MAX(timestamp) AS watermark FROM visit_events
  WHERE timestamp < TIMESTAMP '{_CUT}' AND NOT (study = 'leads' AND datatype = 'dicom')
  GROUP BY study, datatype"""


def _early_marks(events: DataFrame) -> DataFrame:
    """Watermarks of ledgers that stop at the cut; one ledger does not exist yet."""
    early = events.filter(F.col("timestamp") < F.lit(_CUT).cast("timestamp_ntz"))
    known = ~((F.col("study") == "leads") & (F.col("datatype") == "dicom"))
    return counts.watermarks(early.filter(known))


@query(
    "new_events",
    """SELECT e.* FROM visit_events e LEFT JOIN marks m
       ON e.study = m.study AND e.datatype = m.datatype
       WHERE m.watermark IS NULL OR e.timestamp > m.watermark""",
    marks=_EARLY_MARKS,
)
def new_events(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    return incremental.new_events(events, _early_marks(events))


@query(
    "late_events",
    """SELECT e.* FROM visit_events e JOIN marks m
       ON e.study = m.study AND e.datatype = m.datatype WHERE e.timestamp <= m.watermark""",
    marks=_EARLY_MARKS,
)
def late_events(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    return incremental.late_events(events, _early_marks(events))


@query("merge_union", "SELECT * FROM visit_events UNION ALL SELECT * FROM visit_events")
def merge_union(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    return incremental.merge(events, events.select(*reversed(events.columns)))


# --- runs -----------------------------------------------------------------------------


def _two_runs(spark, sf_dir):
    """A run over the early events, then one over everything."""
    store = _fresh_store(spark)
    raw = raw_events(spark, sf_dir)
    early = raw.filter(F.col("event_time") < F.lit(_CUT).cast("timestamp_ntz"))
    first = incremental.run_incremental(early, store, "first")
    second = incremental.run_incremental(raw, store, "second")
    return store, first, second


# Shifting by the offset moves a few early events past later ones, which then count
# as late. The expected ledger follows the watermark rule itself.
_RUN_TABLES = {
    "expected_valid": EXPECTED_VALID,
    "production": """SELECT v.*, e.timestamp AS event_time FROM expected_valid v
        JOIN visit_events e ON v.event_id = e.event_id
        WHERE v.project_label NOT LIKE 'sandbox-%'""",
    "first_marks": f"""SELECT study, datatype, MAX(timestamp) AS watermark FROM production
        WHERE event_time < TIMESTAMP '{_CUT}' GROUP BY study, datatype""",
    "second_new": """SELECT p.* FROM production p LEFT JOIN first_marks m
        ON p.study = m.study AND p.datatype = m.datatype
        WHERE m.watermark IS NULL OR p.timestamp > m.watermark""",
    "two_run_ledger": f"""SELECT {_LEDGER} FROM production WHERE event_time < TIMESTAMP '{_CUT}'
        UNION ALL SELECT {_LEDGER} FROM second_new""",
}


@query("incremental_run", "SELECT * FROM two_run_ledger", **_RUN_TABLES)
def incremental_run(spark, sf_dir):
    store, _, _ = _two_runs(spark, sf_dir)
    return ledger_view(store.events())


@query(
    "run_summary",
    """SELECT p.study, p.datatype, COUNT(*) AS events, COUNT(n.event_id) AS new_events,
       COUNT(*) - COUNT(n.event_id) AS late_events,
       CASE WHEN COUNT(n.event_id) = 0 THEN 'unchanged' ELSE 'saved' END AS status
       FROM production p LEFT JOIN second_new n ON p.event_id = n.event_id
       GROUP BY p.study, p.datatype""",
    **_RUN_TABLES,
)
def run_summary(spark, sf_dir):
    _, _, second = _two_runs(spark, sf_dir)
    return second.groups.drop("error")


@query(
    "run_totals",
    """SELECT (SELECT COUNT(*) FROM visit_events) AS files_retrieved,
       (SELECT COUNT(*) FROM expected_valid) AS files_ok,
       (SELECT COUNT(*) FROM visit_events) - (SELECT COUNT(*) FROM expected_valid)
         AS files_failed,
       (SELECT COUNT(*) FROM expected_valid WHERE project_label LIKE 'sandbox-%')
         AS filtered_events""",
    expected_valid=EXPECTED_VALID,
)
def run_totals(spark, sf_dir):
    result = incremental.run_incremental(raw_events(spark, sf_dir), _fresh_store(spark), "only")
    return result.counts


@query(
    "run_status",
    """SELECT COUNT(DISTINCT (study, datatype)) AS groups_processed,
       CAST(0 AS BIGINT) AS groups_failed, 'ok' AS status FROM production""",
    expected_valid=EXPECTED_VALID,
    production=_RUN_TABLES["production"],
)
def run_status(spark, sf_dir):
    result = incremental.run_incremental(raw_events(spark, sf_dir), _fresh_store(spark), "only")
    return incremental.overall_status(result.groups)


class _OneLedgerFails(LedgerStore):
    """A store that runs out of space in the middle of one ledger."""

    def append(self, rows: DataFrame, run_id: str) -> int:
        last = (F.col("study") == "leads") & (F.col("datatype") == "dicom")
        error = F.raise_error(F.lit("no space left")).cast("string")
        return super().append(
            rows.withColumn("study", F.when(last, error).otherwise(F.col("study"))), run_id
        )


@query(
    "run_partial",
    """SELECT study, datatype, COUNT(*) AS new_events,
       CASE WHEN study = 'leads' AND datatype = 'dicom' THEN 'failed' ELSE 'saved' END AS status,
       CASE WHEN study = 'leads' AND datatype = 'dicom' THEN 0 ELSE COUNT(*) END AS stored,
       TRUE AS says_why, 'partial' AS run_status
       FROM production GROUP BY study, datatype""",
    expected_valid=EXPECTED_VALID,
    production=_RUN_TABLES["production"],
)
def run_partial(spark, sf_dir):
    """A run in which one ledger cannot be written: the others are saved, and the run says so."""
    store = _OneLedgerFails(spark, session.scratch_path(spark, "ledgers"))
    result = incremental.run_incremental(raw_events(spark, sf_dir), store, "only")
    stored = store.marks().select(*schema.GROUP_KEY, F.col("event_count").alias("stored"))
    return result.groups.join(stored, list(schema.GROUP_KEY), "left").select(
        *schema.GROUP_KEY,
        "new_events",
        "status",
        F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored"),
        F.coalesce(F.col("error").contains("no space left"), F.lit(False)).alias("says_why"),
        F.lit(result.status).alias("run_status"),
    )


@query(
    "ledger_exists",
    """SELECT s.study, d.datatype, EXISTS (SELECT 1 FROM visit_events e WHERE e.study = s.study
         AND e.datatype = d.datatype AND e.project_label NOT LIKE 'sandbox-%') AS present
       FROM (SELECT DISTINCT study FROM visit_events) s,
            (SELECT UNNEST(['form', 'dicom', 'apoe']) AS datatype) d""",
)
def ledger_exists(spark, sf_dir):
    """Whether each study has a ledger of each of three datatypes: one probe per path."""
    store = _fresh_store(spark)
    store.append(_production(spark, sf_dir), "first")
    target, template = session.scratch_path(spark, "exported"), "{study}/{datatype}/events.parquet"
    store.export(target, template)
    studies = [r["study"] for r in visit_events(spark, sf_dir).select("study").distinct().collect()]
    rows = [
        (s, d, folders.exists(spark, f"{target}/{template_key(template, s, d)}"))
        for s in studies
        for d in ("form", "dicom", "apoe")
    ]
    return spark.createDataFrame(rows, "study string, datatype string, present boolean")


@query(
    "rerun_noop",
    """SELECT 1 AS committed_runs, study, datatype, CAST(0 AS BIGINT) AS new_events,
       COUNT(*) AS event_count FROM production GROUP BY study, datatype""",
    expected_valid=EXPECTED_VALID,
    production=_RUN_TABLES["production"],
)
def rerun_noop(spark, sf_dir):
    """Two runs over one landing; the second finds every file taken and opens none."""
    folder = session.scratch_path(spark, "landing")
    raw_events(spark, sf_dir).select("value").write.text(folder)
    store = _fresh_store(spark)
    landing_run.run_landing(spark, folder, store, "first", layout="lines")
    again = landing_run.run_landing(spark, folder, store, "second", layout="lines")
    kept = store.marks().select(*schema.GROUP_KEY, "event_count")
    return kept.select(
        F.lit(len(store.committed_runs())).alias("committed_runs"),
        *schema.GROUP_KEY,
        F.lit(again.n_files).cast("bigint").alias("new_events"),
        "event_count",
    )


_OBJECT_ERRORS = """SELECT e.event_id, COALESCE(x.errors, '') AS errors
  FROM visit_events e LEFT JOIN expected_errors x ON e.event_id = x.event_id"""


# A local disk holds a block and a node for each file, ten times what is in it. A landing of more files lies
# there in slices of about so many; once a slice is read, the next one takes its files over.
_FILES_AT_ONCE = 2_000_000


def _slices(spark, sf_dir: str, folder: str) -> list[Column]:
    """Conditions on event_id: one of them holds for each event, each for about `_FILES_AT_ONCE` or fewer."""
    events, at = table(spark, sf_dir, "events"), F.col("event_id")
    n = -(-events.count() // _FILES_AT_ONCE)
    if n <= 1 or not landing.is_local(folder):
        return [F.lit(True)]
    shares = F.array(*[F.lit(k / n) for k in range(1, n)])
    cuts = sorted(set(events.agg(F.percentile_approx(at, shares, 100 * n)).first()[0] or []))
    if not cuts:
        return [F.lit(True)]
    between = [(at >= low) & (at < high) for low, high in zip(cuts, cuts[1:])]
    return [(at < cuts[0]) | at.isNull(), *between, at >= cuts[-1]]


def _land_objects(rows: DataFrame, folder: str) -> int:
    """One file per event with the event's time; some of those that are no JSON are empty files."""
    name = F.concat_ws(
        "/",
        F.floor(F.col("event_id") / 500).cast("string"),
        F.concat_ws("-", F.col("event_id").cast("string"), F.element_at(F.split("source_key", "/"), -1)),
    )
    value = F.when(F.col("value") != "not json", F.col("value"))
    landed = [name.alias("name"), value.alias("value")]
    if landing.is_local(folder):
        landed.append(F.col("event_time").cast("timestamp").alias("modified"))
    return landing.write_objects(rows.select(*landed), folder)


def _event_id_of(key: str):
    return F.regexp_extract(key, r"/(\d+)-log-[^/]*$", 1).cast("bigint")


@query("objects_ingest", _OBJECT_ERRORS, expected_errors=EXPECTED_ERRORS)
def objects_ingest(spark, sf_dir):
    """Every event landed as a file of its own, listed, read and checked; some files are empty."""
    folder, kept = session.scratch_path(spark, "objects"), session.scratch_path(spark, "checked")
    raw, parts = raw_events(spark, sf_dir), []
    for here in _slices(spark, sf_dir, folder):
        if parts:
            landing.spend_landing(folder)
        _land_objects(raw.where(here), folder)
        files = landing.select_landed(landing.list_landing(spark, folder), "objects")
        checked = validation.check_visit_events(landing.read_objects(files, files.count()))
        rows = checked.select(
            _event_id_of("source_key").alias("event_id"),
            F.array_join("errors", "; ").alias("errors"),
        )
        parts.append(f"{kept}/{len(parts)}")
        incremental.stage(spark, rows, parts[-1])
    return spark.read.schema(rows.schema).parquet(*parts)


@query(
    "landing_steps",
    f"""SELECT CASE WHEN e.timestamp < TIMESTAMP '{_CUT}' THEN 'first' ELSE 'second' END AS run,
          e.event_id, x.errors IS NOT NULL AS quarantined
        FROM visit_events e LEFT JOIN expected_errors x ON e.event_id = x.event_id""",
    expected_errors=EXPECTED_ERRORS,
)
def landing_steps(spark, sf_dir):
    """Files land in two steps with a run after each: which run took which file.

    Where the landing lies there in slices, the second run meets the first step's files of a slice again, of
    the same path, size and time, beside those of its own step.
    """
    folder, store = session.scratch_path(spark, "objects"), _fresh_store(spark)
    raw, slices = raw_events(spark, sf_dir), _slices(spark, sf_dir, folder)
    early = F.col("event_time") < F.lit(_CUT).cast("timestamp_ntz")
    whole = len(slices) == 1
    for run, part in (("first", early), ("second", ~early if whole else early | ~early)):
        intake = landing_run.LandingIntake(spark, store, run)
        for here in slices:
            if not whole:
                landing.spend_landing(folder)
            _land_objects(raw.where(here & part), folder)
            intake.open(folder)
        intake.close()
    bad = store.aside("quarantine").select("source_key", F.lit(True).alias("bad"))
    taken = store.aside(landing_run.TAKEN).join(bad, "source_key", "left")
    return taken.select(
        "run",
        _event_id_of("source_key").alias("event_id"),
        F.coalesce("bad", F.lit(False)).alias("quarantined"),
    )


@query(
    "rebuild_equals_incremental",
    f"SELECT {_LEDGER} FROM ({_EXPECTED_LEDGER}) e",
    expected_valid=EXPECTED_VALID,
)
def rebuild_equals_incremental(spark, sf_dir):
    """A rebuild from all raw events after the ledgers were lost, then rewritten."""
    rebuilt = _fresh_store(spark)
    incremental.run_incremental(raw_events(spark, sf_dir), rebuilt, "rebuild")
    compact = rebuilt.rewrite(session.scratch_path(spark, "compact"))
    return ledger_view(compact.events())


@query(
    "stream_equals_batch",
    f"SELECT {_LEDGER} FROM ({_EXPECTED_LEDGER}) e",
    expected_valid=EXPECTED_VALID,
)
def stream_equals_batch(spark, sf_dir):
    """The same ledgers from a stream over the raw events as files of JSON lines."""
    folder = session.scratch_path(spark, "landing")
    raw_events(spark, sf_dir).select("value").write.text(folder)
    store = _fresh_store(spark)
    stream = event_stream.read_event_stream(spark, folder, layout="lines", max_files=4)
    event_stream.extend_ledgers(stream, store, session.scratch_path(spark, "stream"))
    return ledger_view(store.events())


@query(
    "two_streams_one_store",
    f"SELECT {_LEDGER} FROM expected_valid WHERE NOT project_label LIKE '%sandbox%'",
    expected_valid=EXPECTED_VALID,
)
def two_streams_one_store(spark, sf_dir):
    """Two landings, read by streams of their own into one store: ledger and late rows."""
    store = _fresh_store(spark)
    raw = raw_events(spark, sf_dir)
    for half in (0, 1):
        folder = session.scratch_path(spark, "landing")
        raw.where(F.col("event_id") % 2 == half).select("value").write.text(folder)
        stream = event_stream.read_event_stream(spark, folder, layout="lines")
        event_stream.extend_ledgers(stream, store, session.scratch_path(spark, "stream"))
    rows = store.events().unionByName(store.aside("late").select(*schema.LEDGER_COLUMNS))
    return ledger_view(rows)


@query(
    "landing_read",
    f"SELECT {_LEDGER} FROM expected_valid",
    expected_valid=EXPECTED_VALID,
)
def landing_read(spark, sf_dir):
    """Raw events landed as files of JSON lines, read back and checked."""
    folder = session.scratch_path(spark, "landing")
    raw_events(spark, sf_dir).select("value").write.text(folder)
    raw = event_files.read_event_files(spark, folder, layout="lines")
    return ledger_view(validation.valid_rows(validation.check_visit_events(raw)))
