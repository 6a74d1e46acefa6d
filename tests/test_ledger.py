"""Ledger storage and incremental runs on small logs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import event, ledger_frame
from tallybook import schema
from tallybook.plans import incremental
from tallybook.plans.incremental import run_incremental
from tallybook.sources import folders, ledger_store
from tallybook.sources.ledger_store import LedgerStore, load_ledger, save_ledger
from tallybook.streaming import event_stream
from test_validation import GOOD

START = datetime(2024, 1, 15, 10)


def doc(hour, **changes):
    at = (START + timedelta(hours=hour)).strftime("%Y-%m-%dT%H:%M:%SZ")
    d = {**GOOD, "timestamp": at, **changes}
    if d["datatype"] != "form":
        d["module"] = None
    return d


def raw(spark, docs):
    rows = [(f"k{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "source_key string, value string")


@pytest.fixture
def store(spark, tmp_path):
    return LedgerStore(spark, str(tmp_path / "ledgers"))


def hours(df):
    kept = df.select(F.col("timestamp").cast("timestamp_ntz")).collect()
    return sorted((r[0] - START) // timedelta(hours=1) for r in kept)


def by_group(result):
    return {
        (r.study, r.datatype): (r.events, r.new_events, r.late_events, r.status)
        for r in result.groups.collect()
    }


# --- one ledger file ---------------------------------------------------------------


def test_missing_ledger_is_empty_and_typed(spark, tmp_path):
    empty = load_ledger(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.schema == schema.LEDGER


def test_damaged_ledger_raises(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("this is no parquet")
    with pytest.raises(Exception) as caught:
        load_ledger(spark, str(tmp_path / "bad.parquet")).count()
    assert "PATH_NOT_FOUND" not in str(caught.value)


def test_save_replaces_and_sorts(spark, tmp_path, basic):
    path = str(tmp_path / "a" / "events.parquet")
    save_ledger(basic, path)
    save_ledger(basic.limit(4), path)
    got = load_ledger(spark, path)
    assert got.count() == 4 and got.schema == schema.LEDGER


def test_zoneless_ledger_times_are_utc(spark, tmp_path, basic):
    path = str(tmp_path / "ntz")
    basic.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).write.parquet(path)
    assert load_ledger(spark, path).exceptAll(basic).count() == 0


def test_templates():
    assert ledger_store.template_key("c/{study}/{datatype}/e.parquet", "adrc", "form") == (
        "c/adrc/form/e.parquet"
    )
    with pytest.raises(ValueError, match=r"\{study\}, \{datatype\}"):
        ledger_store.check_template("events.parquet")
    with pytest.raises(ValueError, match=r"\{datatype\}"):
        ledger_store.check_template("{study}.parquet")


# --- the store -----------------------------------------------------------------------


def test_store_keeps_every_row_and_value(spark, store, basic):
    odd = ledger_frame(
        spark,
        [event(study="007"), event(study="a/b=c"), event(study=""), event(number=None, packet=None)],
    )
    assert store.append(basic.unionByName(odd), "r1") == 10
    got = store.events()
    assert got.schema == schema.LEDGER
    assert got.exceptAll(basic.unionByName(odd)).count() == 0
    assert store.events("007").count() == 1
    assert store.events("a/b=c", "form").count() == 1
    assert store.exists()


def test_ledger_in_sql(spark, store, basic, tmp_path):
    store.append(basic, "r1")
    store.create_view("ledger_view")
    alpha = "SELECT COUNT(*) FROM {} WHERE center_label = 'alpha'"
    assert spark.sql(alpha.format("ledger_view")).first()[0] == 3
    save_ledger(store.events(), str(tmp_path / "saved"))
    table = ledger_store.external_table(spark, "ledger_table", str(tmp_path / "saved"))
    assert table.count() == 6
    assert spark.sql(alpha.format("ledger_table")).first()[0] == 3
    spark.sql("DROP TABLE ledger_table")
    assert folders.exists(spark, str(tmp_path / "saved"))


def test_repeating_a_run_adds_nothing(store, basic):
    assert store.append(basic, "r1") == 6
    assert store.append(basic, "r1") == 6
    assert store.events().count() == 6
    assert store.append(basic, "r2") == 6
    assert store.events().count() == 12


def test_unfinished_run_is_invisible_and_repeatable(spark, store, basic, tmp_path):
    store.append(basic, "r1")
    partial = store._run_path("events", "r2")
    basic.withColumn("by_study", F.col("study")).withColumn("by_datatype", F.col("datatype")).write.partitionBy(
        "by_study", "by_datatype"
    ).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(partial)
    assert folders.exists(spark, partial) and not store.is_committed("r2")
    assert store.events().count() == 6
    assert store.append(basic.limit(2), "r2") == 2
    assert store.events().count() == 8


def test_marks_do_not_need_their_table(spark, store, basic):
    store.append(basic, "r1")
    with_table = store.marks().collect()
    lost = LedgerStore(spark, store.root)
    lost._finished_runs = lambda kind: ["r1"] if kind == "events" else []
    assert lost.marks().collect() == with_table


def test_a_ledger_with_most_rows_is_split_over_tasks(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "s"))
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'small' ELSE 'hot' END AS study",
        "concat('P', id % 1000) AS ptid",
        "timestamp_micros(id * 1000003 % 90000000000) AS timestamp",
    )
    fixed = {c: "x" for c in schema.LEDGER_COLUMNS if c not in ("study", "ptid", "timestamp")}
    fixed["pipeline_adcid"] = "1"
    for c, value in fixed.items():
        rows = rows.withColumn(c, F.lit(value))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300KB")
    try:
        assert store.append(rows, "r1") == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(f"{store.root}/events").groupBy("by_study").agg(
        F.count_distinct("_metadata.file_path").alias("files")
    )
    assert {r.by_study: r.files > 4 for r in files.collect()}["hot"]


def test_rewrite_and_export(spark, store, basic, tmp_path):
    store.append(basic, "r1")
    store.append(basic.withColumn("datatype", F.lit("dicom")), "r2")
    compact = store.rewrite(str(tmp_path / "compact"))
    assert compact.events().exceptAll(store.events()).count() == 0
    assert compact.events().count() == 12
    with pytest.raises(ValueError, match="fresh"):
        store.rewrite(str(tmp_path / "compact"))
    paths = store.export(str(tmp_path / "out"), "{study}-{datatype}.parquet")
    assert [p.rsplit("/")[-1] for p in paths] == ["adrc-dicom.parquet", "adrc-form.parquet"]
    assert all(load_ledger(spark, p).count() == 6 for p in paths)


# --- runs -------------------------------------------------------------------------------


def test_first_run(spark, store):
    docs = [
        doc(0), doc(1, study="dvcid"), doc(2, datatype="dicom"),
        doc(3, project_label="sandbox-x"), "broken", doc(4, action="bad"),
    ]
    result = run_incremental(raw(spark, docs), store)
    assert result.status == "ok"
    assert by_group(result) == {
        ("adrc", "form"): (1, 1, 0, "saved"),
        ("adrc", "dicom"): (1, 1, 0, "saved"),
        ("dvcid", "form"): (1, 1, 0, "saved"),
    }
    assert result.counts.first().asDict() == {
        "files_retrieved": 6, "files_ok": 4, "files_failed": 2, "filtered_events": 1,
    }
    assert {r.source_key for r in result.errors.collect()} == {"k4", "k5"}
    assert hours(store.events()) == [0, 1, 2]


def test_second_run_takes_only_later_events_per_ledger(spark, store):
    run_incremental(raw(spark, [doc(0), doc(5)]), store)
    second = run_incremental(
        raw(spark, [doc(3), doc(5), doc(6), doc(1, study="new")]), store
    )
    assert by_group(second) == {
        ("adrc", "form"): (3, 1, 2, "saved"),
        ("new", "form"): (1, 1, 0, "saved"),
    }
    assert hours(store.events("adrc")) == [0, 5, 6]
    assert hours(second.late) == [3, 5]


def test_equal_events_are_all_kept(spark, store):
    run_incremental(raw(spark, [doc(1), doc(1), doc(1)]), store)
    assert hours(store.events()) == [1, 1, 1]


def test_rerun_changes_nothing(spark, store):
    docs = raw(spark, [doc(0), doc(1)])
    run_incremental(docs, store)
    again = run_incremental(docs, store)
    assert by_group(again) == {("adrc", "form"): (2, 0, 2, "unchanged")}
    assert len(store.committed_runs()) == 1
    assert hours(store.events()) == [0, 1]


def test_run_without_valid_rows(spark, store):
    result = run_incremental(raw(spark, ["x"]), store)
    assert result.status == "ok" and result.groups.count() == 0
    assert not store.exists()


class FailingStore(LedgerStore):
    """Cannot save the ledgers of one study, nor several ledgers at once."""

    broken = "bad"

    def append(self, rows, run_id):
        if rows.filter(F.col("study") == self.broken).count():
            raise OSError("disk says no")
        return super().append(rows, run_id)


def test_one_failing_ledger_does_not_stop_the_others(spark, tmp_path):
    store = FailingStore(spark, str(tmp_path / "s"))
    docs = raw(spark, [doc(0), doc(1, study="bad"), doc(2, datatype="dicom")])
    result = run_incremental(docs, store, "r1")
    assert result.status == "partial"
    assert {k: v[3] for k, v in by_group(result).items()} == {
        ("adrc", "form"): "saved", ("adrc", "dicom"): "saved", ("bad", "form"): "failed",
    }
    assert result.groups.filter("status = 'failed'").first()["error"] == "disk says no"
    assert hours(store.events()) == [0, 2]

    # the same run again, now without the fault, adds only what is missing
    store.broken = None
    fixed = run_incremental(docs, store, "r1", marks=spark.createDataFrame([], ledger_store.MARKS))
    assert fixed.status == "ok"
    assert hours(store.events()) == [0, 1, 2]


def test_all_ledgers_failing(spark, tmp_path):
    store = FailingStore(spark, str(tmp_path / "s"))
    result = run_incremental(raw(spark, [doc(0, study="bad")]), store)
    assert result.status == "failed"
    assert incremental.overall_status(result.groups).first().asDict() == {
        "groups_processed": 0, "groups_failed": 1, "status": "failed",
    }


# --- stream --------------------------------------------------------------------------------


def write_files(folder, docs, start=0):
    folder.mkdir(exist_ok=True)
    for i, d in enumerate(docs, start):
        moment = datetime.fromisoformat(d["timestamp"].rstrip("Z"))
        name = f"log-submit-{moment:%Y%m%d-%H%M%S}-{i}-p-x-2024-01-15.json"
        (folder / name).write_text(json.dumps(d))


def run_stream(spark, folder, store, tmp_path, **kw):
    stream = event_stream.read_event_stream(spark, str(folder), **kw)
    return event_stream.extend_ledgers(stream, store, str(tmp_path / "checkpoint"))


def test_stream_in_many_batches_equals_one_batch(spark, store, tmp_path):
    folder = tmp_path / "log"
    # later times first: batches see the events out of order
    write_files(folder, [doc(h) for h in (9, 8, 7, 1, 2, 3)])
    run_stream(spark, folder, store, tmp_path, max_files=2)
    assert len(store.committed_runs()) > 1
    assert hours(store.events()) == [1, 2, 3, 7, 8, 9]
    # nothing new
    run_stream(spark, folder, store, tmp_path)
    assert hours(store.events()) == [1, 2, 3, 7, 8, 9]
    # the next run has its own watermarks: 5 is late, 12 is new
    write_files(folder, [doc(5), doc(12)], start=10)
    run_stream(spark, folder, store, tmp_path)
    assert hours(store.events()) == [1, 2, 3, 7, 8, 9, 12]


def test_stream_after_a_crash_keeps_its_watermarks(spark, store, tmp_path):
    folder = tmp_path / "log"
    write_files(folder, [doc(9)])
    crashed = event_stream.StreamMarks(store)
    marks = crashed.frame()
    # the batch was saved, but the run never completed
    stream = event_stream.stream_identity(spark, str(tmp_path / "checkpoint"))
    run_incremental(raw(spark, [doc(9)]), store, f"stream-{stream}-batch-000000000", marks)
    write_files(folder, [doc(2)], start=5)
    run_stream(spark, folder, store, tmp_path, max_files=1)
    assert 9 in hours(store.events()) and hours(store.events()).count(9) == 1
    assert event_stream.StreamMarks(store).number == crashed.number + 1


def test_stream_keeps_quarantined_and_late_rows(spark, store, tmp_path):
    folder = tmp_path / "log"
    write_files(folder, [doc(5)])
    run_stream(spark, folder, store, tmp_path)
    write_files(folder, [doc(3), doc(7, action="bad")], start=5)
    run_stream(spark, folder, store, tmp_path)
    assert hours(store.events()) == [5]
    assert hours(store.aside("late")) == [3]
    (bad,) = store.aside("quarantine").collect()
    assert bad.errors == ["action: unknown value"] and "-6-p-x-" in bad.source_key
    assert store.aside("nothing") is None


def test_discard_leaves_the_ledgers(spark, store):
    result = run_incremental(raw(spark, [doc(0), "x"]), store)
    result.keep(store)
    result.discard()
    result.discard()
    assert hours(store.events()) == [0]
    assert store.aside("quarantine").count() == 1


def test_stream_batches_are_merged_with_adaptive_execution(spark, store, tmp_path):
    seen = []

    class Watching(LedgerStore):
        def append(self, rows, run_id):
            seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
            return super().append(rows, run_id)

    write_files(tmp_path / "log", [doc(1)])
    run_stream(spark, tmp_path / "log", Watching(spark, store.root), tmp_path)
    assert seen == ["true"]


def test_stream_lines(spark, store, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part").write_text("\n".join(json.dumps(doc(h)) for h in (1, 2)))
    run_stream(spark, tmp_path / "log", store, tmp_path, layout="lines")
    assert hours(store.events()) == [1, 2]


def test_streams_with_checkpoints_of_their_own_lose_nothing(spark, store, tmp_path):
    for name, hour in (("a", 3), ("b", 9), ("a", 12)):
        folder = tmp_path / f"log-{name}-{hour}"
        write_files(folder, [doc(hour)], start=hour)
        run_stream(spark, folder, store, tmp_path / f"{name}-{hour}")
    assert hours(store.events()) == [3, 9, 12]
    # a replaced checkpoint reads its folder again: nothing is added, all is kept as late
    run_stream(spark, tmp_path / "log-b-9", store, tmp_path / "replaced")
    assert hours(store.events()) == [3, 9, 12]
    assert store.aside("late").count() == 1


def test_a_committed_run_refuses_other_rows(spark, store):
    first = ledger_frame(spark, [event(at="2024-01-15 10:00")])
    other = ledger_frame(spark, [event(at="2024-01-15 11:00")])
    assert store.append(first, "x") == 1
    assert store.append(first, "x") == 1
    assert store.append(first.limit(0), "x") == 1
    with pytest.raises(ValueError, match="other rows"):
        store.append(other, "x")
    store.set_aside("late", other, "x")
    with pytest.raises(ValueError, match="other rows"):
        store.set_aside("late", first, "x")
    assert store.append(other, "x.2") == 1
    assert store.committed_parts("x") == []


def test_an_empty_study_is_a_ledger_of_its_own(spark, store, tmp_path):
    store.append(ledger_frame(spark, [event(study=""), event(study="adrc"), event(study="")]), "r")
    assert store.events("").count() == 2
    assert len(store.export(str(tmp_path / "out"), "{study}-{datatype}.parquet")) == 2
    assert load_ledger(spark, str(tmp_path / "out" / "-form.parquet")).count() == 2
