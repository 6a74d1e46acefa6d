"""Visit states of a stream, and report counts kept run by run."""

import random

import pytest
from pyspark.sql import functions as F

from frames import event, ledger_frame
from tallybook.operators import profiles, visits
from tallybook.plans import incremental
from tallybook.plans.report_views import DIMENSIONS, ColumnProfiles, ReportCounts
from tallybook.sources.ledger_store import LedgerStore
from tallybook.streaming import visit_state

ACTIONS = ("submit", "pass-qc", "not-pass-qc", "delete")


def history(spark, n=160, seed=2):
    """Events of a few visits, one of them with half of all events."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ptid = "HOT" if i % 2 else f"P{rnd.randrange(6)}"
        rows.append(
            event(
                rnd.choice(ACTIONS), ptid=ptid, number=rnd.choice([None, "01"]),
                module=rnd.choice([None, "UDS"]), packet=rnd.choice([None, "I"]),
                center=rnd.choice(["a", "b"]),
                at=f"2024-02-{1 + i % 27:02d} {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:{i % 60:02d}",
            )
        )
    return ledger_frame(spark, rows)


def stream_of(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / name) for name in ("files", "states", "checkpoint")]


def test_states_equal_the_batch_results_in_any_order(spark, places):
    files, target, checkpoint = places
    df = history(spark).withColumn("event_id", F.monotonically_increasing_id())
    df.repartition(5, F.rand(3)).write.parquet(files)
    visit_state.follow_visits(stream_of(spark, files), target, checkpoint, ["event_id"])
    # the same events once more, and a restart from the checkpoint
    df.repartition(2, F.rand(4)).write.mode("append").parquet(files)
    visit_state.follow_visits(stream_of(spark, files), target, checkpoint, ["event_id"])
    got = visit_state.visit_states(spark, target)
    latest = visits.latest_per_visit(df, ["event_id"]).select(*visits.KEY, "timestamp", "action")
    assert got.select(latest.columns).exceptAll(latest).count() == 0
    assert got.count() == latest.count()
    trend = visits.completeness_trend(df, ["event_id"]).select(
        *visits.KEY, "latest_score", "max_score", "ever_drops"
    )
    assert got.select(trend.columns).exceptAll(trend).count() == 0


def test_late_arrivals_are_set_aside(spark, places):
    files, target, checkpoint = places
    ledger_frame(spark, [event(at="2024-01-15 12:00")]).write.parquet(files)
    visit_state.follow_visits(stream_of(spark, files), target, checkpoint)
    more = [event("pass-qc", at="2024-01-15 11:00"), event("delete", at="2024-01-15 13:00")]
    ledger_frame(spark, more).coalesce(1).write.mode("append").parquet(files)
    visit_state.follow_visits(stream_of(spark, files), target, checkpoint)
    assert [r["action"] for r in visit_state.late_arrivals(spark, target).collect()] == ["pass-qc"]
    assert [r["action"] for r in visit_state.visit_states(spark, target).collect()] == ["delete"]


def test_stream_takes_events_without_time_or_action(spark, places):
    files, target, checkpoint = places
    rows = [event("submit", at="2024-01-15 12:00"), event("pass-qc", at="2024-01-15 12:00"),
            event("delete", at="2024-01-15 13:00", packet=None)]
    df = ledger_frame(spark, rows).withColumn(
        "timestamp", F.when(F.col("action") != "delete", F.col("timestamp"))
    )
    blank = df.where("action = 'submit'").withColumn("action", F.lit(None).cast("string"))
    df.unionByName(blank).coalesce(1).write.parquet(files)
    visit_state.follow_visits(stream_of(spark, files), target, checkpoint)
    (got,) = visit_state.visit_states(spark, target).collect()
    assert (got["action"], got["latest_score"], got["max_score"]) == ("submit", 3, 3)
    assert not got["ever_drops"]


def test_late_events_are_late_for_earlier_batches_only(spark, places):
    files, target, checkpoint = places
    batches = [["12:00"], ["14:00", "13:00"], ["13:30", "12:30", "15:00"], ["15:00", "11:00"]]
    for hours in batches:
        rows = [event(at=f"2024-01-15 {h}", number=n) for h in hours for n in (None, "01")]
        ledger_frame(spark, rows).coalesce(1).write.mode("append").parquet(files)
        visit_state.follow_visits(stream_of(spark, files), target, checkpoint)
    late = visit_state.late_arrivals(spark, target).collect()
    assert sorted((r["timestamp"].strftime("%H:%M"), r["visit_number"] or "") for r in late) == [
        (h, n) for h in ("11:00", "12:30", "13:30") for n in ("", "01")
    ]
    assert {r["batch"] for r in late} == {2, 3}


def test_stream_leaves_the_session_as_it_was(spark, places):
    files, target, checkpoint = places
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    ledger_frame(spark, [event()]).write.parquet(files)
    visit_state.follow_visits(stream_of(spark, files), target, checkpoint)
    assert spark.conf.get(name, None) == before


# --- report counts ---------------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    return LedgerStore(spark, str(tmp_path / "ledgers"))


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_counts_equal_recomputation_after_runs_with_late_rows(spark, store):
    kept = ReportCounts(store)
    df = history(spark, 200)
    for number, cut in enumerate(("2024-02-09", "2024-02-18", "2024-03-01")):
        part = df.where(F.col("timestamp") < F.lit(cut).cast("timestamp"))
        part = part.sample(0.7, seed=number) if number < 2 else part
        store.append(incremental.new_events(part, store.marks()), f"r{number}")
        assert kept.refresh() == 1
        if number == 1:
            kept.fold()
    assert kept.refresh() == 0
    ledger = store.events()
    assert ledger.count() < df.count()  # some rows were late
    for fields in (["center_label", "action"], ["module"], DIMENSIONS):
        same(kept.by(*fields), ledger.groupBy(*fields).agg(F.count("*").alias("n_events")))
    rate = kept.pass_rate("center_label").orderBy("center_label").collect()
    for r in rate:
        mine = ledger.where(F.col("center_label") == r["center_label"])
        assert r["passed"] == mine.where("action = 'pass-qc'").count()
        assert r["not_passed"] == mine.where("action = 'not-pass-qc'").count()


def test_folding_twice_and_runs_after_it(spark, store, basic):
    kept = ReportCounts(store)
    assert kept.by("action").count() == 0
    kept.fold()
    for number in range(4):
        store.append(basic, f"r{number}")
        kept.refresh()
        if number % 2:
            kept.fold()
            kept.fold()
    assert kept.by("action").agg(F.sum("n_events")).first()[0] == 24
    assert [r[0] for r in kept.values("packet").collect()] == ["A", "B", "I"]
    assert kept._folded()[1] == {"r0", "r1", "r2", "r3"}


def test_reports_read_no_ledger_rows(spark, store, basic):
    store.append(basic, "r1")
    kept = ReportCounts(store)
    kept.refresh()
    files = kept.by("action").inputFiles()
    assert files and all("/counts/" in f for f in files)


def test_profiles_of_parts_are_the_profile_of_the_whole(spark):
    rows = [(i, f"v{i % 5000}", None if i % 7 == 0 else i % 3) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id bigint, name string, kind int")
    parts = [profiles.profile(df.where(f"id % 4 = {k}")) for k in range(4)]
    merged_ = parts[0]
    for part in parts[1:]:
        merged_ = merged_.unionByName(part)
    got = {r["column_name"]: r for r in profiles.estimates(profiles.merge_profiles(merged_)).collect()}
    whole = {r["column_name"]: r for r in profiles.estimates(profiles.profile(df)).collect()}
    for c, exact, nulls in (("id", 20_000, 0), ("name", 5000, 0), ("kind", 3, 2858)):
        assert (got[c]["n_rows"], got[c]["n_nulls"]) == (20_000, nulls)
        assert (got[c]["least"], got[c]["greatest"]) == (whole[c]["least"], whole[c]["greatest"])
        for seen in (got, whole):
            assert abs(seen[c]["n_distinct"] - exact) <= max(0.05 * exact, 0)


def test_profiles_are_kept_per_run(spark, store, basic):
    kept = ColumnProfiles(store)
    assert kept.current().count() == 0
    for run in ("r1", "r2"):
        store.append(basic, run)
        assert kept.refresh() == 1
    assert kept.refresh() == 0
    row = kept.current().where("column_name = 'action'").first()
    assert (row["n_rows"], row["n_nulls"], row["n_distinct"]) == (12, 0, 4)
    assert all("/profiles/" in f for f in kept.current().inputFiles())


def test_profile_of_no_rows(spark, basic):
    rows = profiles.estimates(profiles.profile(basic.limit(0), ["action", "packet"])).collect()
    assert [(r["n_rows"], r["n_nulls"], r["least"], r["n_distinct"]) for r in rows] == [(0, 0, None, 0)] * 2
