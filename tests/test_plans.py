"""What the plans look like: pruning, partial aggregation, no Python in them."""

import re

import pytest

import __spark_entry__ as entry_points
from frames import SMALL, event, ledger_frame
from tallybook import session
from tallybook.catalog.base import visit_events
from tallybook.operators import counts, filters, visits
from tallybook.plans import incremental
from tallybook.sources import folders
from tallybook.sources.ledger_store import LedgerStore


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def ledger(spark):
    store = LedgerStore(spark, session.scratch_path(spark, "plans"))
    store.append(filters.drop_sandbox(visit_events(spark, SMALL)), "r1")
    return store


def test_filters_and_columns_reach_the_scan(ledger):
    text = plan(filters.by_center(ledger.events(), "center02").select("action"))
    assert "EqualTo(center_label,center02)" in text
    assert re.search(r"ReadSchema: struct<action:string,center_label:string>", text)


def test_ledger_folders_are_pruned(ledger):
    text = plan(ledger.events("adrc", "form"))
    assert re.search(r"PartitionFilters: \[.*by_study.*= adrc.*by_datatype.*= form", text)


def test_date_filters_reach_the_scan(ledger):
    text = plan(filters.by_date_range(ledger.events(), "2024-01-08", "2024-01-15"))
    assert "GreaterThanOrEqual(visit_date,2024-01-08)" in text
    text = plan(filters.by_date_range(ledger.events(), "2024-01-08", field="timestamp"))
    assert "GreaterThanOrEqual(timestamp," in text


def test_latest_per_visit_limits_groups_before_the_shuffle(ledger):
    text = plan(visits.latest_per_visit(ledger.events()))
    assert text.count("WindowGroupLimit") >= 2


def test_watermark_join_does_not_shuffle_events(ledger):
    events = ledger.events()
    text = plan(incremental.new_events(events, counts.watermarks(events)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_watermark_plans_run_and_cache_nothing(spark, ledger):
    events = ledger.events()
    marks = counts.watermarks(events)
    tracker, group = spark.sparkContext.statusTracker(), "watermark-plans"
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    spark.sparkContext.setJobGroup(group, group)
    try:
        incremental.new_events(events, marks)
        incremental.late_events(events, marks)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not tracker.getJobIdsForGroup(group)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


@pytest.mark.parametrize(
    "name",
    ["ingest_validate", "visit_lookup", "completeness_drops", "pii_redact", "clean_customers",
     "retention_tiers", "task_batch", "src_filename_meta", "monthly_business_report"],
)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(entry_points.queries()[name](spark, SMALL))
    for unwanted in ("Python", "Pandas", "CartesianProduct"):
        assert unwanted not in text


def test_json_is_parsed_once_per_row(spark):
    text = plan(entry_points.queries()["ingest_validate"](spark, SMALL))
    physical = text.split("(1)")[1]
    assert physical.count("from_json(") <= 2  # the generator and its argument listing


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    assert spark.sparkContext.applicationId in session.scratch_path(spark, "label")
    monkeypatch.setattr(session, "_own_scratch", lambda spark: f"{tmp_path}/own")
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not folders.exists(spark, path)
    assert folders.exists(spark, str(tmp_path))


def _rows_read(df):
    """Rows that the scans of an executed frame gave out, without adaptive execution."""
    df.collect()

    def walk(node):
        if "Scan" in node.nodeName():
            yield node.metrics().apply("numOutputRows").value()
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return sum(walk(df._jdf.queryExecution().executedPlan()))


def test_lookup_skips_row_groups_by_bloom_filter(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledgers"))
    for run in range(4):  # least and greatest ptid are alike everywhere, so statistics skip nothing
        names = ["A0000", "Z9999", *[f"M{i:04d}" for i in range(run, 4000, 4)]]
        rows = [event(ptid=n, at=f"2024-01-15 10:{i % 60:02d}") for i, n in enumerate(names)]
        store.append(ledger_frame(spark, rows).coalesce(1), f"r{run}")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _rows_read(store.events_of(["M0002"])) < 0.5 * 4 * 1002
        assert _rows_read(store.events_of(["M0001x", "M9999"])) < 0.5 * 4 * 1002
        assert store.events_of(["M0002", "A0000"]).count() == 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    with pytest.raises(ValueError, match="participants"):
        store.events_of([])
