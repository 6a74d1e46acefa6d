"""Report operators on the small frames with known answers."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallybook.operators import counts, filters, timing, validation, visits


def as_dict(df, key, value="count"):
    return {r[key]: r[value] for r in df.collect()}


def test_action_counts(basic):
    assert as_dict(counts.action_counts(basic), "action") == {
        "delete": 1, "not-pass-qc": 1, "pass-qc": 2, "submit": 2,
    }
    assert [r.action for r in counts.action_counts(basic).collect()] == sorted(
        ["submit", "delete", "pass-qc", "not-pass-qc"]
    )


def test_lists_are_sorted(basic, ranged):
    assert [r[0] for r in counts.centers(basic).collect()] == ["alpha", "beta", "gamma"]
    assert [r[0] for r in counts.packets(ranged).collect()] == ["A", "B", "C", "I"]


def test_filters(basic):
    assert filters.by_center(basic, "alpha").count() == 3
    assert filters.by_center(basic, "nowhere").count() == 0
    assert filters.by_center_and_action(basic, "alpha", "submit").count() == 1
    assert counts.count_center_action(basic, "beta", "delete").first()[0] == 1
    assert counts.count_not_pass_qc(basic).first()[0] == 1
    assert counts.count_action(basic.limit(0), "submit").first()[0] == 0


def test_packets(ranged):
    got = as_dict(counts.packet_counts(ranged), "packet")
    assert got == {"A": 2, "B": 1, "C": 1, "I": 4}
    with_null = ranged.withColumn("packet", F.when(F.col("packet") != "C", F.col("packet")))
    assert as_dict(counts.packet_counts(with_null), "packet")[None] == 1
    assert filters.by_packet(with_null, "C").count() == 0
    assert [r[0] for r in counts.packets(with_null).collect()] == ["A", "B", "I"]


def test_visit_date_range(ranged):
    assert filters.by_date_range(ranged, "2024-01-16", "2024-01-17").count() == 4
    assert filters.by_date_range(ranged, start="2024-01-18").count() == 2
    assert filters.by_date_range(ranged, end="2024-01-15").count() == 2
    assert filters.by_date_range(ranged).count() == 8
    assert filters.by_date_range(ranged, "2025-01-01", "2025-12-31").count() == 0


def test_timestamp_ranges(ranged):
    days = filters.by_date_range(ranged, "2024-01-16", "2024-01-17", "timestamp")
    assert days.count() == 4
    exact = filters.by_timestamp_range(
        ranged, datetime(2024, 1, 16, 10), datetime(2024, 1, 17, 10)
    )
    assert exact.count() == 4
    with pytest.raises(ValueError, match="ptid"):
        filters.by_date_range(ranged, "2024-01-01", field="ptid")


def test_last_microsecond_of_the_end_day_counts(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-17 23:59:59.999999' AS timestamp "
        "UNION ALL SELECT timestamp'2024-01-18 00:00:00'"
    )
    assert filters.by_date_range(df, end="2024-01-17", field="timestamp").count() == 1


def test_timing(timed):
    qc = timing.qc_timing(timed).select("days_from_visit_to_qc").collect()
    assert sorted(r[0] for r in qc) == [0, 0, 1, 3]
    submit = timing.submit_timing(timed).select("days_from_visit_to_submit").collect()
    assert [r[0] for r in submit] == [0, 0, 0, 0]


def test_timing_of_an_impossible_visit_date_is_null(timed):
    odd = timed.withColumn("visit_date", F.lit("2024-13-45"))
    assert timing.submit_timing(odd).first()["days_from_visit_to_submit"] is None


def test_pass_rates(timed, basic):
    assert counts.pass_rate(timed).first()[0] == 4 / 6
    by_center = as_dict(counts.pass_rate(timed, ["center_label"]), "center_label", "pass_rate")
    assert by_center == {"alpha": 1.0, "beta": 0.5, "gamma": 0.5}
    by_module = as_dict(counts.pass_rate(timed, ["module"]), "module", "pass_rate")
    assert by_module == {"UDS": 1.0, "FTLD": 0.5, "LBD": 0.5}
    submits = filters.by_center_and_action(basic, "alpha", "submit")
    assert counts.pass_rate(submits).first()[0] is None
    assert counts.pass_rate(submits, ["module"]).count() == 0


def test_multi_field_counts_are_sorted(ranged):
    rows = counts.counts_by(ranged, ["module", "action"]).collect()
    assert [(r.module, r.action) for r in rows] == sorted((r.module, r.action) for r in rows)
    assert sum(r["count"] for r in rows) == 8


def test_sandbox(basic):
    mixed = basic.withColumn(
        "project_label", F.when(F.col("center_label") == "beta", "sandbox-x").otherwise("ingest")
    )
    assert filters.drop_sandbox(mixed).count() == 4
    assert counts.sandbox_count(mixed).first().asDict() == {
        "total_events": 6, "filtered_count": 2, "remaining": 4,
    }
    inner = basic.withColumn("project_label", F.lit("my-sandbox-x"))
    assert filters.drop_sandbox(inner).count() == 6


def test_readiness(basic):
    assert validation.require_report_schema(basic)
    with pytest.raises(validation.SchemaMismatch, match="action"):
        validation.require_report_schema(basic.drop("action"))
    with pytest.raises(validation.SchemaMismatch, match="pipeline_adcid"):
        text = basic.withColumn("pipeline_adcid", F.col("pipeline_adcid").cast("string"))
        validation.require_report_schema(text)


def test_visit_lookup(basic):
    nameless = basic.withColumn("visit_number", F.lit(None).cast("string"))
    assert visits.events_of_visit(nameless, "ABC123", "2024-01-15", None).count() == 2
    assert visits.events_of_visit(nameless, "ABC123", "2024-01-15", "01").count() == 0
    wanted = nameless.filter("action = 'delete'")
    assert visits.events_of_visits(nameless, wanted).count() == 2
