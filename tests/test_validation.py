"""Row rules: what is accepted, what is refused, and why."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tallybook import schema
from tallybook.operators import validation

GOOD = {
    "action": "submit",
    "study": "adrc",
    "pipeline_adcid": 42,
    "project_label": "ingest-form",
    "center_label": "alpha",
    "gear_name": "gear",
    "ptid": "ABC123",
    "visit_date": "2024-01-15",
    "visit_number": "01",
    "datatype": "form",
    "module": "UDS",
    "packet": "I",
    "timestamp": "2024-01-15T10:00:00Z",
}


def check(spark, docs, **kw):
    """Errors and typed row per document; a str is taken as raw text."""
    rows = [
        (str(i), d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)
    ]
    raw = spark.createDataFrame(rows, "source_key string, value string")
    checked = validation.check_visit_events(raw, **kw)
    checked = checked.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return [r for r in sorted(checked.collect(), key=lambda r: int(r.source_key))]


def with_(**changes):
    doc = {**GOOD, **changes}
    return {k: v for k, v in doc.items() if v is not ...}


ACCEPTED = [
    with_(),
    *[with_(action=a) for a in schema.ACTIONS],
    *[with_(ptid=p) for p in ("!@#$%", "a", "1234567890", "  ABC123\t")],
    *[with_(datatype=d, module=None) for d in schema.DATATYPES if d != "form"],
    with_(datatype="dicom", module=...),
    *[with_(pipeline_adcid=v) for v in ("123", " 42 ", "1_000", 7.0, "7.0", True, -5)],
    with_(visit_date="2024-13-45"),  # shape only in the default profile
    *[with_(visit_number=v) for v in (None, ..., "007", "")],
    *[with_(packet=v) for v in (None, ...)],
    with_(study=...),
    *[
        with_(timestamp=t)
        for t in (
            "2024-01-15T10:30:45Z", "2024-01-15T10:30:45.123456+02:00", "2024-01-15 10:30",
            "2024-01-15", 1705312800, 1705312800000, "1705312800",
        )
    ],
    "  " + json.dumps(GOOD) + "\n",
]


def test_accepted(spark):
    for doc, row in zip(ACCEPTED, check(spark, ACCEPTED), strict=True):
        assert row.errors == [], doc


REFUSED = [
    ("not json", "JSON decode error"),
    ("", "JSON decode error"),
    ("[" + json.dumps(GOOD) + "]", "JSON decode error"),
    (json.dumps(GOOD) + " tail", "JSON decode error"),
    (json.dumps(GOOD) + "," + json.dumps(GOOD), "JSON decode error"),
    (str(GOOD), "JSON decode error"),  # single quotes
    ("null", "JSON decode error"),
    ('"text"', "JSON decode error"),
    *[(with_(**{c: ...}), f"{c}: field required") for c in schema.REQUIRED],
    (with_(action="invalid_action"), "action: unknown value"),
    (with_(action=" submit "), "action: unknown value"),
    (with_(datatype="other", module=...), "datatype: unknown value"),
    *[
        (with_(ptid=p), "ptid: bad pattern")
        for p in ("ABC 123", "ABC\t123", "ABC1234567890", "", "   ", "ABCé")
    ],
    *[
        (with_(visit_date=d), "visit_date: bad pattern")
        for d in ("2024-1-15", "01/15/2024", "2024/01/15", "soon", "2024-01-15\nx")
    ],
    *[
        (with_(timestamp=t), "timestamp: not a date-time")
        for t in (
            "2024-13-45", "15/01/2024", "2024-01-15T25:00:00Z", "now", "T10:00:00", None, True,
            "2024-01-15T10:00:00 UTC",
        )
    ],
    *[
        (with_(pipeline_adcid=v), "pipeline_adcid: not an integer")
        for v in ("abc", 1.5, 3_000_000_000, None, "", [1])
    ],
    (with_(module=...), "module: required for form"),
    (with_(module=None), "module: required for form"),
    (with_(datatype="dicom"), "module: only allowed for form"),
    (with_(extra="x"), "extra field"),
    (with_(study=None), "study: not a string"),
    (with_(gear_name=5), "gear_name: not a string"),
    (with_(packet={"a": 1}), "packet: not a string"),
]


def test_refused_with_exactly_one_message(spark):
    rows = check(spark, [d for d, _ in REFUSED])
    for (doc, message), row in zip(REFUSED, rows, strict=True):
        assert row.errors == [message], doc


def test_all_messages_are_kept(spark):
    doc = with_(action="x", ptid=..., visit_date="y", extra=1)
    assert set(check(spark, [doc])[0].errors) == {
        "action: unknown value", "ptid: field required", "visit_date: bad pattern", "extra field",
    }


def test_values(spark):
    docs = [
        with_(ptid=" AB\t", center_label=" x y\n", study=...),
        with_(pipeline_adcid="0123", timestamp="2024-01-15T10:30:45.5-05:00"),
        with_(timestamp="2024-01-15T10:30+0530", visit_number="007"),
        with_(timestamp=1705312800),
        with_(timestamp="2024-01-15T23:59:59.9999999"),
    ]
    a, b, c, d, e = check(spark, docs)
    assert (a.ptid, a.center_label, a.study) == ("AB", "x y", "adrc")
    assert b.pipeline_adcid == 123
    assert b.timestamp == datetime(2024, 1, 15, 15, 30, 45, 500000)
    assert c.timestamp == datetime(2024, 1, 15, 5, 0)
    assert c.visit_number == "007"
    assert d.timestamp == datetime(2024, 1, 15, 10, 0)
    assert e.timestamp == datetime(2024, 1, 15, 23, 59, 59, 999999)


def test_last_of_repeated_keys_wins(spark):
    doc = json.dumps(GOOD)[:-1] + ', "ptid": "LAST"}'
    (row,) = check(spark, [doc])
    assert row.errors == [] and row.ptid == "LAST"


def test_strict_profile(spark):
    docs = [
        with_(),
        with_(ptid="abc"),
        with_(pipeline_adcid=0),
        with_(visit_number=None),
        with_(visit_date="2024-02-30"),
        with_(gear_name=" "),
    ]
    got = [r.errors for r in check(spark, docs, strict=True)]
    assert got == [
        [],
        ["ptid: only capitals and digits"],
        ["pipeline_adcid: below 1"],
        ["visit_number: field required"],
        ["visit_date: not a calendar date"],
        ["gear_name: empty"],
    ]


def test_split_and_counts(spark):
    raw = spark.createDataFrame(
        [("a", json.dumps(GOOD)), ("b", "broken")], "source_key string, value string"
    )
    checked = validation.check_visit_events(raw)
    assert [r.source_key for r in validation.valid_rows(checked).collect()] == ["a"]
    assert validation.error_rows(checked).first().asDict() == {
        "source_key": "b", "errors": ["JSON decode error"],
    }
    assert validation.ingest_counts(checked).first()["success_rate"] == 0.5
    assert validation.ingest_counts(checked.limit(0)).first()["success_rate"] == 0.0


def test_batch_summary_and_fail_fast(spark):
    df = spark.range(10).withColumn(
        "errors",
        validation.error_list([validation.Rule("odd", F.col("id") % 2 == 1)]),
    )
    assert validation.batch_summary(df).first().asDict() == {
        "total_records": 10, "valid_records": 5, "invalid_records": 5, "success_rate": 50.0,
    }
    assert validation.fail_fast(df, "id").count() == 2
    good = df.filter("id % 2 = 0")
    assert validation.fail_fast(good, "id").count() == 5
    assert validation.batch_summary(df.limit(0)).first()["success_rate"] == 0.0
    assert validation.batch_errors(df, "id").count() == 5


def test_schema_checks(spark, basic):
    wider = basic.withColumn("more", F.lit(1)).drop("packet")
    found = {(r.column, r.problem) for r in validation.schema_diff(wider, schema.LEDGER).collect()}
    assert found == {("more", "extra"), ("packet", "missing")}
    assert validation.schema_diff(basic, schema.LEDGER).count() == 0
    with pytest.raises(validation.SchemaMismatch, match="packet"):
        validation.require_schema(wider, schema.LEDGER)
    declared = T.StructType([T.StructField("id", T.IntegerType())])
    with pytest.raises(validation.SchemaMismatch, match="id: expected int, got bigint"):
        validation.require_schema(spark.range(1), declared)


def test_conform_reorders_and_casts(basic):
    shuffled = basic.select(*reversed(basic.columns)).withColumn(
        "pipeline_adcid", F.col("pipeline_adcid").cast("bigint")
    )
    assert [f.dataType for f in validation.conform(shuffled).schema] == [
        f.dataType for f in schema.LEDGER
    ]
    assert validation.conform(shuffled.limit(0)).columns == list(schema.LEDGER_COLUMNS)


def test_record_models(spark):
    docs = [
        {"source": "a", "event_type": "b"},
        {"source": "a", "event_type": "b", "data": {"x": 1}, "metadata": None, "other": 1},
        {"source": "", "event_type": "b" * 51},
        {"source": 1, "data": [1]},
    ]
    raw = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, value string")
    rules = [
        validation.Rule("source: length", "length(source) NOT BETWEEN 1 AND 100"),
        validation.Rule("event_type: length", "length(event_type) NOT BETWEEN 1 AND 50"),
    ]
    checked = validation.check_records(raw, schema.REPORTING_EVENT, rules)
    got = [set(r.errors) for r in checked.orderBy("i").collect()]
    assert got == [
        set(),
        set(),
        {"source: length", "event_type: length"},
        {"source: not a string", "event_type: field required", "data: not a variant"},
    ]
    models = (schema.RECORD, schema.CUSTOMER, schema.TRANSACTION)
    for model in models:
        empty = validation.check_records(raw.limit(1), model).first()
        assert len(empty.errors) == len(model)


def test_rules_are_a_projection_that_spark_compiles(spark):
    """Inside a generator, or a function that Spark interprets, every rule is interpreted for every row."""
    raw = spark.createDataFrame([("a", "{}")], "source_key string, value string")
    plan = validation.check_visit_events(raw)._jdf.queryExecution().optimizedPlan().toString()
    by_rules = [line for line in plan.split("\n") if "ptid: bad pattern" in line]
    assert len(by_rules) == 1
    assert by_rules[0].lstrip(" +-:").startswith("Project")
    assert "lambdafunction" not in by_rules[0]
