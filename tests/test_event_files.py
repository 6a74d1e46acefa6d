"""Event files on disk: selection, pruning, reading, and file writes."""

import json
import os
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tallybook.operators import validation
from tallybook.sources import event_files, folders, reports, specs
from tallybook.sources.reports import SchemaMismatch
from test_validation import GOOD

NAMES = {
    "log-submit-20240115-100000-42-ingest-form-110001-2024-01-15.json": True,
    "log-pass-qc-20240115-102000-42-ingest-form-110001-2024-01-15.json": True,
    "log-not-pass-qc-20240116-143000-45-ingest-dicom-leads-220002-2024-01-16.json": True,
    "deep/er/log-delete-20240117-000000-7-p-x_1-2024-01-17.json": True,
    "log-submit-20240115-100000-42-ingest-form-110001-01.json": False,
    "log-approve-20240115-100000-42-ingest-form-110001-2024-01-15.json": False,
    "log-submit-2024015-100000-42-ingest-form-110001-2024-01-15.json": False,
    "log-submit-20240115-100000-x-ingest-form-110001-2024-01-15.json": False,
    "log-submit-20240115-100000-42-ingest-form-110001-2024-01-15.json.bak": False,
    "notes.txt": False,
}


@pytest.fixture
def log(tmp_path):
    for name in NAMES:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(GOOD))
    return str(tmp_path)


def names(df, root):
    return {r.source_key.split(root + "/")[1] for r in df.collect()}


def test_selection_by_pattern(spark, log):
    want = {n for n, ok in NAMES.items() if ok}
    listed = event_files.list_files(spark, log)
    assert names(listed, log) == set(NAMES)
    assert names(event_files.select_event_files(listed), log) == want
    assert names(event_files.read_event_files(spark, log), log) == want
    custom = event_files.select_event_files(listed, pattern=r"^.*\.txt$")
    assert names(custom, log) == {"notes.txt"}


def test_listing_does_not_read_content(spark, log):
    plan = event_files.list_files(spark, log)._jdf.queryExecution().toString()
    scan = plan.split("== Physical Plan ==")[1]
    assert "content" not in scan


def test_fields_in_names(spark, log):
    listed = event_files.select_event_files(event_files.list_files(spark, log))
    rows = {r.name_action: r for r in event_files.filename_fields(listed).collect()}
    r = rows["not-pass-qc"]
    assert r.name_time == datetime(2024, 1, 16, 14, 30)
    assert (r.name_adcid, r.name_project, r.name_ptid, r.name_visit_date) == (
        45, "ingest-dicom-leads", "220002", "2024-01-16",
    )


@pytest.mark.parametrize(
    "condition, count",
    [
        ({"action": "pass-qc"}, 1),
        ({"on_date": date(2024, 1, 15)}, 2),
        ({"month": date(2024, 1, 31)}, 4),
        ({"adcid": 42}, 2),
        ({"project": "ingest-form"}, 2),
        ({"ptid": "110001", "visit_date": "2024-01-15"}, 2),
        ({"ptid": "110001", "action": "delete"}, 0),
    ],
)
def test_selection_by_name_fields(spark, log, condition, count):
    listed = event_files.list_files(spark, log)
    assert event_files.select_by_name(listed, **condition).count() == count


def test_newer_by_name_is_strict(spark, log):
    listed = event_files.list_files(spark, log)
    assert event_files.newer_by_name(listed, datetime(2024, 1, 15, 10, 20)).count() == 2


def test_files_before_the_cutoff_are_not_opened(spark, log):
    def files_read(df):
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().get("numFiles").get().value()

    newest = event_files.read_event_files(
        spark, log, named_from=datetime(2024, 1, 16, 14, 30), with_empty=False
    )
    assert len(newest.collect()) == 2
    assert files_read(newest) == 2
    everything = event_files.read_event_files(spark, log, pattern=None, with_empty=False)
    assert len(everything.collect()) == len(NAMES)
    assert files_read(everything) == len(NAMES)


def test_empty_files_are_reported(spark, log):
    empty = "log-submit-20240301-000000-1-p-x-2024-03-01.json"
    open(f"{log}/{empty}", "w").close()
    open(f"{log}/other-empty.txt", "w").close()
    missing = event_files.empty_event_files(spark, log)
    assert names(missing, log) == {empty}
    raw = event_files.read_event_files(spark, log)
    errors = validation.error_rows(validation.check_visit_events(raw)).collect()
    assert [r.errors for r in errors] == [["JSON decode error"]]


def test_lines_layout(spark, tmp_path):
    (tmp_path / "part-1").write_text("\n".join([json.dumps(GOOD)] * 3) + "\nbroken\n")
    raw = event_files.read_event_files(spark, str(tmp_path), layout="lines")
    assert validation.ingest_counts(validation.check_visit_events(raw)).first()["files_ok"] == 3
    with pytest.raises(ValueError, match="layout"):
        event_files.read_event_files(spark, str(tmp_path), layout="tar")


def test_modified_since_includes_the_bound(spark, tmp_path):
    for i, age in enumerate((300, 200, 100)):
        path = tmp_path / f"{i}.json"
        path.write_text("{}")
        moment = int(time.time()) - age
        os.utime(path, (moment, moment))
    listed = event_files.list_files(spark, str(tmp_path))
    middle = listed.withColumn("t", F.col("modified").cast("timestamp_ntz").cast("string"))
    bound = datetime.fromisoformat(sorted(r.t for r in middle.collect())[1])
    assert event_files.modified_since(listed, bound).count() == 2
    assert event_files.modified_since(listed).count() == 3
    assert event_files.modified_since(listed, bound, max_keys=2).count() == 1


def test_json_objects_and_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}')
    (tmp_path / "b.json").write_text('[{"k": 2}, {"k": 3}]')
    assert sorted(r.k for r in reports.read_json(spark, str(tmp_path)).collect()) == [1, 2, 3]


def test_json_changed_since(spark, tmp_path):
    for name, k, age in (("a", 1, 1000), ("b", 2, 10)):
        (tmp_path / f"{name}.json").write_text(f'[{{"k": {k}}}, {{"k": {k * 10}}}]')
        moment = int(time.time()) - age
        os.utime(tmp_path / f"{name}.json", (moment, moment))
    since = datetime.fromtimestamp(int(time.time()) - 100, timezone.utc).replace(tzinfo=None)
    got = reports.read_json_since(spark, str(tmp_path), "k int", since)
    assert sorted(r.k for r in got.collect()) == [2, 20]
    assert reports.read_json_since(spark, str(tmp_path), "k int").count() == 4


def test_csv_report(spark, tmp_path):
    source, target = tmp_path / "r.csv", str(tmp_path / "out.parquet")
    source.write_text('id,dummy\n1234,value\n4567,"two\nlines, ""quoted"""\n')
    new = reports.read_csv_report(spark, str(source))
    assert reports.load_report(new, target) == 2
    assert dict(new.dtypes) == {"id": "int", "dummy": "string"}
    assert reports.load_report(new, target, "append") == 2
    got = spark.read.parquet(target)
    assert got.count() == 4
    assert 'two\nlines, "quoted"' in {r.dummy for r in got.collect()}
    assert reports.load_report(new, target) == 2
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(SchemaMismatch):
        reports.load_report(new.withColumn("x", F.lit(1)), target, "append")
    with pytest.raises(SchemaMismatch):
        reports.load_report(new.select("dummy", "id"), target, "append")
    with pytest.raises(ValueError, match="mode"):
        reports.load_report(new, target, "merge")


def test_checked_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("s", F.lit("x"))
    reports.append_checked(df, path)
    reports.append_checked(df.select("s", "id"), path)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(SchemaMismatch):
        reports.append_checked(df.drop("s"), path)
    with pytest.raises(SchemaMismatch):
        reports.append_checked(df.withColumn("id", F.col("id").cast("int")), path)
    declared = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(SchemaMismatch, match="extra columns"):
        reports.write_parquet(df, path, declared=declared)
    with pytest.raises(ValueError, match="codec"):
        reports.write_parquet(df, path, codec="rar")


@pytest.mark.parametrize("codec", reports.CODECS)
def test_codec_is_used(spark, tmp_path, codec):
    import pyarrow.parquet as pq

    reports.write_parquet(spark.range(100), str(tmp_path / codec), codec)
    file = next((tmp_path / codec).glob("*.parquet"))
    used = pq.ParquetFile(file).metadata.row_group(0).column(0).compression.lower()
    assert used.startswith(codec.split("_")[0])


def test_report_path(spark, tmp_path):
    path = reports.report_path("bucket/tables/", "dev", "some/file.parquet/")
    assert path == "bucket/tables/dev/some/file.parquet"
    for bad in (("test", "f.parquet"), ("dev", "f.csv"), ("dev", "/f.parquet")):
        with pytest.raises(ValueError):
            reports.report_path("b", *bad)
    assert reports.load_report(spark.range(3), f"{tmp_path}/r.parquet", environment="dev") == 3
    assert spark.read.parquet(f"{tmp_path}/dev/r.parquet").count() == 3


def test_source_specs(spark, tmp_path):
    uri = {
        "s3://b/p/": specs.SourceSpec("n", "s3", {"bucket_name": "b", "prefix": "p/"}),
        "h:5432/d": specs.SourceSpec("n", "database", {"host": "h", "database": "d"}),
        "h:1/d": specs.SourceSpec("n", "database", {"host": "h", "database": "d", "port": 1}),
        "http://x": specs.SourceSpec("n", "api", {"base_url": "http://x"}),
        "q": specs.SourceSpec("n", "sqs", {"queue_url": "q"}),
    }
    assert [s.uri for s in uri.values()] == list(uri)
    for name, kind in specs.SOURCE_TYPES.items():
        with pytest.raises(ValueError, match=", ".join(sorted(kind.needed))):
            specs.SourceSpec("n", name)
    for bad in ({"name": ""}, {"name": "n" * 101}, {"type": "ftp"}, {"polling_interval": 0}):
        with pytest.raises(ValueError):
            specs.SourceSpec(**{"name": "n", "type": "api", "params": {"base_url": "u"}, **bad})
    spark.range(4).write.json(str(tmp_path / "j"))
    spec = specs.SourceSpec(
        "n", "s3", {"bucket_name": "b", "root": str(tmp_path), "prefix": "j", "format": "json"}
    )
    assert spec.read(spark).count() == 4
    with pytest.raises(NotImplementedError):
        uri["q"].read(spark)


def test_updated_since(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'2024-01-02 00:00:00'")
    assert specs.updated_since(df, "t", datetime(2024, 1, 1)).count() == 1
    assert specs.updated_since(df, "t", None).count() == 2


def test_folders(spark, tmp_path):
    assert not folders.exists(spark, str(tmp_path / "x"))
    assert folders.children(spark, str(tmp_path / "x")) == []
    folders.touch(spark, str(tmp_path / "x" / "y"))
    assert folders.exists(spark, str(tmp_path / "x"))
    assert folders.children(spark, str(tmp_path / "x")) == ["y"]
