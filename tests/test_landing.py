"""Landing folders: listing in tasks, files taken once, one-object reads."""

import json
import os
import re
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook import session
from tallybook.catalog import ledgers
from tallybook.plans.landing_run import TAKEN, run_landing
from tallybook.sources import landing
from tallybook.sources.ledger_store import LedgerStore
from test_ledger import doc

NAME = "log-submit-20240115-1000{:02d}-42-ingest-A{}-2024-01-15.json"


@pytest.fixture
def store(spark, tmp_path):
    return LedgerStore(spark, str(tmp_path / "ledgers"))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "landing"
    path.mkdir()
    return path


def land(folder, numbers, text=None):
    for i in numbers:
        place = folder / f"day{i % 3}"
        place.mkdir(exist_ok=True)
        (place / NAME.format(i, i)).write_text(json.dumps(doc(i)) if text is None else text)


def test_listing_finds_empty_files_and_skips_hidden_ones(spark, folder):
    land(folder, range(7))
    (folder / "deep" / "er").mkdir(parents=True)
    (folder / "deep" / "er" / "empty é+.json").write_text("")
    (folder / "_SUCCESS").write_text("")
    (folder / ".hidden").mkdir()
    (folder / ".hidden" / "x.json").write_text("{}")
    rows = landing.list_landing(spark, str(folder)).collect()
    assert len(rows) == 8
    by_size = {os.path.basename(r["source_key"]): r["size"] for r in rows}
    assert by_size["empty é+.json"] == 0
    assert {os.path.basename(p) for p in by_size} == set(by_size)
    real = os.stat(rows[0]["source_key"].removeprefix("file:"))
    assert rows[0]["size"] == real.st_size


def test_listing_of_nothing(spark, folder):
    assert landing.list_landing(spark, str(folder)).count() == 0
    with pytest.raises(Exception, match="No such file"):
        landing.list_landing(spark, str(folder / "missing"))


def test_second_run_opens_only_what_is_new(spark, folder, store):
    land(folder, range(5))
    first = run_landing(spark, str(folder), store, "a")
    assert (first.n_files, first.status, store.events().count()) == (5, "ok", 5)
    idle = run_landing(spark, str(folder), store, "b")
    assert (idle.n_files, idle.result, idle.files.count()) == (0, None, 0)
    assert store.committed_runs() == ["a"]
    land(folder, range(5, 9))
    third = run_landing(spark, str(folder), store, "c")
    assert third.n_files == 4
    assert store.events().count() == 9
    assert store.aside(TAKEN).count() == 9


def test_taken_files_are_not_opened(spark, folder, store):
    land(folder, range(4))
    run_landing(spark, str(folder), store, "a")
    land(folder, [7])
    for i in range(4):  # same size and time, but no longer readable as what they were
        path = folder / f"day{i % 3}" / NAME.format(i, i)
        stat = path.stat()
        path.write_text("x" * stat.st_size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    run = run_landing(spark, str(folder), store, "b")
    assert run.n_files == 1
    assert run.result.errors.count() == 0


def test_bad_and_empty_files_are_quarantined_once(spark, folder, store):
    land(folder, range(3))
    land(folder, [3], "")
    land(folder, [4], "no json")
    run_landing(spark, str(folder), store, "a")
    assert run_landing(spark, str(folder), store, "b").n_files == 0
    kept = store.aside("quarantine").select(F.array_join("errors", ";")).collect()
    assert [r[0] for r in kept] == ["JSON decode error"] * 2


def test_a_rewritten_file_is_read_again(spark, folder, store):
    land(folder, range(3))
    run_landing(spark, str(folder), store, "a")
    path = folder / "day1" / NAME.format(1, 1)
    path.write_text(json.dumps(doc(40)))
    again = run_landing(spark, str(folder), store, "b")
    assert again.n_files == 1
    assert store.events().count() == 4


def test_files_of_a_failed_run_are_not_taken(spark, folder, store, monkeypatch):
    land(folder, range(3))
    real = store.append

    def fail(rows, run_id):
        raise OSError("no space")

    monkeypatch.setattr(store, "append", fail)
    failed = run_landing(spark, str(folder), store, "a")
    assert failed.status == "failed"
    assert store.aside(TAKEN) is None
    monkeypatch.setattr(store, "append", real)
    assert run_landing(spark, str(folder), store, "b").n_files == 3
    assert store.events().count() == 3


def test_lines_layout(spark, folder, store):
    (folder / "a.json").write_text("\n".join(json.dumps(doc(i)) for i in range(6)))
    assert run_landing(spark, str(folder), store, "a", layout="lines").n_files == 1
    assert run_landing(spark, str(folder), store, "b", layout="lines").n_files == 0
    assert store.events().count() == 6
    with pytest.raises(ValueError, match="layout"):
        run_landing(spark, str(folder), store, layout="xml")


def test_objects_written_and_read_back(spark, tmp_path):
    rows = [(f"f{i % 4}/n{i}.json", None if i == 3 else f"texte é {i}\n{{}}") for i in range(60)]
    df = spark.createDataFrame(rows, "name string, value string")
    assert landing.write_objects(df, str(tmp_path / "o")) == 60
    files = landing.list_landing(spark, str(tmp_path / "o"))
    back = {
        r["source_key"].removeprefix(f"file:{tmp_path}/o/"): r["value"]
        for r in landing.read_objects(files, 60).collect()
    }
    assert back == {n: v or "" for n, v in rows}


def test_untaken_is_a_join_not_a_driver_list(spark, folder):
    land(folder, range(3))
    files = landing.list_landing(spark, str(folder))
    plan = landing.untaken(files, files.limit(1))._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "CartesianProduct" not in plan


def test_local_files_are_read_without_threads(folder, monkeypatch):
    def refuse(*_):
        raise AssertionError("a thread was used")

    land(folder, range(70))
    land(folder, [70], text="")
    land(folder, [71], text="\x00 é" * 40_000)
    keys = sorted(str(p) for p in folder.rglob("*.json"))
    monkeypatch.setattr(landing.ThreadPoolExecutor, "map", refuse)
    asked = pa.RecordBatch.from_arrays([pa.array([f"file:{k}" for k in keys])], ["source_key"])
    got = [v for b in landing._read_batches(iter([asked])) for v in b.column("value").to_pylist()]
    assert got == [open(k, encoding="utf-8").read() for k in keys]


def test_tasks_stay_within_few_folders(spark, folder):
    rows = spark.range(400).select(
        F.format_string("f%02d/log-%d.json", F.col("id") % 20, "id").alias("name"),
        F.lit("{}").alias("value"),
    )
    at = F.spark_partition_id().alias("task")
    written = landing._by_folder(rows.repartition(8)).select(at, "folder").distinct()
    assert written.count() == 20
    assert landing.write_objects(rows, str(folder)) == 400
    files = landing.list_landing(spark, str(folder))
    read = landing.read_objects(files, 400)
    assert read.count() == 400
    inside = F.regexp_extract("source_key", "/(f[0-9]+)/", 1).alias("folder")
    assert read.select(at, inside).distinct().count() <= 20 + read.rdd.getNumPartitions()


def test_contents_go_on_in_large_batches_of_bounded_size(folder, monkeypatch):
    land(folder, range(60))
    paths = sorted(f"file:{p}" for p in folder.rglob("*.json"))
    paths = (paths * 5)[:290]
    keys = pa.RecordBatch.from_pydict({"source_key": paths})
    whole = list(landing._read_batches([keys, keys.slice(0, 0)]))
    assert [b.num_rows for b in whole] == [290]
    monkeypatch.setattr(landing, "_READ_BYTES", 1)
    parts = list(landing._read_batches([keys]))
    assert [b.num_rows for b in parts] == [64, 64, 64, 64, 34]
    assert pa.Table.from_batches(parts).to_pydict() == whole[0].to_pydict()
    assert whole[0].column("source_key").to_pylist() == paths
    assert json.loads(whole[0].column("value").to_pylist()[0])


# --- landings of more files than a disk is to hold ------------------------------------


@pytest.fixture
def events_dir(spark, tmp_path):
    """Events whose ids fall with time, lie far apart and are not whole folders."""
    path = tmp_path / "data"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(700).withColumn(
        "event_id", 90_000 - F.col("event_id") * 90
    ).coalesce(1).write.parquet(str(path / "events.parquet"))
    return str(path)


def files_below(root):
    return sum(len(n) for d, _, n in os.walk(root) if re.search(r"/objects-\w+/", d))


def sliced(query, spark, events_dir, tmp_path, monkeypatch, at_once):
    """The query's rows, the most files that ever lay there, and the files each run's listings found."""
    before, most, listed = files_below(tmp_path), [0], []
    real = landing.list_landing

    def watched(spark, path):
        most[0] = max(most[0], files_below(tmp_path) - before)
        listed.append(real(spark, path))
        return listed[-1]

    monkeypatch.setattr(ledgers, "_FILES_AT_ONCE", at_once)
    monkeypatch.setattr(landing, "list_landing", watched)
    monkeypatch.setattr(
        session, "scratch_path", lambda _, label: f"file:{tmp_path}/{label}-{uuid.uuid4().hex}"
    )
    rows = sorted(map(tuple, query(spark, events_dir).collect()))
    return rows, most[0], [x.count() for x in listed]


def test_landed_files_on_disk_are_bounded(spark, events_dir, tmp_path, monkeypatch):
    run = lambda n: sliced(
        ledgers.objects_ingest, spark, events_dir, tmp_path, monkeypatch, n
    )
    whole, most, listings = run(10**6)
    assert (len(whole), most, listings) == (700, 700, [700])
    parts, most, listings = run(250)
    assert parts == whole
    assert sum(listings) == 700 and len(listings) == 3
    assert most <= 300


def test_second_run_meets_the_files_of_the_first_in_every_slice(
    spark, events_dir, tmp_path, monkeypatch
):
    stores = []
    monkeypatch.setattr(
        ledgers,
        "_fresh_store",
        lambda s: stores.append(LedgerStore(s, f"{tmp_path}/ledgers-{len(stores)}")) or stores[-1],
    )
    run = lambda n: sliced(
        ledgers.landing_steps, spark, events_dir, tmp_path, monkeypatch, n
    )
    whole, _, listings = run(10**6)
    first = sum(r[0] == "first" for r in whole)
    assert 0 < first < 700 and listings == [first, 700]
    parts, most, listings = run(150)
    assert parts == whole
    assert len(listings) == 10 and most <= 200
    assert (sum(listings[:5]), sum(listings[5:])) == (first, 700)
    assert 0 in listings[:5]  # a slice without files of the first step
    # One store with one run a step, under the same watermarks as for the whole landing.
    assert [s.committed_runs() for s in stores] == [["first", "second"]] * 2
    for rows in (lambda s: s.events(), lambda s: s.aside("late").drop("run")):
        a, b = ([tuple(map(str, r)) for r in rows(s).collect()] for s in stores)
        assert sorted(a) == sorted(b)


def test_slices_hold_each_event_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "_FILES_AT_ONCE", 10)
    ids = [(i,) for i in [None, None, -5, 7, 7, *range(10**12, 10**12 + 90)]]
    spark.createDataFrame(ids, "event_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    sizes = [events.where(c).count() for c in ledgers._slices(spark, str(tmp_path), "/x")]
    assert sum(sizes) == 95 and len(sizes) == 10 and max(sizes) <= 13
    assert len(ledgers._slices(spark, str(tmp_path), "s3a://bucket/x")) == 1


def test_spent_files_are_taken_over(spark, folder):
    land(folder, range(9))
    (folder / "own.json").write_text("old" * 100)
    (folder / "a" / "b").mkdir(parents=True)
    (folder / "a" / "b" / "c.json").write_text("old")
    nodes = {os.stat(p).st_ino for p in folder.rglob("*.json")}
    landing.spend_landing(str(folder))
    assert landing.list_landing(spark, str(folder)).count() == 0
    rows = [(f"n{i % 2}/{i}.json", "" if i == 3 else f"é{i}" * i) for i in range(8)]
    df = spark.createDataFrame(rows, "name string, value string").coalesce(1)
    assert landing.write_objects(df, f"file:{folder}") == 8
    assert landing.write_objects(df, f"file:{folder}") == 8  # as a repeated task would
    files = landing.list_landing(spark, str(folder))
    back = {r[0].split("/landing/")[1]: r[1] for r in landing.read_objects(files, 8).collect()}
    assert back == dict(rows)
    assert {os.stat(folder / n).st_ino for n, _ in rows} <= nodes
    assert not list(folder.glob(".claimed*"))
    land(folder, range(30, 40))  # a rest of spares and files beyond them
    landing.spend_landing(str(folder))
    more = spark.createDataFrame([(f"m/{i}.json", "x") for i in range(40)], df.schema)
    assert landing.write_objects(more, str(folder)) == 40
    found = landing.list_landing(spark, str(folder))
    assert [r[1] for r in landing.read_objects(found, 40).collect()] == ["x"] * 40
    with pytest.raises(ValueError, match="local"):
        landing.spend_landing("s3a://bucket/x")


def test_a_spare_is_one_tasks_alone(folder):
    def use(spares):
        file = spares.take()
        if file:
            os.unlink(file)
        return file

    land(folder, range(6))  # two in each of three folders
    landing.spend_landing(str(folder))
    one, other = landing._Spares(str(folder)), landing._Spares(str(folder))
    taken = [use(one) for _ in range(3)] + [use(other) for _ in range(2)]
    assert len(set(taken)) == 5 and use(other) is None
    assert use(landing._Spares(str(folder))) is None  # as if the first task had failed
    one.give_back()
    assert use(landing._Spares(str(folder))) is not None


def test_objects_get_their_times(spark, folder):
    rows = spark.sql("""SELECT 'd/a' AS name, 'x' AS value, TIMESTAMP '2024-01-02 03:04:05.678901' AS modified
                        UNION ALL SELECT 'd/b', NULL, NULL""")
    assert landing.write_objects(rows, str(folder)) == 2
    found = landing.list_landing(spark, str(folder)).orderBy("source_key")
    times = [str(r[0]) for r in found.select(F.col("modified").cast("string")).collect()]
    assert times[0] == "2024-01-02 03:04:05.678901" and times[1] > "2026"
    with pytest.raises(ValueError, match="times from the store"):
        landing.write_objects(rows, "s3://bucket/x")


def test_no_objects_still_make_the_folder(spark, tmp_path):
    none = spark.createDataFrame([], "name string, value string")
    assert landing.write_objects(none, str(tmp_path / "none")) == 0
    assert landing.list_landing(spark, str(tmp_path / "none")).count() == 0
