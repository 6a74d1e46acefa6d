"""Layout along a space-filling curve."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from frames import event, ledger_frame
from tallybook.operators import clustering
from tallybook.sources.ledger_store import LedgerStore


def plain_curve(x, y, bits):
    out = 0
    for b in range(bits):
        out |= (y >> b & 1) << 2 * b | (x >> b & 1) << 2 * b + 1
    return out


def test_curve_deals_bits_in_turn(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    got = df.select("x", "y", clustering.curve([F.col("x"), F.col("y")], 3).alias("c")).collect()
    assert all(r["c"] == plain_curve(r["x"], r["y"], 3) for r in got)
    assert len({r["c"] for r in got}) == 64


def ledger(spark, n=3000):
    rows = [
        event(center=f"center{i * 7 % 16:02d}", ptid=f"P{i}",
              at=f"2024-{1 + i * 11 % 12:02d}-{1 + i * 5 % 28:02d} 10:{i % 60:02d}")
        for i in range(n)
    ]
    return ledger_frame(spark, rows)


def files_touched(df, condition):
    """Files whose least and greatest values leave room for matching rows."""
    bounds = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
        F.min("center_label").alias("c0"), F.max("center_label").alias("c1"),
    )
    return bounds.where(condition).count(), bounds.count()


TIME = "t1 >= '2024-03-01' AND t0 < '2024-04-01'"
CENTER = "c0 <= 'center05' AND c1 >= 'center05'"


def test_filters_on_either_column_open_fewer_files(spark, tmp_path):
    df = ledger(spark)
    paths = defaultdict(str, sorted=str(tmp_path / "a"), curved=str(tmp_path / "b"))
    df.repartitionByRange(16, "timestamp").sortWithinPartitions("timestamp").write.parquet(paths["sorted"])
    clustering.clustered(df, "timestamp", "center_label", 16).write.parquet(paths["curved"])
    plain, curved = (spark.read.parquet(paths[p]) for p in ("sorted", "curved"))
    assert curved.exceptAll(df).count() == 0 and curved.count() == df.count()
    by_center = files_touched(plain, CENTER)[0], files_touched(curved, CENTER)[0]
    assert by_center[0] == 16 and by_center[1] <= 8
    assert files_touched(curved, TIME)[0] <= 8


def test_compact_store_is_clustered_and_whole(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledgers"))
    df = ledger(spark, 600)
    for i in range(3):
        store.append(df.where(f"hash(ptid) % 3 = {i} OR hash(ptid) % 3 = -{i}"), f"r{i}")
    compact = store.rewrite(str(tmp_path / "compact"), files=4)
    assert compact.committed_runs() == ["rewrite"]
    assert compact.events().exceptAll(store.events()).count() == 0
    assert compact.events().count() == store.events().count()
    touched, files = files_touched(
        spark.read.parquet(str(tmp_path / "compact" / "events")), CENTER
    )
    assert touched < files


def test_no_rows_one_time_and_too_many_labels(spark, monkeypatch):
    df = ledger(spark, 20)
    assert clustering.clustered(df.limit(0), "timestamp", "center_label", 2).count() == 0
    one = df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    assert clustering.clustered(one, "timestamp", "center_label", 2).count() == 20
    blank = df.withColumn("center_label", F.lit(None).cast("string"))
    assert clustering.clustered(blank, "timestamp", "center_label", 2).count() == 20
    monkeypatch.setattr(clustering, "MOST_VALUES", 3)
    with pytest.raises(ValueError, match="values"):
        clustering.clustered(df, "timestamp", "center_label", 2)
