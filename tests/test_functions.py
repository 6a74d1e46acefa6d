"""Column functions against plain Python on many values."""

import re
from datetime import date, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallybook.functions import dates, text
from tallybook.operators import calendar, metrics, quality, retention


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_business_days_against_counting(spark):
    start = date(2024, 1, 1)
    pairs = [
        (start + timedelta(a), start + timedelta(a + n)) for a in range(9) for n in range(-2, 25)
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a date, b date")
    got = [
        r.n
        for r in df.select("i", dates.business_days(F.col("a"), F.col("b")).alias("n"))
        .orderBy("i")
        .collect()
    ]
    want = [
        sum((a + timedelta(d)).weekday() < 5 for d in range((b - a).days + 1)) for a, b in pairs
    ]
    assert got == want
    assert want[pairs.index((date(2024, 1, 5), date(2024, 1, 15)))] == 7


def test_duration_text(spark):
    got = apply(spark, [9015.0, 0.0, 3600.0, 59.9, -1.0, 61.0, 90061.0], dates.duration_text, "double")
    assert got == ["2h 30m 15s", "0s", "1h", "59s", "0s", "1m 1s", "25h 1m 1s"]


def test_date_from_name(spark):
    names = [
        "r_2024-01-15.csv", "r_20240115.csv", "r_2024_01_15.csv", "r_2024-13-45_20240116.csv",
        "none.csv", "20241345_2024_02_03", "2023-02-29 and 2024-02-29",
    ]
    d = date(2024, 1, 15)
    assert apply(spark, names, dates.date_from_name) == [
        d, d, d, date(2024, 1, 16), None, date(2024, 2, 3), None,
    ]


def test_byte_size(spark):
    units = ["B", "KB", "MB", "GB", "TB", "PB"]

    def plain(n):
        size, u = float(n), 0
        while size >= 1024 and u < 5:
            size, u = size / 1024, u + 1
        return f"{n} B" if u == 0 else f"{size:.1f} {units[u]}"

    values = [0, 1, 1023, 1024, 1536, 1280, 1792, 1075, 1048575, 1048576, 5 * 1024**3, 1024**5]
    values += [1024**6, 1024**4 * 5 // 4, 7 * 1024**2 // 4, 123456789, 987654321012]
    assert apply(spark, values, text.byte_size, "bigint") == [plain(v) for v in values]


def test_truncate(spark):
    assert apply(spark, ["abc", "abcdef", ""], lambda c: text.truncate(c, 5)) == [
        "abc", "ab...", "",
    ]
    assert apply(spark, ["abcdef"], lambda c: text.truncate(c, 3)) == ["abc"]
    assert apply(spark, ["abcdef"], lambda c: text.truncate(c, 4, "~")) == ["abc~"]


def test_safe_filename(spark):
    got = apply(spark, ['a<b>:"c', " .x. ", "...", "a/b\\c|d?e*f", "t\tn", ""], text.safe_filename)
    assert got == ["a_b___c", "x", "unnamed_file", "a_b_c_d_e_f", "t_n", "unnamed_file"]


def test_mask(spark):
    got = apply(
        spark,
        ["a.b@c.org x", "call 555-123-4567", "ssn 123-45-6789", "card 1234 5678 9012 3456", "é1"],
        text.mask,
    )
    assert got == [
        "[MASKED_EMAIL] x", "call [MASKED_PHONE]", "ssn [MASKED_SSN]",
        "card [MASKED_CREDIT_CARD]", "é1",
    ]
    assert apply(spark, ["id K77"], lambda c: text.mask(c, {"key": r"K\d+"})) == ["id [MASKED_KEY]"]


def test_mask_follows_unicode_word_boundaries(spark):
    values = ["éfoo@bar.com", "foo@bar.comé", "٣123-45-6789", "x123-45-6789", "ñ@x.org"]

    def plain(value):
        for name, pattern in text.MASK_PATTERNS.items():
            value = re.sub(pattern, text.mask_token(name), value)
        return value

    assert apply(spark, values, text.mask) == [plain(v) for v in values]


def test_numbers(spark):
    got = apply(spark, ["a1 -2.5 3. 2024-01", "none", "1,000"], text.numbers_in)
    assert got == [[1.0, -2.5, 3.0, 2024.0, -1.0], [], [1.0, 0.0]]


def test_whitespace(spark):
    assert apply(spark, ["  a \t b\n", " x  y "], text.collapse_whitespace) == ["a b", "x y"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n  ab", max_size=8), min_size=1, max_size=20))
def test_strip_like_python(spark, values):
    assert apply(spark, values, text.strip_whitespace) == [v.strip() for v in values]


def test_column_names(spark):
    assert text.styled("eventTypeId2Name", "snake") == "event_type_id2_name"
    assert text.styled("event_type_id", "camel") == "eventTypeId"
    df = spark.range(1).select(F.lit(1).alias("aB"), F.lit(2).alias("cD"))
    assert text.rename_columns(df, "snake").columns == ["a_b", "c_d"]
    clash = spark.range(1).select(F.lit(1).alias("aB"), F.lit(2).alias("a_b"))
    with pytest.raises(ValueError, match="share one name"):
        text.rename_columns(clash, "snake")


def test_iso_text(spark):
    got = apply(
        spark, ["2024-01-15T10:00:00Z", "2024-01-15T10:00:00.25+01:00"],
        lambda c: dates.to_iso(dates.parse_iso_utc(c)),
    )
    assert got == ["2024-01-15T10:00:00+00:00", "2024-01-15T09:00:00.250000+00:00"]


def test_reversed_spine_is_an_error(spark):
    one = spark.sql("SELECT date'2024-01-05' AS lo, date'2024-01-01' AS hi")
    with pytest.raises(Exception, match="before or equal"):
        calendar.date_spine(one, F.col("lo"), F.col("hi")).collect()
    assert calendar.date_spine(one, F.col("hi"), F.col("lo")).count() == 5


def test_calendar_bounds(spark):
    one = spark.sql("SELECT date'2024-02-10' AS d, timestamp'2024-01-15 14:30:00' AS t")
    row = one.select(
        dates.month_start(F.col("d")), dates.month_end(F.col("d")), dates.hour_path(F.col("t")),
        dates.is_business_day(F.col("d")),
    ).first()
    assert tuple(row) == (date(2024, 2, 1), date(2024, 2, 29), "2024/01/15/14", False)


def test_run_metrics(spark):
    runs = spark.sql(
        """SELECT timestamp'2024-01-01 10:00:00' AS start_time,
                  timestamp'2024-01-01 10:00:04' AS end_time, 3L AS records_processed,
                  1L AS records_failed, 1000L AS bytes_processed, 1L AS output_files_created,
                  array('a', 'b') AS errors
           UNION ALL SELECT timestamp'2024-01-01 09:00:00', timestamp'2024-01-01 09:00:00',
                  0L, 0L, 0L, 0L, array()
           UNION ALL SELECT timestamp'2024-01-01 11:00:00', timestamp'2024-01-01 10:59:00',
                  -1L, 0L, 0L, 0L, array('c')"""
    )
    a, b, c = metrics.run_metrics(runs).withColumn("bad", metrics.run_errors()).collect()
    assert (a.duration_seconds, a.total_records, a.success_rate) == (4.0, 4, 75.0)
    assert (a.records_per_second, a.bytes_per_second, a.bad) == (0.75, 250.0, [])
    assert (b.success_rate, b.records_per_second, b.bytes_per_second) == (0.0, 0.0, 0.0)
    assert c.bad == [
        "end_time must be after start_time", "records_processed must not be negative",
    ]
    total = metrics.roll_up(runs.limit(2)).first()
    assert (total.runs, total.records_processed, total.error_count) == (2, 3, 2)
    assert [r.error for r in metrics.run_error_rows(runs).collect()] == ["a", "b", "c"]


def test_quality(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (3, "c"), (1, "a"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "n int, s string")
    assert quality.duplicate_rows(df).first().asDict() == {"total_rows": 7, "duplicate_rows": 5}
    report = {r.column: (r.null_count, r.data_type) for r in quality.null_report(df).collect()}
    assert report == {"n": (2, "int"), "s": (3, "string")}
    empty = quality.null_report(df.limit(0)).collect()
    assert [r.null_percentage for r in empty] == [0.0, 0.0]
    assert quality.duplicate_rows(df.limit(0)).first().asDict() == {
        "total_rows": 0, "duplicate_rows": 0,
    }


def test_retention_ladder(spark):
    days = [0, 29, 30, 89, 90, 364, 365, 4000]
    tiers = {
        env: apply(spark, days, lambda c, p=p: retention.tier(c, p), "int")
        for env, p in retention.POLICIES.items()
    }
    assert tiers["dev"] == ["standard"] * 2 + ["expired"] * 6
    assert tiers["staging"] == ["standard"] * 4 + ["glacier"] * 4
    assert tiers["prod"] == ["standard"] * 4 + ["glacier"] * 2 + ["deep_archive"] * 2
    with pytest.raises(ValueError):
        retention.RetentionPolicy(glacier_days=10)
    with pytest.raises(ValueError):
        retention.RetentionPolicy(deep_archive_days=100)
