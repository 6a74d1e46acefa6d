"""Dates, times and durations as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# --- fixed values: accepted timestamp shape -----------------------------------
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\z"
)
# --- fixed values: dates in file names, tried in this order -------------------
NAME_DATES = (r"(\d{4}-\d{2}-\d{2})", r"(\d{8})", r"(\d{4}_\d{2}_\d{2})")


def parse_iso_utc(text: Column) -> Column:
    """ISO date or date-time text to a timestamp; no offset means UTC.

    Any other text is NULL: a plain cast would also take '2024' or a bare time,
    the latter as today. One pattern match decides the shape; the rest is by position.
    """
    tail = F.substring(text, 17, 40)  # what follows the minutes
    no_seconds = ~tail.startswith(":")
    full_clock = F.when(
        no_seconds, F.concat(F.substring(text, 1, 16), F.lit(":00"), tail)
    ).otherwise(text)
    zoned = tail.endswith("Z") | tail.contains("+") | tail.contains("-")
    complete = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(zoned, full_clock)
        .otherwise(F.concat(full_clock, F.lit("Z")))
    )
    return F.when(text.rlike(ISO_TIMESTAMP), complete.try_cast("timestamp"))


def to_iso(ts: Column) -> Column:
    """UTC timestamp as ISO text with offset; the fraction only when there is one."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
        F.lit("+00:00"),
    )


def try_date(text: Column) -> Column:
    """'YYYY-MM-DD' to a date, NULL when the calendar has no such day."""
    return text.try_cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def is_business_day(day: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(day) < 5


def business_days(start: Column, end: Column) -> Column:
    """Weekdays from start to end, both counted; 0 when reversed.

    Closed form: whole weeks give five each, the rest is at most six days that
    meet one weekend at most, so no per-day array is built.
    """
    span = F.datediff(end, start) + 1
    rest = F.pmod(span, F.lit(7))
    first = F.weekday(start)
    last = first + rest
    weekend = F.greatest(F.least(last, F.lit(7)) - F.greatest(first, F.lit(5)), F.lit(0))
    weeks = (span - rest) / 7
    days = weeks * 5 + rest - weekend
    return F.when(span <= 0, F.lit(0)).otherwise(days).cast("bigint")


def date_from_name(name: Column, patterns: Sequence[str] = NAME_DATES) -> Column:
    """First real calendar date written in a file name, by pattern order."""
    tries = []
    for pattern in patterns:
        digits = F.regexp_replace(F.regexp_extract(name, pattern, 1), r"[-_]", "")
        iso = F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3")
        tries.append(F.when(digits.rlike(r"^\d{8}\z"), iso.try_cast("date")))
    return F.coalesce(*tries)


def duration_text(seconds: Column) -> Column:
    """9015 -> '2h 30m 15s'; zero parts are left out, negative is '0s'."""
    whole = F.floor(seconds).cast("bigint")
    hours = F.floor(whole / 3600).cast("bigint")
    minutes = F.floor(F.pmod(whole, F.lit(3600)) / 60).cast("bigint")
    secs = F.pmod(whole, F.lit(60))
    shown = F.concat_ws(
        " ",
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h"))),
        F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit("m"))),
        F.when(
            (secs > 0) | ((hours == 0) & (minutes == 0)),
            F.concat(secs.cast("string"), F.lit("s")),
        ),
    )
    return F.when(seconds < 0, F.lit("0s")).otherwise(shown)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def hour_path(ts: Column) -> Column:
    """Path piece 'YYYY/MM/DD/HH'."""
    return F.date_format(ts, "yyyy/MM/dd/HH")
