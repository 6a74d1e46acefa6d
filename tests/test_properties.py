"""Properties of ledgers and visits on generated events."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import event, ledger_frame
from tallybook.operators import counts, ranking, visits
from tallybook.plans import incremental

BASE = datetime(2024, 3, 1)


def generated(seed, n=400, hot=0.34):
    """Random events; one visit holds about a third of them, many times are equal."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        is_hot = rng.random() < hot
        ptid = "HOT" if is_hot else f"P{rng.randrange(12)}"
        number = None if is_hot or rng.random() < 0.3 else f"0{rng.randrange(3)}"
        form = rng.random() < 0.6
        rows.append(
            event(
                rng.choice(["submit", "delete", "pass-qc", "not-pass-qc"]),
                rng.randrange(50),
                f"c{rng.randrange(3)}",
                ptid,
                "2024-03-01",
                number,
                "UDS" if form else None,
                rng.choice([None, "I"]),
                str(BASE + timedelta(minutes=rng.randrange(90))),
                rng.choice(["adrc", "dvcid"]),
                "form" if form else "dicom",
            )
        )
    return rows


KEY = slice(6, 9)  # ptid, visit_date, visit_number
ACTION, AT = 0, 12


@pytest.fixture(scope="module", params=[1, 2])
def events(request, spark):
    rows = generated(request.param)
    df = ledger_frame(spark, rows).repartition(5).withColumn(
        "n", F.monotonically_increasing_id()
    )
    df = df.cache()
    df.count()
    local = [tuple(r) for r in df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).collect()]
    return df, local


def by_visit(local):
    groups = defaultdict(list)
    for r in local:
        groups[r[KEY]].append(r)
    return {k: sorted(v, key=lambda r: (r[AT], r[13])) for k, v in groups.items()}


def test_merge_loses_and_removes_nothing(events):
    df, local = events
    merged = incremental.merge(df, df.limit(50))
    assert merged.count() == len(local) + 50
    assert merged.groupBy("n").count().filter("count = 2").count() == 50


def test_latest_per_visit(events):
    df, local = events
    got = {tuple(r)[KEY]: r.n for r in visits.latest_per_visit(df, ["n"]).collect()}
    assert got == {k: v[-1][13] for k, v in by_visit(local).items()}


@pytest.mark.parametrize("limit", [ranking.MAX_GROUP_ROWS, 10])
def test_versions_with_and_without_slices(events, limit):
    df, local = events
    got = {
        r.n: (r.version, r.n_versions)
        for r in visits.versions(df, ["n"], max_group_rows=limit).collect()
    }
    want = {}
    for group in by_visit(local).values():
        for i, r in enumerate(group, 1):
            want[r[13]] = (i, len(group))
    assert got == want


def test_slices_split_a_hot_group(spark, events):
    df, _ = events
    numbered = ranking.number_within(
        df, visits.KEY, ["timestamp", "n"], max_group_rows=10
    )
    plan = numbered._jdf.queryExecution().toString()
    assert "_slice" in plan


def test_completeness_trend(events):
    df, local = events
    got = {
        tuple(r)[:3]: (r.n_events, r.latest_score, r.max_score, r.ever_drops)
        for r in visits.completeness_trend(df, ["n"]).collect()
    }
    want = {}
    for key, group in by_visit(local).items():
        scores = [sum(r[i] is not None for i in (8, 10, 11)) for r in group]
        drops = any(b < a for a, b in zip(scores, scores[1:], strict=False))
        want[key] = (len(group), scores[-1], max(scores), drops)
    assert got == want


def test_completeness_never_drops_when_events_only_add(spark):
    rows = []
    for v in range(5):
        for step in range(v % 4 + 2):
            rows.append(
                event(
                    ptid=f"V{v}", number=None if v % 2 else "1",
                    module="UDS" if step > 1 else None, packet="I" if step else None,
                    datatype="form" if step > 1 else "dicom",
                    at=str(BASE + timedelta(hours=step)),
                )
            )
    trend = visits.completeness_trend(ledger_frame(spark, rows)).collect()
    assert len(trend) == 5
    assert all(r.latest_is_max and not r.ever_drops for r in trend)


def test_steps_of_visits(events):
    df, local = events
    groups = by_visit(local)
    actions = {k: [r[ACTION] for r in v] for k, v in groups.items()}
    outcome = {"pass-qc", "not-pass-qc"}
    assert {tuple(r)[:3] for r in visits.missing_submit(df).collect()} == {
        k for k, a in actions.items() if "submit" not in a and outcome & set(a)
    }
    assert {tuple(r)[:3] for r in visits.missing_outcome(df).collect()} == {
        k for k, a in actions.items() if "submit" in a and not outcome & set(a)
    }
    assert {tuple(r)[:4] for r in visits.repeated_actions(df).collect()} == {
        (*k, x) for k, a in actions.items() for x in set(a) if a.count(x) > 1
    }
    assert {tuple(r)[:3] for r in visits.failed_then_passed(df).collect()} == {
        k
        for k, v in groups.items()
        if any(
            f[ACTION] == "not-pass-qc" and p[ACTION] == "pass-qc" and f[AT] < p[AT]
            for f in v
            for p in v
        )
    }


def test_extremes_include_ties(events):
    df, local = events
    lo, hi = min(r[AT] for r in local), max(r[AT] for r in local)
    got = visits.extreme_events(df).collect()
    assert len(got) == sum(r[AT] in (lo, hi) for r in local)
    assert sum(r.is_earliest for r in got) == sum(r[AT] == lo for r in local)


def test_watermark_split_is_a_partition(events):
    df, local = events
    cut = BASE + timedelta(minutes=45)
    marks = counts.watermarks(
        df.filter(F.col("timestamp").cast("timestamp_ntz") < F.lit(cut).cast("timestamp_ntz"))
    )
    new = {r.n for r in incremental.new_events(df, marks).collect()}
    late = {r.n for r in incremental.late_events(df, marks).collect()}
    assert not new & late and len(new) + len(late) == len(local)
    tops = defaultdict(lambda: datetime.min)
    for r in local:
        if r[AT] < cut:
            tops[(r[1], r[9])] = max(tops[(r[1], r[9])], r[AT])
    assert new == {r[13] for r in local if r[AT] > tops[(r[1], r[9])]}
