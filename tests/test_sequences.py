"""Event patterns: the automaton against regular expressions, and visits folded in pieces."""

import random
import re

import pytest
from pyspark.sql import functions as F

from frames import event, ledger_frame
from tallybook.operators import sequences

LETTER = {"submit": "s", "pass-qc": "p", "not-pass-qc": "f", "delete": "d"}
PATTERNS = [
    ["submit"],
    ["submit", "pass-qc"],
    ["submit", "not-pass-qc+", "pass-qc"],
    ["submit+", "pass-qc", "submit"],
    ["not-pass-qc+", "submit+", "not-pass-qc"],
    ["submit", "submit", "pass-qc"],
]


def as_regex(steps):
    return "".join(LETTER[s.removesuffix("+")] + "+" * s.endswith("+") for s in steps)


def run(a, actions):
    value = 0
    for action in actions:
        code = a.actions.index(action) if action in a.actions else len(a.actions)
        value += a.table[value % a.n_states * a.n_codes + code] - value % a.n_states
    return value // a.n_states


@pytest.mark.parametrize("steps", PATTERNS)
def test_automaton_counts_like_a_regular_expression(steps):
    a, rnd = sequences.compile_pattern(steps), random.Random(1)
    for _ in range(300):
        actions = rnd.choices(list(LETTER), k=rnd.randrange(30))
        text = "".join(LETTER[x] for x in actions)
        assert run(a, actions) == len(re.findall(as_regex(steps), text)), text


def test_bad_patterns():
    with pytest.raises(ValueError, match="plus"):
        sequences.compile_pattern(["submit", "pass-qc+"])
    with pytest.raises(ValueError, match="step"):
        sequences.compile_pattern([])


def histories(spark):
    """A hot visit, small ones, one without number, all in random row order."""
    rnd, rows, texts = random.Random(7), [], {}
    for visit, size in [("HOT", 700), *[(f"P{i}", rnd.randrange(1, 12)) for i in range(20)]]:
        number = None if visit == "P3" else "01"
        actions = rnd.choices(list(LETTER), k=size)
        texts[visit] = "".join(LETTER[a] for a in actions)
        for i, action in enumerate(actions):
            at = f"2024-03-{1 + i // 1440:02d} {i // 60 % 24:02d}:{i % 60:02d}"
            rows.append(event(action, ptid=visit, number=number, at=at))
    rnd.shuffle(rows)
    return ledger_frame(spark, rows), texts


@pytest.mark.parametrize("limits", [{}, {"piece": 3}, {"piece": 5, "max_group_rows": 10}])
def test_visits_of_any_size(spark, limits):
    df, texts = histories(spark)
    for steps in PATTERNS[2:4]:
        got = sequences.matches(df, steps, **limits)
        found = {r["ptid"]: r["n_matches"] for r in got.collect()}
        counts = {v: len(re.findall(as_regex(steps), t)) for v, t in texts.items()}
        assert found == {v: n for v, n in counts.items() if n}


def test_ties_decide_the_order(spark):
    rows = [event(a, at="2024-03-01 10:00") for a in ("pass-qc", "not-pass-qc", "submit")]
    df = ledger_frame(spark, rows).withColumn("place", F.when(F.col("action") == "submit", 1)
        .when(F.col("action") == "not-pass-qc", 2).otherwise(3))
    assert sequences.matches(df, PATTERNS[2], ["place"]).count() == 1
    back = df.withColumn("place", -F.col("place"))
    assert sequences.matches(back, PATTERNS[2], ["place"]).count() == 0


def test_no_group_is_larger_than_a_piece(spark):
    df, _ = histories(spark)
    plan = sequences.matches(df, PATTERNS[2])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_piece") and "CartesianProduct" not in plan
    assert sequences.matches(df.limit(0), PATTERNS[2]).count() == 0
