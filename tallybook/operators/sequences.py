"""Patterns over the ordered events of each visit.

A pattern such as submit, not-pass-qc+, pass-qc becomes a small automaton. What a piece of a visit's events
does to it is a table, from the state before the piece to the state after it and the matches within. Tables
of neighbouring pieces combine into one, and the order of combining does not matter, so a visit
with very many events is folded in pieces, each in a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallybook import schema
from tallybook.operators import ranking

PIECE = 1024  # events, and then tables, folded at once
_LEVELS = 3  # PIECE ** _LEVELS events of a visit before the last fold takes more than PIECE tables


@dataclass(frozen=True)
class Automaton:
    """Counts non-overlapping matches; a step ending in + stands for one or more such events."""

    actions: tuple[str, ...]  # every other action has the code after the last one
    n_states: int
    table: tuple[int, ...]  # by state and action: next state, plus n_states where a match ends

    @property
    def n_codes(self) -> int:
        return len(self.actions) + 1


def compile_pattern(steps: Sequence[str]) -> Automaton:
    """Automaton of a pattern of neighbouring events, found anywhere in a visit.

    A match ends as soon as its last step is there, and the next one starts after it.
    """
    if not steps:
        raise ValueError("a pattern needs a step")
    if steps[-1].endswith("+"):
        raise ValueError("a match ends with its first last event; leave out the last plus")
    names = [s.removesuffix("+") for s in steps]
    actions = tuple(dict.fromkeys(names))
    done = len(steps)

    def after(progress: frozenset[int], code: int) -> frozenset[int]:
        """How many steps may be behind; none always may."""
        action = actions[code] if code < len(actions) else None
        reached = {0}
        for p in progress:
            if p < done and names[p] == action:
                reached.add(p + 1)
            if p and steps[p - 1].endswith("+") and names[p - 1] == action:
                reached.add(p)
        return frozenset(reached)

    start = frozenset({0})
    states, table, at = [start], [], 0
    while at < len(states):
        for code in range(len(actions) + 1):
            reached = after(states[at], code)
            ended = done in reached
            target = start if ended else reached
            if target not in states:
                states.append(target)
            table.append((states.index(target), ended))
        at += 1
    n = len(states)
    return Automaton(actions, n, tuple(s + n * ended for s, ended in table))


def _step(value: Column, after: Column, n: int) -> Column:
    """A value is matches * n + state; ``after`` is what its state becomes."""
    return value - value % n + after


def _through_events(codes: Column, a: Automaton) -> Column:
    """Table of a piece, from its action codes in order."""
    table = F.array(*[F.lit(t).cast("bigint") for t in a.table])
    same = F.array(*[F.lit(s).cast("bigint") for s in range(a.n_states)])
    return F.aggregate(
        codes,
        same,
        lambda acc, code: F.transform(
            acc,
            lambda v: _step(
                v, F.get(table, ((v % a.n_states) * a.n_codes + code).cast("int")), a.n_states
            ),
        ),
    )


def _through_tables(tables: Column, a: Automaton) -> Column:
    same = F.array(*[F.lit(s).cast("bigint") for s in range(a.n_states)])
    return F.aggregate(
        tables,
        same,
        lambda acc, t: F.transform(
            acc, lambda v: _step(v, F.get(t, (v % a.n_states).cast("int")), a.n_states)
        ),
    )


def _in_order(place: str, value: str) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(F.col(place), F.col(value))))
    return F.transform(rows, lambda r: r[value])


def matches(
    df: DataFrame,
    steps: Sequence[str],
    ties: Sequence[str] = (),
    keys: Sequence[str] = schema.VISIT_KEY,
    piece: int = PIECE,
    **limits,
) -> DataFrame:
    """Per visit with a match: ``n_matches``, the non-overlapping matches of the pattern.

    Events are in order of their time, then of ``ties``. ``limits`` go to the numbering of events.
    """
    a = compile_pattern(steps)
    code = F.lit(len(a.actions))
    for i, action in enumerate(a.actions):
        code = F.when(F.col("action") == action, i).otherwise(code)
    slim = df.select(*keys, "timestamp", *ties, code.cast("int").alias("_code"))
    numbered = ranking.number_within(
        slim, keys, ["timestamp", *ties], number="_n", total="_total", **limits
    )
    place = F.floor((F.col("_n") - 1) / piece).cast("bigint")
    pieces = (
        numbered.groupBy(*keys, place.alias("_piece"))
        .agg(_in_order("_n", "_code").alias("_codes"))
        .select(*keys, "_piece", _through_events(F.col("_codes"), a).alias("_table"))
    )
    for _ in range(_LEVELS - 1):
        above = F.floor(F.col("_piece") / piece).cast("bigint")
        pieces = (
            pieces.groupBy(*keys, above.alias("_above"))
            .agg(_in_order("_piece", "_table").alias("_tables"))
            .select(
                *keys,
                F.col("_above").alias("_piece"),
                _through_tables(F.col("_tables"), a).alias("_table"),
            )
        )
    whole = pieces.groupBy(*keys).agg(_in_order("_piece", "_table").alias("_tables"))
    end = F.get(_through_tables(F.col("_tables"), a), F.lit(0))
    found = whole.select(*keys, F.floor(end / a.n_states).cast("bigint").alias("n_matches"))
    return found.where("n_matches > 0")
