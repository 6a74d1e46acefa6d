"""Quality rules as weak supervision: rules vote or abstain, and EM weighs them.

Everything runs in DataFrame functions. The votes are counted by pattern (at most three to
the power of the number of rules), and expectation-maximisation runs over that small table.

A document is good if it is no junk and does no harm. Rules on writing say nothing about
abuse, so each of the two has its own rules, its own hidden class and its own
expectation-maximisation, and the posterior is the product: many votes for clean writing
cannot outvote a complaint about insults.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import native
from tallybook.llm.scratch import keep

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
GOOD, BAD, ABSTAIN = 1, -1, 0

# Insults that mark abusive text.
INSULTS = [
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless",
    "disgusting", "clown",
]


@dataclass(frozen=True)
class Rule:
    """A vote by two tests on the measures; neither true is an abstention."""

    name: str
    good: Callable[[Callable[[str], Column]], Column]
    bad: Callable[[Callable[[str], Column]], Column]


def _share(part: str, of: str):
    return lambda m: m(part) / F.greatest(m(of), F.lit(1))


symbols = _share("n_symbols", "n_words")
repeats = _share("n_repeat_words", "n_words")
same_lines = _share("n_dup_lines", "n_lines")
word_length = _share("word_chars", "n_words")
capitals = _share("n_capitals", "word_chars")
stops = _share("n_stops", "n_words")
marks = _share("n_marks", "n_words")
insults = _share("n_insults", "n_words")
odd_per_word = _share("n_odd", "n_words")
odd_chars = _share("n_odd", "word_chars")

# Kinds of junk are each seen by more than one rule: a kind that a single rule sees cannot be
# told from that rule's errors without labels.
RULES = [
    Rule("symbols", lambda m: symbols(m) < 0.02, lambda m: symbols(m) > 0.1),
    Rule("odd_words", lambda m: odd_per_word(m) < 0.35, lambda m: odd_per_word(m) > 0.4),
    Rule("odd_chars", lambda m: odd_chars(m) < 0.07, lambda m: odd_chars(m) > 0.09),
    Rule("repeats", lambda m: repeats(m) < 0.02, lambda m: repeats(m) > 0.2),
    Rule("lines", lambda m: same_lines(m) == 0, lambda m: same_lines(m) > 0.4),
    Rule("capitals", lambda m: capitals(m) < 0.15, lambda m: capitals(m) > 0.4),
    Rule("stops", lambda m: stops(m) <= 0.3, lambda m: stops(m) > 0.5),
    Rule("marks", lambda m: marks(m) < 0.1, lambda m: marks(m) > 0.4),
    Rule(
        "word_length",
        lambda m: word_length(m).between(3, 8),
        lambda m: (word_length(m) < 2) | (word_length(m) > 14),
    ),
]
HARM_RULES = [
    Rule("insults", lambda m: m("n_insults") == 0, lambda m: insults(m) > 0.01),
    Rule("insult_count", lambda m: m("n_insults") == 0, lambda m: m("n_insults") >= 3),
]


def measures(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """Counts over each whole text, beside doc_id or what ``carry`` gives as ``doc``.

    A null text counts nothing.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def only(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(text, f"[^{pattern}]+", "")).cast("bigint")

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{native.SPACE}]"))
    words = native.words(text)
    inner = native.let(
        words,
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            native.let(
                F.transform(w, lambda x: F.xxhash64(x)),
                lambda h: native.covered_by_repeats(native.grams(h, 5), 5),
            ).alias("n_repeat_words"),
        ),
    )
    counted_lines = native.let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    insult = "(?i)\\b(?:" + "|".join(INSULTS) + ")\\b"
    key = F.col("doc_id").cast("bigint") if carry is None else carry.alias("doc")
    return docs.select(
        key,
        inner.alias("w"),
        counted_lines.alias("l"),
        only("#*$%&|<>").alias("n_symbols"),
        only("\\p{Lu}").alias("n_capitals"),
        only(".!?").alias("n_stops"),
        only("!?").alias("n_marks"),
        F.char_length(F.regexp_replace(text, "[\\p{L}\\p{N}\\s]+", ""))
        .cast("bigint")
        .alias("n_odd"),
        F.when(text.rlike(insult), F.size(F.regexp_extract_all(text, F.lit(insult), F.lit(0))))
        .otherwise(0)
        .cast("bigint")
        .alias("n_insults"),
    ).select(
        "doc_id" if carry is None else "doc",
        "w.*",
        "l.*",
        *["n_symbols", "n_capitals", "n_stops", "n_marks", "n_odd", "n_insults"],
    )


def votes(measured: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One vote column per rule."""
    return measured.withColumns(
        {
            f"vote_{r.name}": F.when(r.bad(F.col), BAD).when(r.good(F.col), GOOD).otherwise(ABSTAIN)
            for r in rules
        }
    )


@dataclass
class Model:
    """Prior share of good documents; per rule, how often its votes go which way in each class."""

    prior: float
    good: dict[str, dict[int, float]]
    bad: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """Probability that a document is good, given its votes; abstentions say nothing."""
        # The weights are one array that rows index by their votes. The plan's code is then the
        # same in every round and compiled once; numbers in the code would make each round new.
        weights, places = [], []
        for name in self.good:
            good, bad = (math.log(self.good[name][v] / self.bad[name][v]) for v in (GOOD, BAD))
            vote = F.col(f"vote_{name}")
            places.append(F.when(vote == GOOD, 1).when(vote == BAD, 2).otherwise(0) + len(weights))
            weights += [0.0, good, bad]
        weights[:3] = [w + math.log(self.prior / (1 - self.prior)) for w in weights[:3]]
        table = F.array(*[F.lit(float(w)) for w in weights])
        odds = functools.reduce(operator.add, [F.get(table, place) for place in places])
        return 1 / (1 + F.exp(-odds))


def start(rules: list[Rule]) -> Model:
    """Rules are taken to be better than chance; this also fixes which class is the good one."""
    return Model(
        0.85,
        {r.name: {GOOD: 0.98, BAD: 0.02} for r in rules},
        {r.name: {GOOD: 0.70, BAD: 0.30} for r in rules},
    )


def fit(voted: DataFrame, rules: list[Rule] = RULES, rounds: int = 12, prior_rows: float = 50.0):
    """Expectation-maximisation over the vote patterns; without rows the start values stay.

    ``prior_rows`` pseudo-documents with the start rates keep each rate and the share of good
    documents off 0 and 1, and a rule never counts for the class it votes against.
    """
    names = [f"vote_{r.name}" for r in rules]
    patterns = keep(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    first = start(rules)
    model = first
    for _ in range(rounds):
        # Long form keeps the plan small: a row per pattern and rule, and one for the pattern.
        cells = [F.struct(F.lit("").alias("rule"), F.lit(0).alias("vote"))] + [
            F.struct(F.lit(r.name).alias("rule"), F.col(f"vote_{r.name}").alias("vote"))
            for r in rules
        ]
        long = patterns.select(
            "n", model.posterior().alias("p"), F.explode(F.array(*cells)).alias("c")
        )
        sums = long.groupBy("c.rule", "c.vote").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("good")
        )
        seen = {(r["rule"], r["vote"]): (r["good"], r["n"] - r["good"]) for r in sums.collect()}
        if ("", 0) not in seen:
            return first
        total_good, total_bad = seen["", 0]
        share = (total_good + prior_rows * first.prior) / (total_good + total_bad + prior_rows)
        new = Model(share, {}, {})
        for r in rules:
            for k, which in enumerate(("good", "bad")):
                old = getattr(first, which)[r.name]
                votes_ = {v: seen.get((r.name, v), (0.0, 0.0))[k] for v in (GOOD, BAD)}
                total = sum(votes_.values()) + prior_rows
                rates = {v: (votes_[v] + prior_rows * old[v]) / total for v in (GOOD, BAD)}
                getattr(new, which)[r.name] = rates
            g, b = new.good[r.name], new.bad[r.name]
            if g[BAD] > b[BAD]:
                g[BAD] = b[BAD] = (g[BAD] + b[BAD]) / 2
            if g[GOOD] < b[GOOD]:
                g[GOOD] = b[GOOD] = (g[GOOD] + b[GOOD]) / 2
        model = new
    return model


def _failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judged(
    measured: DataFrame, rules: list[Rule], harm_rules: list[Rule]
) -> tuple[DataFrame, Column]:
    """Measures with votes, and the posterior that a document is neither junk nor harmful."""
    voted = keep(votes(measured, rules + harm_rules), "votes")
    parts = [fit(voted, part).posterior() for part in (rules, harm_rules) if part]
    return voted, functools.reduce(operator.mul, parts)


def apply_rules(
    docs: DataFrame, rules: list[Rule] = RULES, harm_rules: list[Rule] = HARM_RULES
) -> DataFrame:
    """Judge every document by the rules' posterior.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Returns the base counts,
    ``base_failed`` (under 10 words, or more than a fifth of them in repeated windows),
    ``kept`` (not base_failed and a posterior of at least a half), the posterior and the
    votes. A null or empty text has no words and fails. Texts are measured whole, whatever their
    length. Repeated rows and ties are judged alike; an empty table gives no rows.
    """
    voted, posterior = judged(measures(docs), rules, harm_rules)
    failed = _failed()
    return voted.select(
        "doc_id",
        *BASE,
        failed.alias("base_failed"),
        (~failed & (posterior >= 0.5)).alias("kept"),
        posterior.alias("p_good"),
        *[F.col(f"vote_{r.name}").cast("int").alias(f"vote_{r.name}") for r in rules + harm_rules],
    )


def keep_good(
    docs: DataFrame, rules: list[Rule] = RULES, harm_rules: list[Rule] = HARM_RULES
) -> DataFrame:
    """The documents that the rules keep, with all their columns, row by row.

    As ``apply_rules``: null and empty texts go, long ones are measured whole, repeated rows stay or
    go together, and an empty table gives no rows.
    """
    voted, posterior = judged(measures(docs, F.struct("*")), rules, harm_rules)
    return voted.where(~_failed() & (posterior >= 0.5)).select("doc.*")
