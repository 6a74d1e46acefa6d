"""Secret scan: fixed formats, and formats learned from them by grammar inference.

One pass finds what the fixed formats match and, outside of it, every long token as a candidate. The
matched credentials are the labelled examples. For each kind a bounded sample of different ones makes a
prefix tree with counts; states whose continuations are statistically alike are merged (red-blue order,
Hoeffding test), which leaves a probabilistic automaton of the format. A model of neighbouring
characters, counted over all candidates, says how likely a token is as ordinary text. Every candidate of
every text is scored under each automaton; those as likely, per character, as held-out credentials are, and
likelier as credential than as ordinary text, are secrets too, wherever they stand.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

# --- fixed values: kinds and formats; the texts searched for words are lower-cased in A-Z ---
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
SYMBOLS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_.=-"

CANDIDATE_LENGTH = 12  # least characters of a candidate
LABELLED = 600  # most examples of a kind that are learned from, chosen by hash
LABELLED_LENGTH = 256  # longest example that is learned from
LEAST_LABELLED = 20  # examples without which a kind has no automaton
HELD_OUT = 4  # each fourth example is for the threshold only
QUANTILE = 0.02  # share of held-out examples that may fall below the threshold
ALPHA = 0.05  # error of the Hoeffding test

_CODE = np.full(256, -1, dtype=np.int16)
_CODE[list(SYMBOLS)] = np.arange(len(SYMBOLS))
_IS_SYMBOL = _CODE >= 0
_IS_HEX = np.zeros(256, dtype=bool)
_IS_HEX[list(b"0123456789abcdef")] = True
_EDGE = len(SYMBOLS)  # stands before the first and after the last symbol

_SCANNED = (
    "doc_id bigint, base array<struct<kind:int,start:bigint,stop:bigint>>,"
    " labelled array<struct<kind:int,value:string>>,"
    " candidates array<struct<start:bigint,stop:bigint,token:string>>"
)
RESULT = "doc_id bigint, spans array<struct<kind:int,start:bigint,stop:bigint>>"


def _runs(data: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of the given bytes, of ``least`` bytes or more."""
    inside = np.concatenate([[False], table[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, start, end and start of the value of all fixed-format matches in some bytes."""
    raw = data.tobytes()
    found = [
        (0, m.start(), m.end(), m.start(1))
        for m in _ASSIGN.finditer(raw.lower())
        if m.end(1) - m.start(1) >= ASSIGN_LENGTH
    ]
    found += [
        (1, m.start(), m.end(), m.start())
        for m in _ACCESS.finditer(raw)
        if m.end() - m.start() >= ACCESS_LENGTH
    ]
    fixed = np.array(found, dtype=np.int64).reshape(-1, 4)
    starts, ends = _runs(data, _IS_HEX, HEX_LENGTH)
    hexes = np.stack([np.full(len(starts), 2), starts, ends, starts], axis=1)
    rows = np.concatenate([fixed, hexes])
    rows = rows[np.lexsort((rows[:, 0], rows[:, 1]))]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def _texts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]


def _lists(row: np.ndarray, n: int, **columns: pa.Array) -> pa.Array:
    """List column of structs, from values sorted by row."""
    offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _scan(batches):
    """Matches, their values and all candidates of each text, in code points."""
    for batch in batches:
        for low, high, data, offsets in textkit.chunks(batch.column("text")):
            n = high - low
            # A newline is in no format, so that nothing runs from one text into the next.
            joined = np.insert(data, offsets[1:-1], 10)
            begins = offsets[:-1] + np.arange(n)
            points = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
            kind, start, stop, value = base_spans(joined)
            row = np.searchsorted(begins, start, side="right") - 1
            first, last = _runs(joined, _IS_SYMBOL, CANDIDATE_LENGTH)
            if len(start):  # candidates touch no match
                before = np.searchsorted(start, last, side="left")
                reach = np.concatenate([[-1], np.maximum.accumulate(stop)])[before]
                first, last = first[reach <= first], last[reach <= first]
            token_row = np.searchsorted(begins, first, side="right") - 1
            short = stop - value <= LABELLED_LENGTH

            def at(place, of_row, points=points, begins=begins):
                return pa.array(points[place] - points[begins[of_row]])

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, n),
                    _lists(
                        row, n, kind=pa.array(kind.astype(np.int32)), start=at(start, row),
                        stop=at(stop, row),
                    ),
                    _lists(
                        row[short], n, kind=pa.array(kind[short].astype(np.int32)),
                        value=pa.array(_texts_of(joined, value[short], stop[short]), pa.string()),
                    ),
                    _lists(
                        token_row, n, start=at(first, token_row), stop=at(last, token_row),
                        token=pa.array(_texts_of(joined, first, last), pa.string()),
                    ),
                ],
                ["doc_id", "base", "labelled", "candidates"],
            )


def _codes(tokens: list[str]) -> Iterator[list[int]]:
    for t in tokens:
        yield _CODE[np.frombuffer(t.encode(), np.uint8)].tolist()


def _neighbours(batches):
    """Counts of neighbouring symbols over a task's candidates."""
    side = _EDGE + 1
    total = np.zeros(side * side, np.int64)
    for batch in batches:
        tokens = batch.column("token").to_pylist()
        if tokens:
            line = np.concatenate([[_EDGE], *(np.array([*c, _EDGE]) for c in _codes(tokens))])
            total += np.bincount(line[:-1] * side + line[1:], minlength=side * side)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["pair", "n"])


def ordinary_text(tokens: DataFrame) -> np.ndarray:
    """Log probability of each symbol after each other, over all candidates.

    One row per pair of symbols comes to the driver, a number fixed beforehand.
    """
    side = _EDGE + 1
    counts = np.ones(side * side)
    counted = map_batches(tokens, _neighbours, "pair bigint, n bigint")
    for r in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r["pair"]] += r["n"]
    counts = counts.reshape(side, side)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


class Automaton:
    """A probabilistic automaton of one format, merged from a prefix tree of examples."""

    def __init__(self, examples: list[list[int]]):
        self.arrived, self.ended = [0], [0]
        self.next: list[dict[int, int]] = [{}]
        self.taken: list[dict[int, int]] = [{}]
        for codes in examples:
            state = 0
            self.arrived[0] += 1
            for c in codes:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.arrived)
                    for column, empty in ((self.arrived, 0), (self.ended, 0)):
                        column.append(empty)
                    self.next.append({})
                    self.taken.append({})
                self.taken[state][c] = self.taken[state].get(c, 0) + 1
                state = self.next[state][c]
                self.arrived[state] += 1
            self.ended[state] += 1
        self.shortest = min(map(len, examples), default=0)
        self._keep(self._merge())
        self._weigh()

    def _differ(self, n1: int, f1: int, n2: int, f2: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(f1 / n1 - f2 / n2) > bound

    def _alike(self, a: int, b: int) -> bool:
        """Whether two states end and go on alike, and so on for the states they lead to."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n1, n2 = self.arrived[a], self.arrived[b]
            if self._differ(n1, self.ended[a], n2, self.ended[b]):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                if self._differ(n1, self.taken[a].get(c, 0), n2, self.taken[b].get(c, 0)):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    pairs.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add a tree's counts to the states that its symbols lead to."""
        pairs = [(into, state)]
        while pairs:
            a, b = pairs.pop()
            self.arrived[a] += self.arrived[b]
            self.ended[a] += self.ended[b]
            for c, child in self.next[b].items():
                self.taken[a][c] = self.taken[a].get(c, 0) + self.taken[b][c]
                if c in self.next[a]:
                    pairs.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _merge(self) -> list[int]:
        """Merge alike states; returns those that are left."""
        kept, known = [0], {0}
        while True:
            fringe = [(s, c, t) for s in kept for c, t in self.next[s].items() if t not in known]
            if not fringe:
                return kept
            source, symbol, state = max(fringe, key=lambda e: (self.arrived[e[2]], -e[2]))
            like = next((k for k in kept if self._alike(k, state)), None)
            if like is None:
                kept.append(state)
                known.add(state)
            else:
                self.next[source][symbol] = like
                self._fold(like, state)

    def _keep(self, states: list[int]) -> None:
        """Drop the states that were merged into others, and number the rest anew."""
        number = {s: i for i, s in enumerate(states)}
        self.arrived = [self.arrived[s] for s in states]
        self.ended = [self.ended[s] for s in states]
        self.taken = [self.taken[s] for s in states]
        self.next = [{c: number[t] for c, t in self.next[s].items()} for s in states]

    def _weigh(self) -> None:
        """Logarithms by state.

        What a state has not seen shares a probability that falls with the number of its examples, and
        leads where most of them went.
        """
        self.step: list[list[tuple[int, float]]] = []
        for state, (arrived, ended) in enumerate(zip(self.arrived, self.ended, strict=True)):
            taken, following = self.taken[state], self.next[state]
            kinds = len(taken) + bool(ended)
            total = max(arrived + kinds, 1)
            unseen = _EDGE + 1 - kinds
            share = math.log(max(kinds, 1) / total / unseen) if unseen else 0.0
            usual = following[max(taken, key=lambda c: (taken[c], -c))] if taken else state
            row = [(usual, share)] * (_EDGE + 1)
            for c, to in following.items():
                row[c] = (to, math.log(taken[c] / total))
            if ended:
                row[_EDGE] = (state, math.log(ended / total))
            self.step.append(row)

    def log_likelihood(self, codes: list[int]) -> float:
        """Log probability of a token, its end included."""
        state, total = 0, 0.0
        for c in [*codes, _EDGE]:
            state, p = self.step[state][c]
            total += p
        return total


def is_credential(
    codes: list[int], formats: list[tuple[Automaton, float]], ordinary: np.ndarray
) -> bool:
    """Whether a token has one of the formats rather than being ordinary text."""
    line = np.array([_EDGE, *codes, _EDGE])
    usual = None
    for automaton, least in formats:
        if len(codes) < automaton.shortest:
            continue
        likely = automaton.log_likelihood(codes)
        if likely >= least * len(codes):
            usual = float(ordinary[line[:-1], line[1:]].sum()) if usual is None else usual
            if likely > usual:
                return True
    return False


def learn(examples: dict[int, list[str]]) -> list[tuple[Automaton, float]]:
    """An automaton for every kind with enough examples, and its least likelihood per character."""
    out = []
    for _, values in sorted(examples.items()):
        if len(values) < LEAST_LABELLED:
            continue
        codes = list(_codes(values))
        automaton = Automaton([c for i, c in enumerate(codes) if i % HELD_OUT])
        tested = sorted(automaton.log_likelihood(c) / len(c) for c in codes[::HELD_OUT])
        out.append((automaton, tested[int(QUANTILE * len(tested))]))
    return out


def labelled_examples(scanned: DataFrame, limit: int = LABELLED) -> dict[int, list[str]]:
    """Up to ``limit`` different values of each kind, those of the least hashes."""
    values = scanned.select(F.explode("labelled").alias("v")).select("v.*").distinct()
    out = {}
    for kind in range(len(KINDS) - 1):
        chosen = values.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(limit)
        out[kind] = [r["value"] for r in chosen.collect()]
    return out


def _judge(batches, formats: list[tuple[Automaton, float]], ordinary: np.ndarray):
    """The matches of each text, and those of its candidates that have a learned format."""
    kind = len(KINDS) - 1
    for batch in batches:
        spans, seen = [], {}
        for base, candidates in zip(
            batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True
        ):
            for c in candidates if formats else ():
                token = c["token"]
                if token not in seen:
                    seen[token] = is_credential(next(_codes([token])), formats, ordinary)
                if seen[token]:
                    base.append({"kind": kind, "start": c["start"], "stop": c["stop"]})
            spans.append(sorted(base, key=lambda s: (s["start"], s["kind"])))
        span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"]
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every text, as spans in code points: (kind, start, stop), stop exclusive.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Kinds are numbers into ``KINDS``; spans
    are in order of their start, then of their kind. Matches of one fixed format do not overlap, those
    of different ones may; a learned format (the last kind) touches none of them. Returns a row per row,
    with no spans for a null or empty text. Texts are scanned whole. Repeated rows are each reported; they
    count once as examples and each time in the model of ordinary text. Ties in the choice of examples
    go by the value. Without examples, as in an empty table, only the fixed formats are found.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    scanned = keep(map_batches(texts, _scan, _SCANNED), "scanned")
    examples = labelled_examples(scanned)
    tokens = scanned.select(F.explode("candidates.token").alias("token"))
    ordinary = ordinary_text(tokens)
    formats = learn(examples)
    return map_batches(
        scanned.select("doc_id", "base", "candidates"),
        partial(_judge, formats=formats, ordinary=ordinary),
        RESULT,
    )


def span_texts(spans: Column, last_kind: int) -> Column:
    """kind:start:stop of all spans up to a kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    chosen = F.filter(spans, lambda s: s["kind"] <= last_kind)
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def report(found: DataFrame) -> DataFrame:
    """Counts by fixed format, a digest of their spans, and all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{KINDS[i]}") for i in range(len(KINDS) - 1)],
        F.sha2(span_texts(F.col("spans"), len(KINDS) - 2).cast("binary"), 256).alias("base_sha256"),
        span_texts(F.col("spans"), len(KINDS) - 1).alias("spans"),
    )
