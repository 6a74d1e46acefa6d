"""Long repeated byte strings, by suffixes that start at content-defined anchors.

A string of ``LENGTH`` bytes is looked at through the first ``WINDOW`` positions it holds: the
one whose 32-byte gram hashes least is its anchor, and equal strings have their anchor at the
same place. So each start of a string belongs to one anchor, and only anchors with equal bytes
to their right are compared. A piece that a text repeats without a break has an anchor in every
period, all with the same strings; these are one row with their number, so that such texts do not
make one key very frequent.

Anchors whose whole context (all strings that belong to them) occurs twice are repeated from end
to end; those are counted, not gathered: by a polynomial hash, verified by a cryptographic digest of
their bytes, which does not share its collisions. Of the others, the contexts with equal right sides
are suffix-sorted: a mergesort whose comparisons find the common extension by binary search over
prefix polynomial hashes, and whose findings are compared byte by byte. A right side with very
many different contexts is not sorted in one task: its strings are counted by such a pair of hash
and digest.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

LENGTH = 400
WINDOW = 280
GRAM = 32
RIGHT = LENGTH - WINDOW  # bytes from the anchor on that every string of it holds
SORTED_CONTEXTS = 2_000  # contexts of one right side that a task sorts
PAIRED_CONTEXTS = 24  # contexts compared pair by pair

_ANCHORS = (
    "doc_id bigint, key bigint, low int, high int, anchor int, stop int, times int,"
    " right bigint, one bigint, two bigint"
)
_PLACES = ("low", "high", "anchor", "stop", "times")
_HASHES = ("right", "one", "two")
_CONTEXTS = (
    "right bigint, many boolean, alone boolean, doc_id bigint, key bigint, low int, span int,"
    " left int, bytes binary"
)
_MARKS = "doc_id bigint, key bigint, start int, stop int"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours, in three passes."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit cryptographic digest of each byte span."""
    raw = memoryview(data.tobytes())
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    joined = b"".join(hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in spans)
    return np.frombuffer(joined, dtype="<u8").astype(np.uint64)


def find_anchors(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of all rows: row, first and last start, anchor (in the row), and three hashes.

    Neighbours with equal hashes are given once, with the end of the last one's strings and how
    many they are.
    """
    lengths = np.diff(offsets)
    long = lengths >= LENGTH
    none = np.zeros(0, np.int64)
    if not long.any():
        return dict.fromkeys(("row", *_PLACES, *_HASHES), none)
    first = textkit.prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = textkit.span_hashes(first, at, at + GRAM)
    place = np.uint64(0xFFFFFFFF) - at.astype(np.uint64)
    least = sliding_min(grams >> np.uint64(32) << np.uint64(32) | place, WINDOW)
    begins = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(begins, offsets[:-1][long], 1)
    np.add.at(begins, offsets[1:][long] - LENGTH + 1, -1)
    start = np.flatnonzero(np.cumsum(begins[:-1]) > 0)
    anchor = (np.uint64(0xFFFFFFFF) - (least[start] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    row = np.searchsorted(offsets, start, side="right") - 1
    edge = np.flatnonzero(
        np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    )
    low, high = start[edge], start[np.concatenate([edge[1:], [len(start)]]) - 1]
    anchor, row = anchor[edge], row[edge]
    shape = textkit.mix((anchor - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    found = {
        "right": textkit.span_hashes(first, anchor, anchor + RIGHT),
        "one": textkit.span_hashes(first, low, high + LENGTH) + shape,
        "two": digests(data, low, high + LENGTH) ^ shape,
    }
    new = row[1:] != row[:-1]
    for v in found.values():
        new |= v[1:] != v[:-1]
    lead = np.flatnonzero(np.concatenate([[True], new]))
    last = np.concatenate([lead[1:], [len(row)]]) - 1
    base = offsets[row[lead]]
    return {
        "row": row[lead],
        "low": low[lead] - base,
        "high": high[lead] - base,
        "anchor": anchor[lead] - base,
        "stop": high[last] + LENGTH - base,
        "times": last - lead + 1,
    } | {k: v[lead].view(np.int64) for k, v in found.items()}


def _anchors(batches):
    for batch in batches:
        for low, _, data, offsets in textkit.chunks(batch.column("text")):
            found = find_anchors(data, offsets)
            row = pa.array(found["row"] + low)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(row),
                    batch.column("key").take(row),
                    *(pa.array(found[k].astype(np.int32)) for k in _PLACES),
                    *(pa.array(found[k]) for k in _HASHES),
                ],
                ["doc_id", "key", *_PLACES, *_HASHES],
            )


def _contexts(batches):
    """Bytes of the wanted contexts of each text."""
    for batch in batches:
        rows: list[tuple] = []
        texts, wanted = batch.column("text"), batch.column("wanted")
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
        for r in range(batch.num_rows):
            raw = (texts[r].as_py() or "").encode()
            for w in wanted[r].as_py():
                span = w["high"] - w["low"]
                piece = raw[w["low"] : w["high"] + LENGTH]
                left = w["anchor"] - w["low"]
                rows.append(
                    (w["right"], w["many"], w["alone"], ids[r], keys[r], w["low"], span, left, piece)
                )
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(9)]
        kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), *[pa.int32()] * 3]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [*kinds, pa.binary()], strict=True)],
            [f.split()[0] for f in _CONTEXTS.split(", ")],
        )


class Context:
    """Bytes around an anchor, with prefix hashes from it to either side."""

    def __init__(self, raw: bytes, left: int, span: int):
        data = np.frombuffer(raw, dtype=np.uint8)
        self.raw, self.left = raw, left
        self.least = left - span  # starts lie from ``least`` to ``left`` bytes before the anchor
        self.right = textkit.prefix_hashes(data[left:]).tolist()
        self.back = textkit.prefix_hashes(data[:left][::-1]).tolist()
        self.low, self.high = LENGTH + 1, -1  # distances of repeated starts found so far

    def add(self, low: int, high: int) -> None:
        low, high = max(low, self.least), min(high, self.left)
        if low <= high:
            self.low, self.high = min(self.low, low), max(self.high, high)


def common(a: list[int], b: list[int]) -> int:
    """Length of the common prefix of two strings, by binary search over prefix hashes."""
    low, high = 0, min(len(a), len(b)) - 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle] == b[middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _before(a: Context, b: Context) -> int:
    n = common(a.right, b.right)
    x, y = a.raw[a.left + n : a.left + n + 1], b.raw[b.left + n : b.left + n + 1]
    return (x > y) - (x < y)


def _by_bytes(group: list[Context]) -> None:
    """Repeated starts by their bytes alone; for strings whose hashes collide."""
    for d in range(LENGTH):
        here = [c for c in group if c.least <= d <= c.left]
        times = Counter(c.raw[c.left - d : c.left - d + LENGTH] for c in here)
        for c in here:
            if times[c.raw[c.left - d : c.left - d + LENGTH]] > 1:
                c.add(d, d)


def repeated_starts(group: list[Context]) -> None:
    """Find, for every context, the nearest and farthest start whose string another one has.

    Strings of a context all hold its anchor, so these two bound all its removed bytes.
    """
    ordered = sorted(group, key=cmp_to_key(_before))
    shared = [common(a.right, b.right) for a, b in zip(ordered, ordered[1:], strict=False)]
    if len(ordered) <= PAIRED_CONTEXTS:
        for i, a in enumerate(ordered):
            right = LENGTH
            for j in range(i + 1, len(ordered)):
                right = min(right, shared[j - 1])
                if right < RIGHT or LENGTH - right > a.left:
                    break
                b = ordered[j]
                left = common(a.back, b.back)
                if left + right < LENGTH:
                    continue
                if (
                    a.raw[a.left - left : a.left + right] != b.raw[b.left - left : b.left + right]
                ):
                    return _by_bytes(group)
                a.add(LENGTH - right, left)
                b.add(LENGTH - right, left)
        return None
    shared_ = np.array(shared)
    back = np.zeros((len(ordered), LENGTH + 1), dtype=np.uint64)
    for i, c in enumerate(ordered):
        back[i, : len(c.back)] = c.back
    least = np.array([c.least for c in ordered])
    most = np.array([c.left for c in ordered])
    for d in range(LENGTH):
        here = np.flatnonzero((least <= d) & (d <= most))
        if len(here) < 2:
            continue
        segment = np.concatenate([[0], np.cumsum(shared_ < LENGTH - d)])[here]
        key = textkit.mix(back[here, d]) + segment.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, first, inverse, times = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True
        )
        for i in np.flatnonzero(times[inverse] > 1).tolist():
            c, o = ordered[here[i]], ordered[here[first[inverse[i]]]]
            if (
                o is not c
                and c.raw[c.left - d : c.left - d + LENGTH] != o.raw[o.left - d : o.left - d + LENGTH]
            ):
                return _by_bytes(group)
            c.add(d, d)
    return None


def _groups(batches) -> Iterator[list[tuple]]:
    """Rows of one right side at a time; they arrive sorted by it."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and rows[0][0] != row[0]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _sorted_marks(batches):
    """Repeated ranges of the contexts that stand alone."""
    out: list[tuple] = []
    for rows in _groups(batches):
        group = [Context(r[8], r[7], r[6]) for r in rows]
        repeated_starts(group)
        for (_, _, alone, doc, key, low, _, left, _), c in zip(rows, group, strict=True):
            if alone and c.high >= 0:
                anchor = low + left
                out.append((doc, key, anchor - c.high, anchor - c.low + LENGTH))
        if len(out) > 10_000:
            yield _mark_batch(out)
            out = []
    yield _mark_batch(out)


def _mark_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["doc_id", "key", "start", "stop"],
    )


def _string_hashes(batches):
    """Hash and digest of every string of a context, for counting."""
    for batch in batches:
        parts = []
        for r in range(batch.num_rows):
            data = np.frombuffer(batch.column("bytes")[r].as_py(), dtype=np.uint8)
            start = np.arange(len(data) - LENGTH + 1)
            one = textkit.span_hashes(textkit.prefix_hashes(data), start, start + LENGTH)
            two = digests(data, start, start + LENGTH)
            parts.append((np.full(len(start), r), start, one, two))
        row, start, one, two = (
            np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64)
            for i in range(4)
        )
        at = pa.array(row.astype(np.int64))
        low = batch.column("low").take(at).to_numpy() + start
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(at),
                batch.column("key").take(at),
                batch.column("alone").take(at),
                pa.array(low.astype(np.int32)),
                pa.array(one.astype(np.uint64).view(np.int64)),
                pa.array(two.astype(np.uint64).view(np.int64)),
            ],
            ["doc_id", "key", "alone", "start", "one", "two"],
        )


def _cut(batches):
    """The texts without their marked bytes, as digests."""
    for batch in batches:
        rows: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for text, marks in zip(batch.column("text"), batch.column("marks"), strict=True):
            raw = (text.as_py() or "").encode()
            sha, at, removed, spans = hashlib.sha256(), 0, 0, 0
            for m in sorted((m["start"], m["stop"]) for m in marks.as_py() or ()):
                if m[0] > at or not spans:
                    sha.update(raw[at : m[0]])
                    spans += 1
                    at = m[0]
                if m[1] > at:
                    removed += m[1] - at
                    at = m[1]
            sha.update(raw[at:])
            for k, v in zip(rows, (len(raw), removed, spans, sha.hexdigest()), strict=True):
                rows[k].append(v)
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)),
            ],
            ["doc_id", *rows],
        )


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """Ranges of repeated bytes by document; they may overlap. texts has doc_id, key, text."""
    anchors = keep(map_batches(texts, _anchors, _ANCHORS), "anchors")
    # Written first, so that the join's two sides are plain exchanges and a hot key is split.
    seen = keep(
        anchors.groupBy("right").agg(F.sum("times").alias("n")).where("n > 1").select("right"),
        "seen",
    )
    shared = keep(anchors.join(seen, "right"), "shared")
    context = list(_HASHES)
    counted = keep(
        shared.groupBy(*context).agg(
            F.sum("times").alias("n"),
            F.min(F.struct("doc_id", "key", "low", "high", "anchor")).alias("first"),
        ),
        "contexts",
    )
    whole = shared.join(counted.where("n > 1").select(*context), context).select(
        "doc_id", "key", F.col("low").alias("start"), "stop"
    )
    sides = keep(
        counted.groupBy("right")
        .agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        .where("kinds > 1 and least = 1")
        .select("right", (F.col("kinds") > SORTED_CONTEXTS).alias("many")),
        "sides",
    )
    wanted = (
        counted.join(sides, "right")
        .select("right", "many", (F.col("n") == 1).alias("alone"), "first.*")
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"))
        .agg(
            F.collect_list(F.struct("right", "many", "alone", "low", "high", "anchor")).alias("wanted")
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("key") == F.col("of_key"))
    contexts = keep(
        map_batches(
            texts.join(wanted, same).select("doc_id", "key", "text", "wanted"), _contexts, _CONTEXTS
        ),
        "bytes",
    )
    few = contexts.where("not many").repartition("right").sortWithinPartitions("right")
    by_order = map_batches(few, _sorted_marks, _MARKS)
    strings = map_batches(
        contexts.where("many"),
        _string_hashes,
        "doc_id bigint, key bigint, alone boolean, start int, one bigint, two bigint",
    )
    # A context that occurs twice is marked already; here it only counts as another place.
    times = strings.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1")
    by_count = strings.where("alone").join(times.select("one", "two"), ["one", "two"]).select(
        "doc_id", "key", "start", (F.col("start") + LENGTH).alias("stop")
    )
    return whole.unionAll(by_order).unionAll(by_count)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Cut every byte that lies in a 400-byte string found anywhere else.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Strings are judged on the
    input, within one text also, where they may overlap; none crosses texts. Returns per row
    the bytes, removed bytes and maximal removed runs, and the digest of what is left. A null
    text is empty; texts under 400 bytes lose nothing. Repeated rows are copies of each other, so
    both lose what is 400 bytes or longer. An empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    marks = (
        repeated_ranges(texts.select("doc_id", "key", "text"))
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("key") == F.col("of_key"))
    joined = texts.join(marks, same, "left").select("doc_id", "text", "marks")
    return map_batches(joined, _cut, RESULT)
