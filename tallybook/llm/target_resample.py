"""Target-distribution importance resampling with exact selection by weighted medians.

Every document gets an integer weight, the floored mean of its features' gains: how much more often
the target texts use a feature's bucket than all documents do. Counts and gains are arrays over a
fixed number of buckets. Adding Gumbel noise that hangs on the document's id gives its score.

The cutoff is found without sorting. Each partition of the written keys tells the median of its
remaining keys and how many remain; the median of these medians, weighted by the remaining sizes, has at
least a quarter of the remaining keys on either side. Keys on the wrong side of it are discarded, until
the cutoff key itself is known. Only the winners are sorted, over ranges, and numbered.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 25  # percent of the documents with enough words
SEED = 7
SMALL_REST = 1_000  # remaining keys that are sorted at once instead of halved further
_SHORT = 64  # longest word whose checksum is computed in columns
_WORD = textkit.is_alnum_byte()
_LOWER = textkit.lower_bytes()
_KEY = ("minus_score", "no_id", "doc_id", "n_features", "row")


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value.astype(np.uint32)


_CRC = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksum registers after each byte span, from the registers before it."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    begin, sizes = starts[order], length[order]
    out = state[order]
    many = int(np.searchsorted(-sizes, -_SHORT, side="left"))  # spans longer than that come first
    for i in range(many):
        piece = data[begin[i] : begin[i] + sizes[i]].tobytes()
        out[i] = zlib.crc32(piece, int(out[i] ^ _ONES)) ^ 0xFFFFFFFF
    begin, sizes, rest = begin[many:], sizes[many:], out[many:]
    for j in range(int(sizes[0]) if len(sizes) else 0):
        k = int(np.searchsorted(-sizes, -j, side="left"))
        r = rest[:k]
        rest[:k] = _CRC[(r ^ data[begin[:k] + j]) & np.uint32(255)] ^ (r >> np.uint32(8))
    back = np.empty_like(out)
    back[order] = out
    return back


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row ranges, the bucket and row of each word and word pair, and the words of each row."""
    for low, high, data, offsets in textkit.chunks(column):
        data = _LOWER[data]
        starts, ends, first = textkit.word_spans(data, offsets, _WORD)
        count = np.diff(first)
        row = np.repeat(np.arange(high - low), count)
        words = crc_on(np.full(len(starts), _ONES), data, starts, ends)
        left = np.flatnonzero(row[1:] == row[:-1])
        spaced = words[left]
        spaced = _CRC[(spaced ^ np.uint32(32)) & np.uint32(255)] ^ (spaced >> np.uint32(8))
        pairs = crc_on(spaced, data, starts[left + 1], ends[left + 1])
        bucket = (np.concatenate([words, pairs]) ^ _ONES) % np.uint32(BUCKETS)
        yield low, high, bucket.astype(np.int64), np.concatenate([row, row[left]]), count


def _count(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, bucket, _, _ in features(batch.column("text")):
            total += np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Feature counts by bucket; at most one row per bucket comes to the driver."""
    counted = map_batches(texts.select("text"), _count, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed target and raw shares, floored."""
    all_raw, all_target = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target)))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, floored, from the id alone."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches, gains: np.ndarray, seed: int, carry: Sequence[str]):
    for batch in batches:
        n = batch.num_rows
        total, size, words = (np.zeros(n, np.int64) for _ in range(3))
        for low, high, bucket, row, count in features(batch.column("text")):
            # Sums of whole numbers far below 2**53, so exact.
            total[low:high] = np.bincount(row, gains[bucket], minlength=high - low).astype(np.int64)
            size[low:high] = np.bincount(row, minlength=high - low)
            words[low:high] = count
        weight = np.where(size > 0, total // np.maximum(size, 1), 0)
        ids = batch.column("doc_id").to_pylist()
        score = weight + np.fromiter((noise(i, seed) for i in ids), np.int64, n)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(x) for x in (words, size, weight, score)),
                *(batch.column(c) for c in carry),
            ],
            ["doc_id", "n_words", "n_features", "weight", "score", *carry],
        )


def _before(keys: list[np.ndarray], pivot: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which keys come before the pivot, and which equal it."""
    less = np.zeros(len(keys[0]), bool)
    same = np.ones(len(keys[0]), bool)
    for column, p in zip(keys, pivot, strict=True):
        less |= same & (column < p)
        same &= column == p
    return less, same


def _medians(batches, pivot: tuple[int, ...] | None):
    """Size and median of a partition's keys: before the pivot (side 0) and after it (side 1)."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
    rows = []
    if parts:
        keys = [np.concatenate(c) for c in zip(*parts, strict=True)]
        if pivot is None:
            sides = [np.ones(len(keys[0]), bool)]
        else:
            less, same = _before(keys, pivot)
            sides = [less, ~less & ~same]
        for side, chosen in enumerate(sides):
            mine = [k[chosen] for k in keys]
            if len(mine[0]):
                middle = np.lexsort(mine[::-1])[(len(mine[0]) - 1) // 2]
                rows.append((side, len(mine[0]), *(int(k[middle]) for k in mine)))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * (2 + len(_KEY))
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["side", "size", *_KEY]
    )


_MEDIANS = ", ".join(f"{c} bigint" for c in ("side", "size", *_KEY))


def weighted_median(medians: list[tuple[int, tuple[int, ...]]]) -> tuple[int, ...]:
    """The least median at which half of all sizes is reached."""
    half, reached = sum(size for size, _ in medians) / 2, 0
    for size, key in sorted(medians, key=lambda m: m[1]):
        reached += size
        if reached >= half:
            return key
    raise ValueError("no medians")


def _after(pivot: Sequence[int]) -> Column:
    """SQL form of a strict comparison of the key columns with a pivot."""
    out = F.lit(False)
    for name, p in zip(reversed(_KEY), reversed(pivot), strict=True):
        out = (F.col(name) > p) | ((F.col(name) == p) & out)
    return out


def _is(pivot: Sequence[int]) -> Column:
    out = F.lit(True)
    for name, p in zip(_KEY, pivot, strict=True):
        out &= F.col(name) == p
    return out


def cutoff_key(keys: DataFrame, k: int, small_rest: int = SMALL_REST) -> tuple[int, ...]:
    """The k-th key in order, of distinct keys; k lies between 1 and their number.

    One row per partition and side comes to the driver. A round is one pass over the keys that were
    written last; when most of those are discarded the rest is written anew, so that all passes
    together cost a few times the first.
    """
    pivot, written = None, 0
    while True:
        rows = map_batches(keys, partial(_medians, pivot=pivot), _MEDIANS).collect()
        sides: list[list[tuple[int, tuple[int, ...]]]] = [[], []]
        for r in rows:
            sides[r["side"]].append((r["size"], tuple(r[c] for c in _KEY)))
        chosen = sides[0]
        if pivot is not None:
            before = sum(size for size, _ in sides[0])
            if k == before + 1:
                return pivot
            if k <= before:
                keys = keys.where(~_after(pivot) & ~_is(pivot))
            else:
                keys, k, chosen = keys.where(_after(pivot)), k - before - 1, sides[1]
        rest = sum(size for size, _ in chosen)
        if rest <= small_rest:
            return sorted(tuple(r[c] for c in _KEY) for r in keys.select(*_KEY).collect())[k - 1]
        written = written or rest
        if rest * 4 < written:
            keys, written = keep(keys, "remaining"), rest
        pivot = weighted_median(chosen)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``rank`` 1, 2, 3 ... in the given order: a sort over ranges, then each range's offset."""
    laid = keep(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "sorted",
    )
    part = F.shiftrightunsigned("_place", 33)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()
    offsets, total = [], 0
    for r in sorted(sizes, key=lambda r: r["_part"]):  # one row per partition
        offsets.append((r["_part"], total))
        total += r["n"]
    table = rows.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        laid.withColumn("_part", part)
        .join(F.broadcast(table), "_part")  # as many rows as partitions
        .withColumn("rank", F.col("_offset") + within + 1)
        .drop("_part", "_offset", "_place")
    )


def resample_to_target(
    docs: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Draw ``share`` percent of the documents by how well they fit the target texts.

    docs needs ``doc_id`` and ``text``, target ``text``; of the other columns of docs those named in
    ``carry`` (``text`` may be one) are returned too. Words are runs of ASCII letters and digits and of
    all other characters beyond ASCII, A-Z lowered; features are the words and pairs of neighbours.
    Returns every row's doc_id, n_words, n_features, weight, score and rank: 1, 2, 3 ... by score
    for the drawn ones, null for others. Only documents of ``min_words`` words count and are drawn.

    A null text has no words; a document without features weighs 0 and is not drawn. Ties of a score go
    to the smaller doc_id, null last, then to fewer features; rows alike in all three tie and any of them
    are drawn, which shows only in carried columns. A null id draws the noise of the text ``null``.
    Repeated rows each count and may each be drawn. An empty target leaves all gains to the raw counts;
    an empty docs table gives no rows. Texts are read whole, whatever their length.
    """
    carry = list(carry)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(f"`{c}`") for c in carry if c not in ("doc_id", "text")],
    )
    wanted = target.select(F.col("text").cast("string").alias("text"))
    gains = bucket_gains(bucket_counts(texts), bucket_counts(wanted))
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    schema = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint" + "".join(
        f", `{c}` {kinds[c]}" for c in carry
    )
    scored = keep(
        map_batches(texts, partial(_score, gains=gains, seed=seed, carry=carry), schema).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "scored",
    )
    enough = F.col("n_words") >= min_words
    keyed = scored.withColumns(
        {
            "minus_score": -F.col("score"),
            "no_id": F.col("doc_id").isNull().cast("bigint"),
            "_id": F.col("doc_id"),
        }
    )
    keys = keyed.where(enough).select(
        "minus_score", "no_id", F.coalesce("_id", F.lit(0)).alias("doc_id"), "n_features",
        F.col("_row").alias("row"),
    )
    k = share * keys.count() // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score", *carry]
    none = F.lit(None).cast("bigint").alias("rank")
    if k == 0:
        return scored.select(*columns, none)
    cutoff = cutoff_key(keys, k)
    placed = keyed.withColumns({"doc_id": F.coalesce("_id", F.lit(0)), "row": F.col("_row")})
    drawn = enough & ~_after(cutoff)
    back = [F.col("_id").alias("doc_id"), *[F.col(f"`{c}`") for c in columns[1:]]]
    winners = numbered(placed.where(drawn), _KEY).select(*back, "rank")
    return placed.where(~drawn).select(*back, none).unionByName(winners)
