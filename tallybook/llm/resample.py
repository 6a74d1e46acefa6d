"""Importance resampling: documents drawn by how much more the target would write them.

Two bag-of-n-gram models over hashed words and word pairs, one of the target texts and one
of all texts, give each document the logarithm of its importance weight. Adding Gumbel noise
and taking the largest keys draws without replacement in proportion to the weights.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

WORDS, PAIRS = 1 << 16, 1 << 17  # hashed words and word pairs; bounds both models
BUCKETS = WORDS + PAIRS
SMOOTHING = 5.0  # target occurrences added to each bucket
CERTAINTY = 3.0  # standard errors that a bucket's log ratio is moved towards 0
SEED = 17

_TABLE = textkit.is_word_byte()


def _features(column: pa.Array):
    """Row ranges, hashed words and pairs, and the row of each."""
    for low, high, data, offsets in textkit.chunks(column):
        words, _, _, first = textkit.word_hashes(data, offsets, _TABLE, lower=False)
        row = np.repeat(np.arange(high - low), np.diff(first))
        same = row[1:] == row[:-1]
        pairs = textkit.mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[same]
        grams = [words % np.uint64(WORDS), pairs % np.uint64(PAIRS) + np.uint64(WORDS)]
        yield low, high, np.concatenate(grams).astype(np.int64), np.concatenate([row, row[1:][same]])


def _count(batches):
    """Bucket counts of a task: of all its texts, and of its target texts."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        chosen = batch.column("is_target").to_numpy(zero_copy_only=False)
        for low, high, grams, row in _features(batch.column("text")):
            raw += np.bincount(grams, minlength=BUCKETS)
            target += np.bincount(grams[chosen[low:high][row]], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)],
        ["bucket", "raw", "target"],
    )


def _score(batches, weights: np.ndarray):
    for batch in batches:
        total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for low, high, grams, row in _features(batch.column("text")):
            total[low:high] = np.bincount(row, weights[grams], minlength=high - low)
            count[low:high] = np.bincount(row, minlength=high - low)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(count), pa.array(total)],
            ["doc_id", "n_grams", "log_weight"],
        )


def log_ratios(counted: DataFrame) -> np.ndarray:
    """Per bucket, the log of target over raw probability.

    Both counts are smoothed alike, and what the sampling error explains is taken off, as a
    text adds up thousands of ratios. One row per bucket comes to the driver, a number fixed
    beforehand.
    """
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    totals = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    for r in totals.collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum()) + SMOOTHING
    ratio = np.log((target + SMOOTHING) / expected)
    error = CERTAINTY / np.sqrt(expected)
    return np.sign(ratio) * np.maximum(0, np.abs(ratio) - error)


def gumbel(*keys: str) -> Column:
    """Gumbel noise that depends on the row's values only."""
    uniform = (F.pmod(F.xxhash64(F.lit(SEED), *keys), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def top_k(rows: DataFrame, key: str, order: list[str], k: int) -> DataFrame:
    """The k rows with the largest keys, however many; ties go by ``order``.

    The k-th key is found by counting rows in ever narrower ranges, 1024 at a time, so nothing
    is sorted as a whole. Only rows that share the k-th key exactly are numbered.
    """
    if k <= 0:
        return rows.limit(0)
    low, high, above = None, None, 0
    bounds = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    if bounds[2] <= k:
        return rows
    low, high = bounds[0], bounds[1]
    while low < high:
        width = (high - low) / 1024
        if width == 0 or low + width == low:
            break
        cell = F.least(F.floor((F.col(key) - low) / width), F.lit(1023)).cast("int")
        inside = rows.where(F.col(key).between(low, high))
        cells = inside.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        )
        for r in sorted(cells.collect(), key=lambda r: -r["cell"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    # Keys above ``high`` are in; those of the last range tie or are too close to divide.
    tied = rows.where(F.col(key).between(low, high))
    rank_order = [F.col(key).desc(), *[F.col(c) for c in order]]
    return rows.where(F.col(key) > high).unionByName(tied.orderBy(*rank_order).limit(k - above))


def resample(
    docs: DataFrame, labels: DataFrame, share: float | None = None
) -> DataFrame:
    """Draw documents that look like the good and harmless labelled ones.

    docs needs ``doc_id`` and ``text``, labels ``doc_id``, ``quality`` and ``toxic``; other
    columns are ignored. A document is a target if its labels all say quality 1 and toxic 0;
    a null in either says neither. ``share`` of all documents is drawn; by default as large a
    share as targets have among labelled documents, so that a corpus keeps about what its
    labels call good. Returns the drawn rows: doc_id, n_grams, log_weight, key. The noise hangs
    on doc_id, text length and weight, so repeated rows tie, and ties are drawn in the order of
    doc_id. A null or empty text weighs 0. Without targets all weights are 0, and without labels
    nothing is drawn; an empty table gives no rows.
    """
    judged = labels.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(
        (F.min(F.coalesce(F.col("quality") == 1, F.lit(False)))
         & F.min(F.coalesce(F.col("toxic") == 0, F.lit(False)))).alias("is_target")
    )
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    # One strategy at every size: labels grow with the corpus, so both sides are shuffled.
    joined = texts.join(
        judged.hint("merge"), F.col("doc_id") == F.col("label_id"), "left"
    ).select(
        F.coalesce("is_target", F.lit(False)).alias("is_target"), "text"
    )
    counted = map_batches(joined, _count, "bucket bigint, raw bigint, target bigint")
    weights = log_ratios(counted)
    scored = map_batches(
        texts, partial(_score, weights=weights), "doc_id bigint, n_grams bigint, log_weight double"
    )
    keyed = keep(
        scored.withColumn("key", F.col("log_weight") + gumbel("doc_id", "n_grams")), "keys"
    )
    if share is None:
        counts = judged.agg(F.count("*"), F.count_if("is_target")).first()
        share = counts[1] / counts[0] if counts[0] else 0.0
    return top_k(keyed, "key", ["doc_id", "n_grams"], round(share * keyed.count()))
