"""Masked pseudo-likelihood of documents under a window network trained here.

Words are hashed into buckets, whose number grows with the corpus, and buckets belong to classes:
frequent ones alone, the others by frequency. A small network predicts the class of each word from the
classes of the two words on either side; within a class a bucket has its corpus share. A
document's score is the sum over all its words of the conditional log-probability.

Words are hashed once and kept as numbers. The network is trained by parameter mixing: documents
are dealt by hash into groups of about as many words each, more of them in a larger corpus; each group is
run through in a fixed order from the common parameters, and the results are averaged by the
number of words trained on. Every word of every document is a target once: a round takes half of the
places of each stretch of ``STRIDE`` words, the other round the rest. How the input is partitioned
plays no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

BUCKET_WORDS = 256  # words of the corpus per bucket, as long as the bounds allow
LEAST_BITS, MOST_BITS = 14, 22  # of the number of buckets; the upper one bounds the model's memory
CLASSES = 256
FREQUENT = 128  # classes of one bucket
WIDTH = 24
AROUND = (-2, -1, 1, 2)
EDGE = CLASSES  # context beyond either end of a text
STRIDE = 8
ROUNDS = 2
BATCH = 1024
RATE = 0.1
BOUND = 30  # of class scores
GROUP_WORDS = 1 << 21  # words of a mixing group
CHUNK_WORDS = 1 << 18  # words worked on at a time, or one longer document

_KEPT = "doc_id bigint, mark bigint, words array<int>"

_TABLE = textkit.is_word_byte()
_ONES = np.ones(CLASSES, np.float32)  # a product with it sums rows in one pass


@dataclass
class Vocabulary:
    """Class of each bucket, and its log-probability within the class."""

    classes: np.ndarray
    inner: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        order = np.argsort(-counts, kind="stable")
        classes = np.empty(len(counts), dtype=np.int16)
        classes[order[:FREQUENT]] = np.arange(FREQUENT)
        tail = order[FREQUENT:]
        mass = np.cumsum(counts[tail] + 1.0)
        share = np.minimum(mass / mass[-1], 1 - 1e-9)
        classes[tail] = FREQUENT + (share * (CLASSES - FREQUENT)).astype(np.int16)
        total = np.bincount(classes, counts + 1.0, minlength=CLASSES)
        return cls(classes, np.log((counts + 1.0) / total[classes]).astype(np.float32))


@dataclass
class Network:
    """Position-wise embeddings, a hidden layer and a softmax over classes, as one vector."""

    flat: np.ndarray

    SHAPES = ((len(AROUND) * (CLASSES + 1), WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,))

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES)

    @classmethod
    def start(cls, class_counts: np.ndarray) -> Network:
        """Small fixed random weights; the output bias is the classes' log share."""
        flat = np.random.default_rng(5).normal(0, 0.1, cls.size()).astype(np.float32)
        net = cls(flat)
        _, hidden, _, out = net.parts()
        hidden[:] = 0
        out[:] = np.log((class_counts + 1) / (class_counts + 1).sum())
        return net

    def parts(self) -> list[np.ndarray]:
        views, at = [], 0
        for shape in self.SHAPES:
            n = int(np.prod(shape))
            views.append(self.flat[at : at + n].reshape(shape))
            at += n
        return views

    def _inner(self, context: np.ndarray) -> np.ndarray:
        """Hidden values with a column of ones, whose weight is the output bias."""
        embed, hidden, _, _ = self.parts()
        h = embed.take(context[:, 0], axis=0)
        for j in range(1, context.shape[1]):
            h += embed.take(context[:, j], axis=0)
        h += hidden
        inner = np.ones((len(h), WIDTH + 1), h.dtype)
        np.tanh(h, out=inner[:, :WIDTH])
        return inner

    def _output(self) -> tuple[np.ndarray, bool]:
        """Output weights with the bias as the last row, and whether class scores may need a bound.

        Hidden values are within 1, so no score is beyond the sum of its weights' sizes.
        """
        out = self.flat[-(WIDTH + 1) * CLASSES :].reshape(WIDTH + 1, CLASSES)
        return out, not np.abs(out).sum(axis=0).max() <= BOUND

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and class log-probabilities; context rows index the embeddings."""
        inner = self._inner(context)
        logits = np.clip(inner @ self._output()[0], -BOUND, BOUND)
        return inner[:, :WIDTH], logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def _scores(self, inner: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Class scores in the memory of an earlier call, as fresh pages cost as much as the product."""
        out, wide = self._output()
        logits = np.matmul(inner, out, out=room[: len(inner)])
        return np.clip(logits, -BOUND, BOUND, out=logits) if wide else logits

    def of_targets(self, context: np.ndarray, target: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Log-probabilities of the targets alone; room is working memory of a row per target."""
        logits = self._scores(self._inner(context), room)
        chosen = logits[np.arange(len(target)), target]
        return chosen - np.log(np.exp(logits, out=logits) @ _ONES)

    def gradient(
        self, context: np.ndarray, target: np.ndarray, room: np.ndarray | None = None
    ) -> np.ndarray:
        """Of the mean negative log-probability of the targets; room as for ``of_targets``.

        A row's scale, one over its sum of exponentials, goes to its hidden values and not over all classes.
        """
        embed, _, weight, _ = self.parts()
        n = len(target)
        inner = self._inner(context)
        d = self._scores(inner, working_memory(n) if room is None else room)
        total = np.exp(d, out=d) @ _ONES
        d[np.arange(n), target] -= total
        scale = (1 / (n * total))[:, None]
        dh = d @ weight.T
        dh *= scale
        slope = np.zeros(len(self.flat), np.float32)
        slope[-(WIDTH + 1) * CLASSES :].reshape(WIDTH + 1, CLASSES)[:] = (d.T @ (inner * scale)).T
        dh *= 1 - np.square(inner[:, :WIDTH])
        # The places of each embedding row side by side, and summed.
        flat_rows = context.ravel().astype(np.int16)
        order = np.argsort(flat_rows, kind="stable")
        rows = flat_rows[order]
        cuts = np.flatnonzero(np.diff(rows, prepend=-1))
        sums = np.add.reduceat(dh.take(order // context.shape[1], axis=0), cuts, axis=0)
        slope[: embed.size].reshape(embed.shape)[rows[cuts]] = sums
        np.sum(dh, axis=0, out=slope[embed.size : embed.size + WIDTH])
        return slope


def working_memory(n: int) -> np.ndarray:
    """Class scores of n targets."""
    return np.empty((n, CLASSES), np.float32)


def n_buckets(n_words: int) -> int:
    """Number of buckets for a corpus of so many words, a power of two."""
    bits = math.ceil(math.log2(max(n_words, 1) / BUCKET_WORDS)) if n_words > BUCKET_WORDS else 0
    return 1 << min(max(bits, LEAST_BITS), MOST_BITS)


def _hashed(batches):
    """Each text's words as 32-bit hashes."""
    for batch in batches:
        for low, high, data, offsets in textkit.chunks(batch.column("text")):
            words, _, _, first = textkit.word_hashes(data, offsets, _TABLE)
            short = (words >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low),
                    batch.column("mark").slice(low, high - low),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(short)),
                ],
                ["doc_id", "mark", "words"],
            )


def keep_words(docs: DataFrame) -> DataFrame:
    """doc_id, a mark that deals documents into groups, and the words as numbers; written once."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("mark"),
        text.alias("text"),
    )
    return keep(map_batches(rows, _hashed, _KEPT), "words")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of all rows as unsigned numbers, and the row offsets into them."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    return values.view(np.uint32), offsets - offsets[0]


def _row_chunks(column: pa.Array):
    """Row range, words and row offsets of about ``CHUNK_WORDS`` words, or of one longer row."""
    words, offsets = _lists(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_WORDS, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, words[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def spread(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all texts with edges around each text, and the place of every word among them."""
    reach = max(map(abs, AROUND))
    texts = np.arange(1, len(first))
    places = np.arange(len(classes)) + np.repeat(reach * texts, np.diff(first))
    padded = np.full(len(classes) + reach * len(first), EDGE, dtype=np.int64)
    padded[places] = classes
    return padded, places


def around(padded: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Embedding rows of the words around some places of ``spread``."""
    out = np.empty((len(places), len(AROUND)), dtype=np.int64)
    for j, step in enumerate(AROUND):
        np.add(padded.take(places + step), j * (CLASSES + 1), out=out[:, j])
    return out


def contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Embedding rows of the words around each word of its own text."""
    return around(*spread(classes, first))


def _count(batches, size: int):
    counts = np.zeros(size, np.int64)
    for batch in batches:
        words, _ = _lists(batch.column("words"))
        counts += np.bincount(words % np.uint32(size), minlength=size)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])


def _group_chunks(batches):
    """Group, words and row offsets of chunks that never cross a group; rows arrive sorted.

    A chunk ends where it would without the other groups of the task.
    """
    group, parts, count = None, [], 0

    def chunk():
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return group, np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])

    for batch in batches:
        words, offsets = _lists(batch.column("words"))
        for r, g in enumerate(batch.column("group").to_pylist()):
            if parts and (g != group or count >= CHUNK_WORDS):
                yield chunk()
                parts, count = [], 0
            group = g
            parts.append(words[offsets[r] : offsets[r + 1]].copy())
            count += len(parts[-1])
    if parts:
        yield chunk()


def _train(batches, vocabulary: Vocabulary, flat: np.ndarray, phases: range):
    """Adagrad from the common parameters over each group's texts; sums over the task's groups."""
    total, weight = np.zeros(len(flat)), 0
    group, net, squares, trained = None, None, None, 0
    size = np.uint32(len(vocabulary.classes))
    room, scores = np.empty(len(flat), np.float32), working_memory(BATCH)

    def close():
        nonlocal total, weight
        if trained:
            total += net.flat.astype(np.float64) * trained
            weight += trained

    for g, words, first in _group_chunks(batches):
        if g != group:
            close()
            group, trained = g, 0
            net = Network(flat.copy())
            squares = np.full(len(flat), 1e-3, dtype=np.float32)
        classes = vocabulary.classes[words % size].astype(np.int64)
        padded, places = spread(classes, first)
        for phase in phases:
            # Targets of a step lie far apart, so a step mixes texts.
            at = np.arange(phase, len(classes), STRIDE)
            steps = -(-len(at) // BATCH)
            for part in range(steps):
                pick = at[part::steps]
                slope = net.gradient(around(padded, places[pick]), classes[pick], scores)
                squares += np.square(slope, out=room)
                np.sqrt(squares, out=room)
                slope *= RATE
                net.flat -= np.divide(slope, room, out=room)
                trained += len(pick)
    close()
    if weight:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(flat))),
                pa.array(total),
                pa.array(np.full(len(flat), weight)),
            ],
            ["at", "total", "weight"],
        )


def _score(batches, vocabulary: Vocabulary, flat: np.ndarray):
    net, size = Network(flat), np.uint32(len(vocabulary.classes))
    scores = working_memory(BATCH)
    for batch in batches:
        total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for low, high, words, first in _row_chunks(batch.column("words")):
            buckets = words % size
            classes = vocabulary.classes[buckets].astype(np.int64)
            padded, places = spread(classes, first)
            logp = vocabulary.inner[buckets].astype(np.float64)
            for a in range(0, len(classes), BATCH):
                b = min(a + BATCH, len(classes))
                logp[a:b] += net.of_targets(around(padded, places[a:b]), classes[a:b], scores)
            row = np.repeat(np.arange(high - low), np.diff(first))
            total[low:high] = np.bincount(row, logp, minlength=high - low)
            count[low:high] = np.diff(first)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(count), pa.array(total)],
            ["doc_id", "n_words", "log_likelihood"],
        )


def train(kept: DataFrame) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of a corpus, from ``keep_words``.

    The driver gathers a count per bucket, whose number is bounded, and the network.
    """
    n_words = kept.agg(F.coalesce(F.sum(F.size("words").cast("bigint")), F.lit(0))).first()[0]
    size = n_buckets(n_words)
    counted = map_batches(kept.select("words"), partial(_count, size=size), "bucket bigint, n bigint")
    totals = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size)
    counts[totals.column("bucket").to_numpy()] = totals.column("n").to_numpy()
    vocabulary = Vocabulary.of(counts)
    net = Network.start(np.bincount(vocabulary.classes, counts, minlength=CLASSES))
    groups = max(1, -(-n_words // GROUP_WORDS))
    dealt = (
        kept.where(F.size("words") > 0)
        .withColumn("group", F.pmod("mark", F.lit(groups)))
        .repartition("group")
        .sortWithinPartitions("group", "mark", "doc_id")
        .select("group", "words")
    )
    for step in range(ROUNDS):
        phases = range(step * STRIDE // ROUNDS, (step + 1) * STRIDE // ROUNDS)
        mixed = (
            map_batches(
                dealt,
                partial(_train, vocabulary=vocabulary, flat=net.flat, phases=phases),
                "at bigint, total double, weight bigint",
            )
            .groupBy("at")
            .agg((F.sum("total") / F.sum("weight")).alias("value"))
            .collect()
        )
        flat = net.flat.copy()
        for r in mixed:
            flat[r["at"]] = r["value"]
        net = Network(flat)
    return vocabulary, net


def score(docs: DataFrame) -> DataFrame:
    """Train on all documents and score each: words, log-likelihood and its mean per word.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Words are white-space words
    in lower case, of whole texts. A null or empty text has no words, a score of 0 and a null mean.
    Repeated rows are each trained on and score alike, ties and their order play no part; an empty
    table gives no rows.
    """
    kept = keep_words(docs)
    vocabulary, net = train(kept)
    scored = map_batches(
        kept.select("doc_id", "words"),
        partial(_score, vocabulary=vocabulary, flat=net.flat),
        "doc_id bigint, n_words bigint, log_likelihood double",
    )
    words = F.nullif("n_words", F.lit(0))
    return scored.withColumn("mean_log_likelihood", F.col("log_likelihood") / words)
