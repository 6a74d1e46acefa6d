"""Near copies by Order MinHash: sketches in text order, buckets, verification by alignment.

Each text becomes its sequence of five-word shingles, every one labelled with its occurrence.
A sketch takes the three labelled shingles that a hash function orders first and lists them in
text order; texts share it only if those shingles agree and stand in the same order. Texts
that share a sketch are candidates; a banded alignment of their shingles decides.

Texts with equal words are one node of the graph, so copies cost a count. Buckets with the same
members are looked at once. A bucket is dealt into blocks of about 256 nodes, and each pair of
blocks is one group: shared shingles are counted for all its pairs by a matrix product, and
pairs that can reach the threshold are aligned unless links of the group connect them already. So a
group gives fewer links than it has nodes, no pairs leave it, and no bucket is cut or held in one
task.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 24
MINIMA = 3
BLOCK = 256  # nodes of a bucket that meet in one group, about
COLUMNS = 4096  # shingles multiplied at a time

_TABLE = textkit.is_word_byte()
_FACTORS = textkit.numbers(SKETCHES, 31) | np.uint64(1)
_PLACE = textkit.numbers(MINIMA, 32) | np.uint64(1)


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Mark each shingle with the number of equal ones before it."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    if len(start) == len(shingles):
        return shingles
    count = np.diff(np.concatenate([start, [len(ranked)]]))
    occurrence = np.arange(len(ranked)) - np.repeat(start, count)
    out = np.empty_like(shingles)
    out[order] = textkit.mix(ranked + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def order_sketches(shingles: np.ndarray) -> np.ndarray:
    """One key per hash function: its first minima, in text order."""
    marked = labelled(shingles)
    values = marked[None, :] * _FACTORS[:, None]
    if len(marked) > MINIMA:
        at = np.argpartition(values, MINIMA - 1, axis=1)[:, :MINIMA]
        at.sort(axis=1)
    else:
        at = np.broadcast_to(np.arange(len(marked)), (SKETCHES, len(marked)))
    picked = marked[at]
    key = (picked * _PLACE[: picked.shape[1]]).sum(axis=1, dtype=np.uint64)
    return textkit.mix(key + np.arange(SKETCHES, dtype=np.uint64))


def _sketch(batches, column: str):
    for batch in batches:
        nodes, sizes, keys = [], [], []
        for _, _, data, offsets in textkit.chunks(batch.column(column)):
            words, _, _, first = textkit.word_hashes(data, offsets, _TABLE)
            shingles, at = textkit.shingles(words, first, SHINGLE)
            for r in range(len(at) - 1):
                own = words[first[r] : first[r + 1]]
                place = textkit.numbers(1, 41)[0] * np.arange(1, len(own) + 1, dtype=np.uint64)
                nodes.append(int(textkit.mix(own + place).sum(dtype=np.uint64)))
                sizes.append(int(at[r + 1] - at[r]))
                if sizes[-1]:
                    keys.append(order_sketches(shingles[at[r] : at[r + 1]]).view(np.int64))
                else:
                    keys.append(np.zeros(0, np.int64))
        counts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        flat = pa.array(np.concatenate([*keys, np.zeros(0, np.int64)]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                pa.array(sizes, pa.int32()),
                pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat),
            ],
            ["id", "node", "size", "keys"],
        )


def _words(batches, column: str):
    """The 32-bit word hashes of each text."""
    for batch in batches:
        found = []
        for _, _, data, offsets in textkit.chunks(batch.column(column)):
            words, _, _, first = textkit.word_hashes(data, offsets, _TABLE)
            short = (words >> np.uint64(32)).astype(np.uint32)
            found += [short[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(found, pa.binary())], ["node", "words"]
        )


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned share of two sequences of distinct labelled shingles; 0 if under ``least``.

    The alignment is a longest common subsequence, and the share is its length over that of
    both sequences less itself. A share of ``least`` leaves at most so many unaligned
    shingles, so only matches within that distance of the diagonal are looked at.
    """
    total = len(a) + len(b)
    need = least / (1 + least) * total
    if min(len(a), len(b)) < need - 1e-9:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = total - 2 * need
    near = np.abs(i - j) <= band + 1
    i, j = i[near], j[near]
    if len(i) < need - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        common = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            at = bisect_left(tails, x)
            tails[at : at + 1] = [x]
        common = len(tails)
    share = common / (total - common) if total > common else 1.0
    return share if share >= least - 1e-12 else 0.0


def _sequence(raw: bytes) -> np.ndarray:
    words = np.frombuffer(raw, dtype=np.uint32).astype(np.uint64)
    return labelled(textkit.shingles(words, np.array([0, len(words)]), SHINGLE)[0])


def shared_counts(texts: list[np.ndarray]) -> np.ndarray:
    """Number of labelled shingles that each two texts share."""
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    _, column, times = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    often = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[often] = np.arange(len(often))
    at = place[column]
    owner, at = owner[at >= 0], at[at >= 0]
    counts = np.zeros((len(texts), len(texts)), dtype=np.float32)
    for low in range(0, len(often), COLUMNS):
        here = (at >= low) & (at < low + COLUMNS)
        part = np.zeros((len(texts), min(COLUMNS, len(often) - low)), dtype=np.float32)
        part[owner[here], at[here] - low] = 1
        counts += part @ part.T
    return counts


def spanning_links(
    nodes: list[int], blocks: list[int], texts: list[np.ndarray], least: float = SIMILARITY
) -> list[tuple[int, int, float]]:
    """Links that connect all texts of the group that any of its links connect.

    Where there are two blocks, only pairs across them count; the others have groups of their
    own. Sharing as many shingles in any order is necessary, so only such pairs are aligned.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.float64)
    counts = shared_counts(texts)
    joint = sizes[:, None] + sizes[None, :] - counts
    near = np.triu(counts >= least * joint - 1e-6, 1)
    block = np.array(blocks)
    if len(set(blocks)) > 1:
        near &= block[:, None] != block[None, :]
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        a, b = root(i), root(j)
        if a != b and (share := similarity(texts[i], texts[j], least)):
            parent[a] = b
            links.append((nodes[i], nodes[j], share))
    return links


def _compare(batches):
    """Links of each group; groups arrive sorted by bucket and blocks."""
    out: list[tuple] = []

    def finish(rows: list[tuple]) -> None:
        if len(rows) > 1:
            # In the order of the nodes, groups with common members give the same links.
            rows.sort(key=lambda r: r[4])
            nodes, blocks = [r[4] for r in rows], [r[3] for r in rows]
            out.extend(spanning_links(nodes, blocks, [_sequence(r[5]) for r in rows]))

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and rows[0][:3] != row[:3]:
                finish(rows)
                rows = []
            rows.append(row)
        yield _link_batch(out)
        out.clear()
    finish(rows)
    yield _link_batch(out)


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
    kinds = [pa.int64(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "similarity"]
    )


def components(links: DataFrame) -> DataFrame:
    """Class of each linked node: one node of those it is connected to.

    In each round every node joins the least one around it, and the links are rewritten and made
    distinct, so they shrink. Nodes are hashes, so their order is random and a long chain
    breaks into short ones.
    """
    pairs = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = keep(links.select(*pairs).where("a != b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        joined = keep(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
            .unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("to")))
            .groupBy("node")
            .agg(F.min("to").alias("to")),
            "joined",
        )
        edges = keep(
            edges.join(joined.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
            .join(joined.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
            .where("to_a != to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct(),
            "edges",
        )
        if labels is None:
            labels = joined.select("node", F.col("to").alias("label"))
        else:
            moved = joined.select(F.col("node").alias("label"), "to")
            labels = keep(
                labels.join(moved, "label", "left").select(
                    "node", F.coalesce("to", "label").alias("label")
                ),
                "labels",
            )
    return labels


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of all rows, and the class of each node that is linked to another.

    docs has ``id``, which no two rows share, and ``text``. Returns (id, node) and (node, label).
    """
    schema = "id bigint, node bigint, size int, keys array<bigint>"
    rows = keep(map_batches(docs.select("id", "text"), partial(_sketch, column="text"), schema), "sketches")
    nodes = rows.groupBy("node").agg(
        F.min_by(F.struct("size", "keys"), "id").alias("s"), F.min("id").alias("id")
    )
    entries = keep(
        nodes.where("s.size > 0").select("node", F.explode("s.keys").alias("bucket")), "entries"
    )
    # Most buckets have one node, and most others have the members of another one.
    stats = entries.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    chosen = (
        stats.where("n > 1")
        .groupBy("n", "one", "two")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n")
    )
    open_ = keep(entries.join(chosen, "bucket"), "buckets")
    wanted = open_.select("node").distinct().join(nodes.select("node", "id"), "node")
    texts = docs.select("id", "text").join(wanted, "id").select("node", "text")
    words = map_batches(texts, partial(_words, column="text"), "node bigint, words binary")
    blocks = F.ceil(F.col("n") / BLOCK)
    block = F.pmod(F.xxhash64("node", F.lit(2)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    groups = (
        open_.join(words, "node")
        .withColumn("block", block)
        .select("bucket", "block", other.alias("other"), "node", "words")
        .select(
            "bucket",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "node",
            "words",
        )
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
    )
    links = keep(map_batches(groups, _compare, "a bigint, b bigint, similarity double"), "links")
    return rows.select("id", "node"), components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Class of each document among near copies.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Returns one row per input
    row: doc_id, class_id (the least id of its class), and whether it is that document. Words
    are white-space words in lower case; two texts are linked if the aligned share of their
    five-word shingles is at least 0.8, and a class is what links connect. Texts with equal
    words are one class, so all null, empty and blank texts are one; a text of fewer than five
    words is near its equals only. Rows are compared one by one, whatever their ids: a row
    without id takes its class's id, rows that share an id may be of different classes, and
    classes with the same least id have the same name. A class without any id has none. An empty
    table gives no rows.
    """
    rows = keep(
        docs.select(
            F.monotonically_increasing_id().alias("id"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        ),
        "rows",
    )
    ids, labels = classes(rows.select("id", "text"))
    return _named(ids.join(rows.select("id", "doc_id"), "id"), labels).select(
        "doc_id",
        "class_id",
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("is_first"),
    )


def _named(ids: DataFrame, labels: DataFrame) -> DataFrame:
    """Each row with the least doc_id of its class."""
    per_node = ids.groupBy("node").agg(F.min("doc_id").alias("low"))
    labelled_ = per_node.join(labels, "node", "left").select(
        "node", "low", F.coalesce("label", "node").alias("label")
    )
    per_class = labelled_.groupBy("label").agg(F.min("low").alias("class_id"))
    names = labelled_.join(per_class, "label").select("node", "class_id")
    return ids.join(names, "node")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: that of the least doc_id, null last.

    Classes are those of ``near_duplicates``, for null, empty, long and repeated texts too. Of rows that
    share the least id the first stays, as rows are numbered when they are first written. An empty
    table gives no rows.
    """
    row = "__row"
    while row in docs.columns:
        row += "_"
    kept = keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    texts = kept.select(F.col(row).alias("id"), F.col("text").cast("string").alias("text"))
    ids, labels = classes(texts)
    numbered = kept.select(F.col(row).alias("id"), F.col("doc_id").cast("bigint").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("first")
    per_node = ids.join(numbered, "id").groupBy("node").agg(first)
    per_class = (
        per_node.join(labels, "node", "left")
        .groupBy(F.coalesce("label", "node").alias("label"))
        .agg(F.min("first").alias("first"))
    )
    return kept.join(per_class.select(F.col("first.id").alias(row)), row, "left_semi").drop(row)
