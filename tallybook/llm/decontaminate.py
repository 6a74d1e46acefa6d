"""Benchmark passages in documents: SimHash windows, a multi-index, exact verification.

Windows of a few sizes run over every document on a grid; a size is used for the items that
are long enough to hold a whole grid window wherever they start. Window fingerprints within
the Hamming radius of an item's window are found through four 16-bit blocks: two 64-bit
fingerprints within 7 bits differ by at most one bit in some block, so looking up every block
with its one-bit neighbours misses none. Edits can move a fingerprint beyond the radius, and an
item longer than the largest window is known by its first words only, so the rarest shingles of
each item are looked up too: as many as make up more weight than a similar place can lack. Every
place that is similar enough holds one of them, so no leak is missed. A candidate counts if the
weighted-shingle similarity of the item and a run of as many words of the document is high enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import map_batches

SIZES = (8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
STEP = 4
RADIUS = 7
SHINGLE = 5
SIMILARITY = 0.8
BLOCK_ITEMS = 2_000  # items of one index; more items take more passes over the documents
HITS = "doc_id bigint, item bigint, first_word bigint, n_words bigint, similarity double"

_TABLE = textkit.is_alnum_byte()


def _bits(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8)).reshape(-1, 64)


def _fingerprints(sums: np.ndarray, size: int) -> np.ndarray:
    """One bit per position that most of the ``size`` words set."""
    return np.packbits(sums > size // 2, axis=1).view(np.uint64).ravel()


def _running(bits: np.ndarray) -> np.ndarray:
    """Sums of the rows before each row; differences hold below 2^15 rows."""
    out = np.zeros((len(bits) + 1, 64), dtype=np.int16)
    np.cumsum(bits, axis=0, dtype=np.int16, out=out[1:])
    return out


def shingle_weights(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a word list and their weights: letters, times occurrences."""
    hashes, at = textkit.shingles(words, np.array([0, len(words)]), SHINGLE)
    total = np.concatenate([[0], np.cumsum(lengths)])
    start = np.arange(at[-1])
    weights = total[np.minimum(start + SHINGLE, len(words))] - total[start]
    unique, inverse = np.unique(hashes, return_inverse=True)
    return unique, np.bincount(inverse, weights, minlength=len(unique))


def weighted_similarity(a: tuple, b: tuple) -> float:
    """Shared weight over joint weight of two shingle multisets."""
    shared, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum() if len(shared) else 0.0
    joint = a[1].sum() + b[1].sum() - both
    return float(both / joint) if joint else 0.0


class ItemIndex:
    """Fingerprints of the items' windows by size, and their blocks."""

    def __init__(self, items: list[tuple[int, str]]):
        column = pa.array([t for _, t in items], pa.string())
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        self.items, by_size = [], {}
        for low, _, data, offsets in textkit.chunks(column):
            hashes, starts, ends, first = textkit.word_hashes(data, offsets, _TABLE)
            for k in range(len(offsets) - 1):
                words = hashes[first[k] : first[k + 1]]
                lengths = (ends - starts)[first[k] : first[k + 1]]
                self.items.append((len(words), shingle_weights(words, lengths)))
                if not len(words):
                    continue
                fits = [s for s in SIZES if s + STEP - 1 <= len(words)]
                # An item too short for a grid window has windows of its own size at each word.
                size, step = (fits[-1], STEP) if fits else (len(words), 1)
                sums = _running(_bits(words))
                for shift in range(step):
                    prints = _fingerprints(sums[[shift + size]] - sums[[shift]], size)
                    by_size.setdefault((size, step), []).append((prints[0], low + k, shift))
        self.by_size = {}
        for key, rows in by_size.items():
            prints = np.array([r[0] for r in rows], dtype=np.uint64)
            owner = np.array([r[1] for r in rows])
            shift = np.array([r[2] for r in rows])
            self.by_size[key] = (prints, owner, shift, [self._block(prints, b) for b in range(4)])
        self.cover, self.cover_owner, self.cover_start = self._cover()

    def _cover(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingles of which every similar place of an item holds one: sorted, with their items.

        The shared weight of a similar place is at least SIMILARITY of the item's weight, so
        shingles of more than the rest cannot all be missing. The rarest ones are taken.
        """
        whole = [(k, w) for k, (n, w) in enumerate(self.items) if n >= SHINGLE]
        hashes = np.concatenate([np.zeros(0, np.uint64), *(w[0] for _, w in whole)])
        _, inverse, often = np.unique(hashes, return_inverse=True, return_counts=True)
        often, low, taken, owner = often[inverse], 0, [np.zeros(0, np.uint64)], []
        for k, (own, weights) in whole:
            order = np.argsort(often[low : low + len(own)], kind="stable")
            before = np.cumsum(weights[order]) - weights[order]
            # A little more than needed, so that rounding never decides.
            pick = order[before <= (1 - SIMILARITY + 1e-6) * weights.sum()]
            taken.append(own[pick])
            owner += [k] * len(pick)
            low += len(own)
        found = np.concatenate(taken)
        order = np.argsort(found, kind="stable")
        unique, start = np.unique(found[order], return_index=True)
        return unique, np.array(owner, dtype=np.int64)[order], np.append(start, len(found))

    def covered(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place, item) of shingles that cover an item."""
        if not len(self.cover):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        slot = np.minimum(np.searchsorted(self.cover, shingles), len(self.cover) - 1)
        at = np.flatnonzero(self.cover[slot] == shingles)
        low = self.cover_start[slot[at]]
        count = self.cover_start[slot[at] + 1] - low
        ends = np.cumsum(count)
        pick = np.repeat(low - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
        return np.repeat(at, count), self.cover_owner[pick]

    @staticmethod
    def _block(prints: np.ndarray, b: int):
        """Block values with their one-bit neighbours: membership, sorted values, owners."""
        value = (prints >> np.uint64(16 * b)).astype(np.uint16)
        flips = np.array([0] + [1 << i for i in range(16)], dtype=np.uint16)
        near = (value[:, None] ^ flips).ravel()
        owner = np.repeat(np.arange(len(prints)), len(flips))
        order = np.argsort(near, kind="stable")
        member = np.zeros(1 << 16, dtype=bool)
        member[near] = True
        start = np.searchsorted(near[order], np.arange((1 << 16) + 1))
        return member, owner[order], start

    def within_radius(self, key: tuple[int, int], prints: np.ndarray):
        """All pairs (window, item print) at most RADIUS bits apart, once each."""
        own, _, _, blocks = self.by_size[key]
        pairs = []
        for b, (member, owner, start) in enumerate(blocks):
            value = (prints >> np.uint64(16 * b)).astype(np.uint16)
            at = np.flatnonzero(member[value])
            low, count = start[value[at]], start[value[at].astype(np.int64) + 1] - start[value[at]]
            ends = np.cumsum(count)
            slot = np.repeat(low - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
            window, item = np.repeat(at, count), owner[slot]
            near = np.bitwise_count(prints[window] ^ own[item]) <= RADIUS
            pairs.append(window[near] * len(own) + item[near])
        found = np.unique(np.concatenate(pairs))
        return found // len(own), found % len(own)


def _windows(hashes: np.ndarray, first: np.ndarray, keys) -> Iterator[tuple]:
    """Fingerprints of all windows of each (size, step), with first word and row."""
    count = np.diff(first)
    if any(step == STEP for _, step in keys):
        blocks = -(-count // STEP)
        base = np.concatenate([[0], np.cumsum(blocks)])
        row = np.repeat(np.arange(len(count)), count)
        place = base[:-1][row] * STEP + np.arange(len(hashes)) - first[:-1][row]
        padded = np.zeros(base[-1] * STEP, dtype=np.uint64)
        padded[place] = hashes
        bits = _bits(padded).reshape(-1, STEP, 64)
        grid = _running(bits[:, 0] + bits[:, 1] + bits[:, 2] + bits[:, 3])
        grid_row = np.repeat(np.arange(len(count)), blocks)
        grid_word = (np.arange(base[-1]) - base[:-1][grid_row]) * STEP
    for size, step in keys:
        if step == STEP:
            m = size // STEP
            if len(grid) <= m:
                continue
            fits = grid_word[: len(grid) - m] + size <= count[grid_row[: len(grid) - m]]
            sums = (grid[m:] - grid[:-m])[fits]
            where, row = grid_word[: len(grid) - m][fits], grid_row[: len(grid) - m][fits]
        else:
            if len(hashes) < size:
                continue
            sums = _running(_bits(hashes))
            start = np.arange(len(hashes) - size + 1)
            row = np.searchsorted(first, start, side="right") - 1
            fits = start + size <= first[row + 1]
            sums = (sums[size:] - sums[:-size])[fits]
            where, row = (start - first[row])[fits], row[fits]
        yield (size, step), _fingerprints(sums, size), where, row


def best_place(
    shingles: np.ndarray, weights: np.ndarray, item: tuple, starts: np.ndarray
) -> tuple[float, int]:
    """Highest similarity of an item at the given first words of a row, and the first such word.

    A place is as many words as the item has, or those up to the row's end. The weight of all
    its shingles that the item has bounds the similarity, so places are tried from the
    highest bound until none can be better.
    """
    n, (own, own_weights) = item
    ends = np.minimum(starts + n - SHINGLE + 1, len(shingles))
    low = starts[0]
    part, part_weights = shingles[low : ends.max()], weights[low : ends.max()]
    slot = np.minimum(np.searchsorted(own, part), len(own) - 1)
    hit = own[slot] == part
    total = np.concatenate([[0], np.cumsum(part_weights)])
    known = np.concatenate([[0], np.cumsum(part_weights * hit)])
    all_own = own_weights.sum()
    joint = total[ends - low] - total[starts - low] + all_own
    most = np.minimum(known[ends - low] - known[starts - low], all_own)
    bound = most / (joint - most)
    best, at = 0.0, 0
    tried = np.flatnonzero(bound >= SIMILARITY)
    for k in tried[np.argsort(-bound[tried], kind="stable")].tolist():
        if bound[k] < best or (bound[k] == best and starts[k] > at):
            break
        here = slice(starts[k] - low, ends[k] - low)
        found = np.bincount(
            slot[here][hit[here]], part_weights[here][hit[here]], minlength=len(own)
        )
        both = np.minimum(found, own_weights).sum()
        share = float(both / (joint[k] - both))
        if share > best or (share == best and starts[k] < at):
            best, at = share, int(starts[k])
    return best, at


def find_in(column: pa.Array, index: ItemIndex) -> dict[str, list]:
    """Verified hits of a column of texts: row, item, first word, words, similarity."""
    out: dict[str, list] = {k: [] for k in ("row", "item", "first_word", "n_words", "similarity")}
    for low, _, data, offsets in textkit.chunks(column):
        hashes, starts, ends, first = textkit.word_hashes(data, offsets, _TABLE)
        lengths = ends - starts
        # First words to try, as ranges: (row, item) to pairs of the least and the greatest.
        places: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for key, prints, where, row in _windows(hashes, first, list(index.by_size)):
            window, item = index.within_radius(key, prints)
            _, owner, shift, _ = index.by_size[key]
            spots = zip(
                row[window].tolist(),
                owner[item].tolist(),
                (where[window] - shift[item]).tolist(),
                strict=True,
            )
            for r, i, at in spots:
                places.setdefault((r, i), set()).add((at - STEP, at + STEP))
        shingles, base = textkit.shingles(hashes, first, SHINGLE)
        at, item = index.covered(shingles)
        row = np.searchsorted(base, at, side="right") - 1
        for r, i, p in zip(row.tolist(), item.tolist(), (at - base[row]).tolist(), strict=True):
            places.setdefault((r, i), set()).add((p - index.items[i][0] + SHINGLE, p))
        summed = np.concatenate([[0], np.cumsum(lengths)])
        for (r, i), spots in sorted(places.items()):
            n, weights = index.items[i]
            total = int(first[r + 1] - first[r])
            # A place has at least one shingle; an item of fewer words is one as a whole.
            last = total - (SHINGLE if n >= SHINGLE else n)
            if last < 0:
                continue
            steps = np.zeros(last + 2, dtype=np.int64)
            for a, b in spots:
                if b >= 0 and a <= last:
                    steps[max(a, 0)] += 1
                    steps[min(b, last) + 1] -= 1
            tries = np.flatnonzero(np.cumsum(steps)[:-1] > 0)
            if not len(tries):
                continue
            if n >= SHINGLE:
                begin = first[r] + np.arange(total - SHINGLE + 1)
                best = best_place(
                    shingles[base[r] : base[r + 1]],
                    summed[begin + SHINGLE] - summed[begin],
                    index.items[i],
                    tries,
                )
            else:
                best = (0.0, 0)
                for p in tries.tolist():
                    a = first[r] + p
                    own = shingle_weights(hashes[a : a + n], lengths[a : a + n])
                    share = weighted_similarity(own, weights)
                    best = (share, p) if share > best[0] else best
            if best[0] >= SIMILARITY:
                for k, v in zip(out, (low + r, i, best[1], n, best[0]), strict=True):
                    out[k].append(v)
    return out


def _hits(batches, index: ItemIndex):
    for batch in batches:
        found = find_in(batch.column("text"), index)
        row = pa.array(found["row"], pa.int64())
        item = pa.array(index.ids[np.array(found["item"], dtype=np.int64)], pa.int64())
        rest = [
            pa.array(found[k], t)
            for k, t in (
                ("first_word", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64()),
            )
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(row), item, *rest],
            ["doc_id", "item", "first_word", "n_words", "similarity"],
        )


def _clean(batches, index: ItemIndex, column: str):
    for batch in batches:
        found = find_in(batch.column(column), index)
        keep = np.ones(batch.num_rows, dtype=bool)
        keep[np.array(found["row"], dtype=np.int64)] = False
        yield batch.filter(pa.array(keep))


def indexes(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> list[ItemIndex]:
    """Item indexes of bounded size; items without text are left out."""
    items = benchmark.select(
        F.col("item_id").cast("bigint"), F.col("text").cast("string")
    ).where("text is not null")
    blocks = -(-items.count() // block_items)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    out = []
    for b in range(blocks):
        rows = [(r[0] if r[0] is not None else -1, r[1]) for r in items.where(part == b).collect()]
        if rows:
            out.append(ItemIndex(rows))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each document with each benchmark item it repeats: doc_id, item_id, place, similarity.

    Words are runs of letters and digits, in lower case. ``first_word`` counts the document's
    words from 0. One row per document and item that are similar at some place, with the most
    similar place (the first of equals); a place has as many words as the item.
    docs needs ``doc_id`` and ``text``, benchmark ``item_id`` and ``text``; other columns are
    ignored. Null and empty texts match nothing; an item of fewer than five words matches as a
    whole. An empty table on either side gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = None
    for index in indexes(benchmark):
        hits = map_batches(texts, partial(_hits, index=index), HITS)
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], HITS)
    best = F.max_by(
        F.struct("first_word", "n_words", "similarity"),
        F.struct("similarity", (-F.col("first_word")).alias("w")),
    ).alias("hit")
    return (
        found.groupBy("doc_id", F.col("item").alias("item_id")).agg(best)
        .select("doc_id", "item_id", "hit.*")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that repeat no benchmark item, with all their columns, row by row.

    Null and empty texts and items repeat nothing; a place as similar as the threshold counts. Long texts
    are looked at whole, repeated rows stay or go together. Without items all documents stay; an
    empty table gives no rows.
    """
    text = "__text"
    while text in docs.columns:
        text += "_"
    out = docs.withColumn(text, F.col("text").cast("string"))
    for index in indexes(benchmark):
        out = map_batches(out, partial(_clean, index=index, column=text), out.schema)
    return out.drop(text)
