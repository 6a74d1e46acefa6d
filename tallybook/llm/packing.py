"""Packing of tokenised documents by shortest-pack-first over the length histogram."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm import textkit
from tallybook.llm.scratch import keep, map_batches

SEQUENCE = 4096
END_ID = 2
_STORE_WORDS = 1_000_000  # words whose ids a task remembers before it starts anew
_BLOCK = 4 << 20  # bytes of text whose words are looked up together

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


_LOWER = textkit.lower_bytes()
_COMPARED = 1 << 19  # bytes compared at once


def unequal(
    a: np.ndarray,
    a_at: np.ndarray,
    a_size: np.ndarray,
    b: np.ndarray,
    b_at: np.ndarray,
    b_size: np.ndarray,
) -> np.ndarray:
    """Whether byte spans differ, pair by pair; none is empty."""
    out = a_size != b_size
    same = np.flatnonzero(~out)
    reach = np.cumsum(a_size[same])
    low = 0
    while low < len(same):
        behind = reach[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(reach, behind + _COMPARED, side="right")))
        pick = same[low:high]
        size = a_size[pick]
        begin = np.cumsum(size) - size
        within = np.arange(begin[-1] + size[-1])
        left = a[np.repeat(a_at[pick] - begin, size) + within]
        right = b[np.repeat(b_at[pick] - begin, size) + within]
        out[pick] = np.logical_or.reduceat(left != right, begin)
        low = high
    return out


class WordIds:
    """Token ids of words, remembered as arrays.

    The tokenizer drops white space and never merges across it, nor from a letter to a
    following mark, so a text's ids are those of its words in order. Each distinct word is
    encoded once by the tokenizer. Words are looked up by a 64-bit hash with ASCII case
    folded, as the vocabulary is lower case, and their bytes are compared with those of the word that
    is remembered; a text with a word that only shares a hash goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = np.full(256, 3, dtype=np.uint8)  # 0 space, 1 letter, 2 mark, 3 other
        kind[:128][~textkit.is_alnum_byte()[:128]] = 2
        kind[ord("'")] = 3
        kind[:32] = 3
        kind[65:91] = kind[97:123] = 1
        kind[~textkit.is_word_byte()] = 0
        self.kind = kind
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.text = np.zeros(0, np.uint8)
        self.text_at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _words(self, data, offsets):
        kind = self.kind[data]
        begin = kind > 0
        begin[1:] &= (kind[:-1] == 0) | (kind[:-1] == 1) & (kind[1:] == 2)
        cuts = offsets[:-1]
        cuts = cuts[cuts < len(data)]
        begin[cuts] = kind[cuts] > 0
        starts = np.flatnonzero(begin)
        last = kind > 0
        last[:-1] &= (kind[1:] == 0) | begin[1:]
        ends = np.flatnonzero(last) + 1
        values = textkit._BYTE_VALUES[textkit.lower_bytes()]
        hashes = textkit.span_hashes(textkit.prefix_hashes(data, values), starts, ends)
        return hashes, starts, ends, np.searchsorted(starts, offsets)

    def _learn(self, hashes: np.ndarray, words: list[str], folded: list[np.ndarray]) -> None:
        """Encode new words, in blocks joined by spaces; ids go to words by their offsets."""
        counts, found = [], []
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in part])])
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begin = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded))
            owner = np.searchsorted(starts, begin, side="right") - 1
            counts.append(np.bincount(owner, minlength=len(part)))
            found.append(np.array(encoded.ids, dtype="<u4"))
        count = np.concatenate(counts).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(count)])[:-1] + len(self.ids)
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known = known[order]
        self.at = np.concatenate([self.at, at])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, *found])
        size = np.fromiter(map(len, folded), np.int64, len(folded))
        text_at = np.concatenate([[0], np.cumsum(size)])[:-1] + len(self.text)
        self.text = np.concatenate([self.text, *folded])
        self.text_at = np.concatenate([self.text_at, text_at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Row index and ids of each text; a null text has none."""
        for low, high, data, offsets in textkit.chunks(column, _BLOCK):
            parts = []
            for a, b, piece, inner in textkit.chunks(column.slice(low, high - low)):
                parts.append((self._words(piece, inner), int(offsets[a])))
            hashes = np.concatenate([w[0] for w, _ in parts])
            starts = np.concatenate([w[1] + shift for w, shift in parts])
            ends = np.concatenate([w[2] + shift for w, shift in parts])
            base = np.cumsum([0] + [len(w[0]) for w, _ in parts])
            first = np.concatenate(
                [w[3][:-1] + n for (w, _), n in zip(parts, base[:-1], strict=True)] + [base[-1:]]
            )
            unique, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) + len(unique) > _STORE_WORDS:
                self.forget()
            folded, size = _LOWER[data], ends - starts
            clash = unequal(folded, starts, size, folded, starts[sample][inverse], size[sample][inverse])
            if len(unique):
                slot = np.searchsorted(self.known, unique)
                slot[slot == len(self.known)] = 0
                new = (
                    self.known[slot] != unique if len(self.known) else np.ones(len(unique), bool)
                )
                old, was = sample[~new], slot[~new]
                other = np.zeros(len(unique), bool)
                other[~new] = unequal(
                    folded, starts[old], size[old], self.text, self.text_at[was], self.size[was]
                )
                clash |= other[inverse]
                if new.any():
                    raw = data.tobytes()
                    spans = list(zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True))
                    self._learn(
                        unique[new],
                        [raw[s:e].decode() for s, e in spans],
                        [folded[s:e] for s, e in spans],
                    )
                    slot = np.searchsorted(self.known, unique)
                at, count = self.at[slot][inverse], self.count[slot][inverse]
            else:
                at = count = np.zeros(0, np.int64)
            total = np.concatenate([[0], np.cumsum(count)])
            flat = self.ids[np.repeat(at - total[:-1], count) + np.arange(total[-1])]
            special = self._special_rows(column.slice(low, high - low))
            special.update((np.searchsorted(first, np.flatnonzero(clash), side="right") - 1).tolist())
            for row in range(high - low):
                if row in special:
                    text = column[low + row].as_py()
                    ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                    yield low + row, np.array(ids, dtype="<u4")
                else:
                    yield low + row, flat[total[first[row]] : total[first[row + 1]]]

    def _special_rows(self, column: pa.Array) -> set[int]:
        """Rows that hold a special token's text; those go to the tokenizer whole."""
        rows: set[int] = set()
        for token in self.special:
            mask = pc.fill_null(pc.match_substring(column, token, ignore_case=True), False)
            rows.update(np.flatnonzero(mask.to_numpy(zero_copy_only=False)).tolist())
        return rows


def _cut(batches, path: str, size: int, end_id: int):
    """Pieces of each document: full sequences, then what is left."""
    words = WordIds(path)
    tail = np.array([end_id], dtype="<u4")
    for batch in batches:
        text = batch.column("text")
        rows: dict[str, list[int]] = {
            k: [] for k in ("row", "start", "length", "ids_crc32", "doc_tokens")
        }
        for row, ids in words.encode(text):
            ids = np.concatenate([ids, tail])
            for start in range(0, len(ids), size):
                piece = ids[start : start + size]
                rows["row"].append(row)
                rows["start"].append(start)
                rows["length"].append(len(piece))
                rows["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                rows["doc_tokens"].append(len(ids))
        doc_ids = batch.column("doc_id").take(pa.array(rows.pop("row"), pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [doc_ids, *(pa.array(v, pa.int64()) for v in rows.values())], ["doc_id", *rows]
        )


def shortest_pack_first(counts: dict[int, int], size: int = SEQUENCE) -> np.ndarray:
    """Packing patterns over a length histogram.

    Lengths are placed longest first; each goes on the pack with the most room that is left
    (the shortest pack), for as many packs of that pattern as there are, and opens new packs
    where none has room. Returns slots ``(length, first rank, count, first sequence,
    offset)``: the ``count`` pieces of that length from that rank on lie at that offset of
    consecutive sequences. The number of live patterns is at most twice that of lengths, so
    the result is bounded by the sequence size, not by the corpus.
    """
    room: dict[int, list[tuple[int, tuple]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = max((r for r, packs in room.items() if packs and r >= length), default=None)
            if space is None:
                room.setdefault(size - length, []).append((left, (length,)))
                break
            have, pattern = room[space].pop()
            if not room[space]:
                del room[space]
            taken = min(have, left)
            if have > taken:
                room.setdefault(space, []).append((have - taken, pattern))
            room.setdefault(space - length, []).append((taken, (*pattern, length)))
            left -= taken
    slots, rank, sequence = [], dict.fromkeys(counts, 0), 0
    for space in sorted(room):
        for count, pattern in room[space]:
            offset = 0
            for length in pattern:
                slots.append((length, rank[length], count, sequence, offset))
                rank[length] += count
                offset += length
            sequence += count
    return np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)


def _place(batches, slots: np.ndarray):
    """Sequence and offset of each piece, from its length and rank."""
    key = slots[:, 0] << 48 | slots[:, 1]
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, length << 48 | rank, side="right") - 1
        kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        sequence = slots[at, 3] + rank - slots[at, 1]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(sequence), pa.array(slots[at, 4])], names
        )


def ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0.

    A length may hold any share of the pieces, so each is dealt into parts by a hash; parts
    are numbered alone, and the counts of the parts before are added.
    """
    spark = pieces.sparkSession
    parts = max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts))
    )
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = counts.select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
    )
    own = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    numbered = dealt.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(
        counts,
        (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part")),
    ).withColumn("rank", F.col("before") + F.col("own"))


def pack(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    docs needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text is
    the end id alone. Documents longer than a sequence are cut into full sequences and a
    rest. Rows with equal ids, also null ones, are packed one by one. An empty table gives
    no rows. ``tokenizer`` is the path of the vocabulary file on every machine.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    cut = partial(_cut, path=tokenizer, size=size, end_id=end_id)
    pieces = keep(map_batches(texts, cut, PIECES), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = shortest_pack_first(histogram, size)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return map_batches(
        ranked(pieces).select(*columns, "rank"), partial(_place, slots=slots), PACKED
    )
