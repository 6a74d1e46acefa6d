"""Vectorised text work on Arrow columns, for tasks that run in Python.

Texts are handled as one UTF-8 byte array with row offsets; a null text is empty. Words
are runs of bytes of the given class, so every function costs a few passes over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21  # bytes of text worked on at a time
_SPACE = b" \t\n\x0b\x0c\r"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def is_word_byte() -> np.ndarray:
    """True for every byte but ASCII white space."""
    table = np.ones(256, dtype=bool)
    table[list(_SPACE)] = False
    return table


def is_alnum_byte() -> np.ndarray:
    """True for ASCII letters and digits, and for all bytes of other scripts."""
    table = np.zeros(256, dtype=bool)
    table[128:] = True
    for low, high in ("09", "AZ", "az"):
        table[ord(low) : ord(high) + 1] = True
    return table


def lower_bytes() -> np.ndarray:
    """Byte map that lowers ASCII letters."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and the row offsets into them."""
    if pa.types.is_binary(column.type):
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
    else:
        column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    column: pa.Array, size: int = CHUNK
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` bytes (or one longer row): first, last + 1, bytes, offsets."""
    if len(column) == 0:
        return
    data, offsets = buffer_of(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each row the index of its first word (one more at the end)."""
    inside = table[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offsets[:-1]
    cuts = cuts[cuts < len(data)]
    begin[cuts] = inside[cuts]
    end = inside.copy()
    end[:-1] &= ~begin[1:] & inside[:-1] & ~inside[1:] | begin[1:] & inside[:-1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x1000003)
    return mix(steps * _BASE)


_BYTE_VALUES = numbers(256, 7)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, 0 to n."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, CHUNK + 1)
        base = int(_BASE) | 1
        for name, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            step = np.full(size, b, dtype=np.uint64)
            step[0] = 1
            _POWERS[name] = np.cumprod(step, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def prefix_hashes(data: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Prefix sums of a polynomial hash; element i covers the first i bytes."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    table = _BYTE_VALUES if values is None else values
    np.cumsum(table[data] * up[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans; equal spans have equal hashes wherever they stand."""
    _, down = _powers(len(prefix) - 1)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and each row's first word."""
    starts, ends, first = word_spans(data, offsets, table)
    values = _BYTE_VALUES[lower_bytes()] if lower else _BYTE_VALUES
    return span_hashes(prefix_hashes(data, values), starts, ends), starts, ends, first


def shingles(
    words: np.ndarray, first: np.ndarray, k: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of a row, and each row's first shingle.

    A row with some words but fewer than k has one shingle, of all its words.
    """
    count = np.diff(first)
    per_row = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(count)), per_row)
    start = first[:-1][row] + (np.arange(at[-1]) - at[:-1][row])
    stop = first[1:][row]
    total = np.zeros(at[-1], dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for j, factor in enumerate(numbers(k, 1000 + seed) | np.uint64(1)):
        part = mix(padded[start + j] + factor) * factor
        total += part if k == 1 else np.where(start + j < stop, part, factor)
    return mix(total), at
