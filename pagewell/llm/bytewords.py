"""Word hashes of many texts at once, in numpy over their joined bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_SHORT = 32
# Text worked on at once; bounds the memory of a task.
SLICE_BYTES = 4 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit integers (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column as one array, and the offsets of its rows.
    A null has no bytes."""
    array = column.cast(pa.large_string())
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if array.null_count:
        lengths = np.where(np.asarray(array.is_valid()), np.diff(offsets), 0)
        kept = [data[s:s + n] for s, n in zip(offsets[:-1], lengths)]
        return np.concatenate(kept) if kept else data[:0], np.concatenate([[0], np.cumsum(lengths)])
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def ascii_lowered(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32))


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of all words. A word is a longest run of bytes with
    ``is_word``; runs end with their row."""
    n = len(data)
    inside = is_word[data]
    starts_row = np.zeros(n + 1, bool)
    starts_row[offsets[:-1]] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | starts_row[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | starts_row[1:n]
    return np.flatnonzero(begin), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and for each row where its words begin
    among them (see ``word_bounds``).

    The hash of a word is a polynomial of its bytes modulo 2**64, taken as a
    difference of running sums, then mixed with its length.
    """
    first, last = word_bounds(data, offsets, is_word)
    size = last - first
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes = np.zeros(len(first), np.uint64)
    for k in np.flatnonzero(size > _SHORT):
        hashes[k] = _polynomial(data[first[k]:last[k]])
    # Byte by byte, of all short words that have such a byte.
    order = np.argsort(-np.minimum(size, _SHORT + 1), kind="stable")
    order = order[np.searchsorted(-size[order], -_SHORT):]
    live, at = first[order], size[order]
    acc = np.zeros(len(order), np.uint64)
    for k, m in enumerate(np.searchsorted(-at, -np.arange(1, _SHORT + 1), side="right")):
        if not m:
            break
        acc[:m] = acc[:m] * _P + data[live[:m] + k] + np.uint64(1)
    hashes[order] = acc
    return mix64(hashes + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(first, offsets)


def _polynomial(word: np.ndarray) -> np.uint64:
    powers = np.full(len(word), _P, np.uint64)
    powers[-1] = 1
    powers = np.multiply.accumulate(powers[::-1])[::-1]
    return ((word.astype(np.uint64) + np.uint64(1)) * powers).sum(dtype=np.uint64)


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes each, or one longer row."""
    out, start, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            out.append((start, i))
            start, total = i, 0
        total += n
    if len(lengths):
        out.append((start, len(lengths)))
    return out
