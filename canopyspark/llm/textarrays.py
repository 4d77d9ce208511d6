"""Arrow text columns as flat numpy arrays: words, word hashes and shingles of many documents at once.

A batch is cut into pieces of about PIECE bytes, so the arrays of a worker stay small whatever the batch holds; a longer text is a
piece of its own and costs memory in proportion to its length. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Space and \x09-\x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Any ASCII character other than a letter or digit.
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[ord("A") : ord("Z") + 1] += 32
_powers: list[np.ndarray] = []


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batch, each with the bytes of its texts and the offsets of them."""
    column = batch.column(batch.schema.get_field_index(text))
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at), every[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; all else as it is."""
    return _UPPER[data]


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of words: the last is how many each text has."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    inside = ~separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = offsets[:-1], offsets[1:]
    full = begins < ends
    first[begins[full]] = inside[begins[full]]
    last[ends[full] - 1] = inside[ends[full] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        ones = np.ones(size, np.uint64)
        up, down = ones * _BASE, ones * _INVERSE
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of the bytes, from differences of one running polynomial."""
    up, down = _power(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=running[1:])
    return mixed((running[end] - running[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(word_hash: np.ndarray, per_text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words and the text each is in; a text of 1 to n - 1 words gives one, of them all."""
    text = np.repeat(np.arange(len(per_text)), per_text)
    count = len(word_hash)
    where = np.flatnonzero(text[: count - n + 1] == text[n - 1 :]) if count >= n else np.zeros(0, np.int64)
    total = np.zeros(len(where), np.uint64)
    for k in range(n):
        total = total * _BASE + word_hash[where + k]
    short = np.flatnonzero((per_text > 0) & (per_text < n))
    if len(short):
        begins = np.cumsum(per_text) - per_text
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = per_text[short] > k
            whole[has] = whole[has] * _BASE + word_hash[begins[short[has]] + k]
        whole += per_text[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        total, where = np.concatenate([total, whole]), np.concatenate([text[where], short])
    else:
        where = text[where]
    return mixed(total), where


def distinct(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values within each text, sorted by text and value."""
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    if not len(value):
        return value, text
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], text[new]
