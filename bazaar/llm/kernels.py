"""Numpy kernels on Arrow text columns, used inside Spark tasks.

A chunk of texts is one byte array with offsets; words are spans of it. All
functions work on a whole chunk at a time and never look across texts. Null
texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []

#: Bytes of a word for shingles: ASCII letters and digits, and all of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes that are not white space.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (in place where possible)."""
    x ^= x >> np.uint64(33)
    x *= _MIX1
    x ^= x >> np.uint64(33)
    x *= _MIX2
    x ^= x >> np.uint64(33)
    return x


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column."""
    column = pc.fill_null(column, "")
    if lower:
        column = pc.utf8_lower(column)
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each; one text is never split."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()  # what the batch took goes back before the next one comes


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = table[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _BLOCK + 65536)
        _powers[:] = [
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
            for base in (_BASE, _BASE_INVERSE)
        ]
    return _powers[0], _powers[1]


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's units; equal spans have equal hashes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, low + _BLOCK, "right")))
            high = int(ends[to - 1])
            power, inverse = _power_table(high - low + 1)
            values = units[low:high].astype(np.uint64)
            values += np.uint64(1)
            values *= _MIX2
            values ^= values >> np.uint64(29)
            values *= power[: high - low]
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(values, out=total[1:])
            first = starts[at:to] - low
            out[at:to] = mix((total[ends[at:to] - low] - total[first]) * inverse[first])
            at = to
    return out


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words (also over the ends of texts)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    out = words[:m].copy()
    with np.errstate(over="ignore"):
        for i in range(1, n):
            out *= _BASE
            out += words[i : i + m]
        return mix(out)


def inside_text(first: np.ndarray, n: int, count: int) -> np.ndarray:
    """Which of ``count`` starts of n words lie wholly in one text."""
    ok = np.zeros(count + 1, np.int32)
    last = np.minimum(np.maximum(first[1:] - n + 1, first[:-1]), count)
    np.add.at(ok, np.minimum(first[:-1], count), 1)
    np.add.at(ok, last, -1)
    return np.cumsum(ok[:-1]) > 0


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(column: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every n-word shingle of lower-cased texts, words' hashes and their bounds.

    A text with fewer than n words, but one at least, has one shingle of all of them.
    """
    data, offsets = text_bytes(column, lower=True)
    starts, ends, first = spans(data, offsets, WORD)
    words = span_hashes(data, starts, ends)
    every = grams(words, n)
    whole = inside_text(first, n, len(every))
    texts, hashes = owner(first)[: len(every)][whole], every[whole]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = [grams(words[first[i] : first[i + 1]], counts[i])[0] for i in short]
        texts, hashes = np.concatenate([texts, short]), np.concatenate([hashes, np.array(extra, np.uint64)])
    return texts, hashes, words, first
