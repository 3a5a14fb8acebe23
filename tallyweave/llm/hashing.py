"""Hashes of words and of runs of words or bytes, over whole batches of texts at once.

No hash here is a polynomial: a word goes through ``mix`` eight bytes at a time, so words
of one length of up to eight bytes never collide, and long words and whole runs go through
keyed BLAKE2. ``key`` is drawn anew for each query (``new_key``), so no text can be made
to collide; 64-bit hashes of different words then agree by chance alone.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
# Bytes of a word beyond which BLAKE2 hashes it.
LONG = 256

# Fixed value: bytes that separate words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def new_key() -> int:
    return secrets.randbits(63)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64; different inputs stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Masks of the first bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a number, zeros behind the end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """Hash of the bytes from each ``start`` to ``end``."""
    wide = eights(data)
    left = end - start
    out = mix(left.astype(np.uint64) * _ODD + np.uint64(key))
    long = np.flatnonzero(left > LONG)
    at = start + 0
    open_ = np.arange(len(start))
    if len(long):
        open_ = np.flatnonzero(left <= LONG)
    open_ = open_[left[open_] > 0]
    while len(open_):
        part = wide[at[open_]] & _FIRST[np.minimum(left[open_], 8)]
        out[open_] = mix(out[open_] ^ part)
        at[open_] += 8
        left[open_] -= 8
        open_ = open_[left[open_] > 0]
    if len(long):
        out[long] = digests(data, start[long], end[long], key).view(np.uint64)
    return out


def digests(items: np.ndarray, start: Iterable[int], end: Iterable[int], key: int = 0) -> np.ndarray:
    """Keyed BLAKE2 of the items from each ``start`` to ``end``, 64 bits."""
    return np.frombuffer(b"".join(_digests(items, start, end, key, 8)), dtype=np.int64)


def wide_digests(items: np.ndarray, start: Iterable[int], end: Iterable[int], key: int = 0) -> list[bytes]:
    """The same with 128 bits, as bytes."""
    return _digests(items, start, end, key, 16)


def _digests(items: np.ndarray, start: Iterable[int], end: Iterable[int], key: int, size: int) -> list[bytes]:
    each = items.dtype.itemsize
    raw = memoryview(np.ascontiguousarray(items)).cast("B")
    fresh = hashlib.blake2b(key=key.to_bytes(8, "little"), digest_size=size).copy
    out = []
    for a, b in zip(np.asarray(start).tolist(), np.asarray(end).tolist()):
        h = fresh()
        h.update(raw[a * each : b * each])
        out.append(h.digest())
    return out


def chained(values: np.ndarray, start: np.ndarray, count: int, left: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``count`` values from each ``start``, in their order; of only ``left`` where
    that is fewer."""
    out = np.full(len(start), _ODD)
    for k in range(count):
        if left is None:
            out = mix(out + values[start + k])
        else:
            more = left > k
            out[more] = mix(out[more] + values[start[more] + k])
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch: where each starts and ends in the bytes, and its hash.

    ``at[i]`` to ``at[i + 1]`` are the words of text ``i``; bytes in ``blanks`` separate them.
    """

    def __init__(self, column: pa.Array, lower: bool = False, blanks: bytes = SPACES) -> None:
        self.data, self.offsets = text_bytes(column)
        n = len(self.data)
        inside = ~(_IS_SPACE if blanks == SPACES else np.isin(np.arange(256), list(blanks)))[self.data]
        breaks = np.ones(n + 1, dtype=bool)
        breaks[1:n] = ~inside[: n - 1] if n else True
        breaks[self.offsets] = True
        self.start = np.flatnonzero(inside & breaks[:n])
        following = breaks[1:].copy()
        following[: n - 1] |= ~inside[1:]
        self.end = np.flatnonzero(inside & following) + 1
        self.at = np.searchsorted(self.start, self.offsets)
        self._lower = lower

    def hashes(self, key: int = 0) -> np.ndarray:
        return spans_hash(_LOWER[self.data] if self._lower else self.data, self.start, self.end, key)

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def values(self) -> pa.Array:
        """The words themselves, one after the other, as binary."""
        data = _LOWER[self.data] if self._lower else self.data
        size = self.end - self.start
        ends = np.concatenate([[0], np.cumsum(size)])
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[self.start] += 1
        inside[self.end] -= 1
        packed = np.ascontiguousarray(data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)])
        return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(packed)])

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words alone, and the word of each number."""
        coded = self.values().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def window_starts(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``size`` items that stay inside one text, and how many each text has."""
    counts = np.maximum(np.diff(at) - size + 1, 0)
    total = int(counts.sum())
    first = np.repeat(at[:-1], counts)
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + place, counts
