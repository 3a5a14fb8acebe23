"""Tables of bits over 64-bit hashes, of one size for any input.

A hash whose bit is not set is not among those that made the table; one whose bit is set may
be. So a table may only keep work away, never results, and what is broadcast has a fixed size.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

# Numbers of 64 bits in a table: 8 MB.
PLACES = 20
# Bits of the hashes that are counted in packed runs.
HASH_BITS = 40


def table(hashes: DataFrame) -> np.ndarray:
    """The table of the only column of ``hashes``, a BIGINT. At most 2^20 rows leave Spark."""
    c = F.col(hashes.columns[0])
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    rows = hashes.select(c.alias("h")).select(F.shiftrightunsigned("h", 64 - PLACES).alias("place"), bit.alias("bits"))
    found = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << PLACES, dtype=np.uint64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each of the hashes (uint64) may be among those of the table."""
    place = (hashes >> np.uint64(64 - PLACES)).astype(np.int64)
    return bits[place] >> (hashes & np.uint64(63)) & np.uint64(1) == 1


def packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run: differences and counts, byte by byte, compressed."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = [steps.view(np.uint8).reshape(-1, 8).T.tobytes(), counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Values and counts of a run."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), dtype=np.uint8)
    n = len(raw) // 12
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).reshape(-1)
    return np.cumsum(steps, dtype=np.uint64), np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view(np.uint32).reshape(-1)
