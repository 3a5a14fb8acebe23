"""Where windows of consecutive items repeat: runs, their anchors, and what they share.

Items are words or bytes of whole texts. Every window of ``window`` items has an anchor:
its seed (a run of ``seed`` items) with the least hash, the leftmost of equal ones. Equal
windows have equal anchors at equal offsets, so only windows under a repeated anchor can
repeat. Consecutive windows with one anchor form a run, the unit of all joins here: about
one run for each half window, told by the hash of its whole content.

* A run whose content occurs twice repeats with all its windows.
* An anchor under which contents differ may still share some windows; only these runs
  (``mixed``) are looked at window by window, one occurrence of each content.

Anchors only bring runs together, so any hash does. Contents are told apart by anchor and
64 bits of keyed BLAKE2 together, under a key that is drawn for each call.

Rows are keyed by ``d`` (the document's key), ``tag`` (0, or the number that tells the
texts of a repeated or null key apart) and ``place``: the run's start and length packed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.llm.common import map_batches, written
from tallyweave.llm.hashing import Words, chained, digests, eights, mix, new_key, text_bytes, wide_digests, window_starts

# Windows that are looked at in one go, so that a very long text needs no more memory.
PIECE = 1 << 20
_PLACE = (1 << 24) - 1
NO_KEY = -(1 << 63)
BATCH = 700_000
# Bits of a run's length; a text has under 2^31 bytes, so start and length share 62 bits.
_LENGTH = 31
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


@dataclass(frozen=True)
class Unit:
    """What counts as an item, and the sizes of windows and of the seeds in them."""

    words: bool
    window: int
    seed: int
    key: int = field(default_factory=new_key)

    def items(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All items of a batch (hashes of words, or bytes), and their offsets by text."""
        if self.words:
            words = Words(column)
            return words.hashes(self.key), words.at
        return text_bytes(column)

    def seeds(self, items: np.ndarray) -> np.ndarray:
        """Hash of the ``seed`` items from each place that has as many behind it."""
        n = max(len(items) - self.seed + 1, 0)
        if self.words:
            return chained(items, np.arange(n), self.seed)
        wide = eights(items)
        if self.seed < 8:
            return mix(wide[:n] & np.uint64((1 << 8 * self.seed) - 1))
        at = [*range(0, self.seed - 7, 8), self.seed - 8]
        total = np.zeros(n, dtype=np.uint64)
        for k, offset in enumerate(at):
            total += wide[offset : offset + n] * _FACTORS[k % 64]
        return mix(total)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, by minima from both ends of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs(items: np.ndarray, at: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start in it, length (in windows) and anchor of every run."""
    starts, _ = window_starts(at, unit.window)
    parts = []
    for low in range(0, len(starts), PIECE):
        here = starts[low : low + PIECE]
        first, last = int(here[0]), int(here[-1]) + unit.window
        seeds = unit.seeds(items[first:last])
        place = np.arange(len(seeds), dtype=np.uint64)
        keys = (seeds & np.uint64(~_PLACE & (1 << 64) - 1)) | (place & np.uint64(_PLACE))
        least = _least(keys, unit.window - unit.seed + 1)[here - first]
        where = (least & np.uint64(_PLACE)).astype(np.int64)
        # Short texts between the starts may carry places beyond the mask.
        where += (here - first) & ~_PLACE
        where += np.where(where < here - first, _PLACE + 1, 0)
        new = np.ones(len(here), dtype=bool)
        new[1:] = (where[1:] != where[:-1]) | (here[1:] != here[:-1] + 1)
        cut = np.flatnonzero(new)
        parts.append((here[cut], np.diff(np.append(cut, len(here))), seeds[where[cut]]))
    if not parts:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    start, length, anchor = (np.concatenate(x) for x in zip(*parts))
    text = np.searchsorted(at, start, side="right") - 1
    return text, start - at[text], length, anchor.view(np.int64)


def window_hashes(items: np.ndarray, starts: np.ndarray, unit: Unit) -> list[bytes]:
    """128 bits of keyed BLAKE2 of the windows from each start."""
    return wide_digests(items, starts, starts + unit.window, unit.key)


def pack(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << _LENGTH) | length.astype(np.int64)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length."""
    return place >> _LENGTH, place & ((1 << _LENGTH) - 1)


def start_of(place: Column | str) -> Column:
    return F.shiftright(place, _LENGTH)


def length_of(place: Column | str) -> Column:
    return (F.col(place) if isinstance(place, str) else place).bitwiseAND((1 << _LENGTH) - 1)


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows ``(d, tag, text)``; rows with a null key share one ``d``.

    ``tag`` is 0 where a key has one row. The texts of a repeated or null key are numbered
    from 1, equal texts alike; two 64-bit hashes tell them apart, and the numbers are
    written, so that every later reading finds the same. Few keys repeat in most tables,
    so the join that brings the numbers in is one that Spark broadcasts there.
    """
    rows = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_KEY)).alias("d"), F.col(text).alias("text"))
    again = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).filter(f"n > 1 OR d = {NO_KEY}").select("d")
    hashes = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")}
    several = rows.withColumns(hashes).drop("text").join(written(again), "d").distinct()
    numbers = written(several.withColumn("tag", F.monotonically_increasing_id() + 1))
    if numbers.isEmpty():
        return rows.select("d", F.lit(0).cast("bigint").alias("tag"), "text")
    named = rows.withColumns(hashes).join(numbers, ["d", "h1", "h2"], "left")
    return named.select("d", F.coalesce("tag", F.lit(0)).alias("tag"), "text")


def run_rows(source: DataFrame, unit: Unit) -> DataFrame:
    """Rows ``(anchor, content, d, tag, place)`` of all runs of ``(d, tag, text)`` rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, at = unit.items(batch.column("text"))
        text, start, length, anchor = runs(items, at, unit)
        first = at[text] + start
        content = digests(items, first, first + length + unit.window - 1, unit.key)
        d, tag = (batch.column(c).to_numpy(zero_copy_only=False)[text] for c in ("d", "tag"))
        columns = [pa.array(x, pa.int64()) for x in (anchor, content, d, tag, pack(start, length))]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "d", "tag", "place"])

    return map_batches(source, "anchor BIGINT, content BIGINT, d BIGINT, tag BIGINT, place BIGINT", run, BATCH)


def anchor_rows(source: DataFrame, unit: Unit) -> DataFrame:
    """Rows ``(anchor, n)``: how many runs of some texts have an anchor."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, at = unit.items(batch.column("text"))
        found, n = np.unique(runs(items, at, unit)[3], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["anchor", "n"])

    return map_batches(source.select("text"), "anchor BIGINT, n BIGINT", run, BATCH)


def repeated_runs(source: DataFrame, unit: Unit) -> tuple[DataFrame, DataFrame]:
    """``(occurrences, contents)`` of runs under repeated anchors, both written.

    Occurrences are ``(anchor, content, d, tag, place)``; contents have one row each with
    ``n`` occurrences and the first one's place. Anchors are counted with a map-side step,
    and the join that follows can split a frequent anchor's rows.
    """
    often = anchor_rows(source, unit).groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    occurrences = written(run_rows(source, unit).join(often, "anchor"))
    contents = occurrences.groupBy("anchor", "content").agg(F.min(F.struct("d", "tag", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    return occurrences, written(contents.select("anchor", "content", "n", "first.*"))


def packed_texts(source: DataFrame) -> DataFrame:
    """Rows ``(d, tag, blob)``: texts compressed for the way through a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        data, at = text_bytes(batch.column("text"))
        raw = data.tobytes()
        blobs = [squeeze(raw[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays([batch.column("d"), batch.column("tag"), pa.array(blobs, pa.binary())], names=["d", "tag", "blob"])

    return map_batches(source, "d BIGINT, tag BIGINT, blob BINARY", run, BATCH)


def unpacked(column: pa.Array) -> list[bytes]:
    spread = zstandard.ZstdDecompressor().decompress
    return [spread(b) for b in column.to_pylist()]


def with_texts(source: DataFrame, needed: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(d, tag, blob, runs)``: the runs ``(columns)`` of ``needed`` beside their text."""
    by_text = needed.groupBy("d", "tag").agg(F.collect_list(F.struct(*columns)).alias("runs"))
    # Repeated rows have equal texts; one is enough.
    return packed_texts(source).join(by_text, ["d", "tag"]).groupBy("d", "tag").agg(F.first("blob").alias("blob"), F.first("runs").alias("runs"))


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``length`` items lie in any span."""
    edges = np.zeros(length + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges[:-1]) > 0
