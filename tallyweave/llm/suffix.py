"""Exact dedup of repeated byte strings with difference-cover suffix sorting.

Only text under a repeated anchor can repeat (see ``repeats``), and a run that occurs
twice as a whole needs no sorting. What is left, one copy of each content, is dealt by
anchor, so equal strings meet in one task of bounded size. There, suffixes are sorted:
suffixes at places that leave 1 or 2 when divided by 3 (a difference cover) are named by
sorting triples, recursively until names are distinct; the others follow
from their first symbol and the rank of the next place, and are merged in. Neighbours in
that order that share their first ``LENGTH`` bytes are repeats.

Anchors with very many contents, like the edges of a passage that a third of all
documents share, are split further: their strings meet by the hash of each window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyweave.llm import repeats
from tallyweave.llm.common import map_batches, written

LENGTH, SEED = 200, 32
# Contents of one anchor that may meet in one task; bytes of a task on average.
CONTENTS, TASK_BYTES = 3_000, 400_000


def _order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by the keys, the last one first, like ``numpy.lexsort``."""
    order = np.argsort(keys[0], kind="stable")
    for key in keys[1:]:
        order = order[np.argsort(key[order], kind="stable")]
    return order


def _names(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Numbers from 1 in sorted order, equal for equal keys."""
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        inside = key[order]
        new[1:] |= inside[1:] != inside[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes, sorted.

    ``symbols`` are integers from 0 to 2^31; the end counts as less than any of them.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    s = np.zeros(n + 3, dtype=np.int64)
    s[:n] = symbols
    s[:n] += 1
    # Sampled places: 1 and 2 modulo 3. The place n, if sampled, stands for the empty suffix.
    one, two = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)
    sample = np.concatenate([one, two])
    pair = s[sample] << 32 | s[sample + 1]
    third = s[np.minimum(sample + 2, n + 2)]
    order = _order(third, pair)
    names = _names(order, third, pair)
    del pair, third
    if names.max() < len(sample):
        del order
        # The triples of one residue follow each other; a mark keeps both rows apart.
        reduced = np.concatenate([names[: len(one)], [0], names[len(one) :]])
        sorted_reduced = suffix_order(reduced)
        sorted_reduced = sorted_reduced[sorted_reduced != len(one)]
        del reduced
        order = np.where(sorted_reduced > len(one), sorted_reduced - 1, sorted_reduced)
        del sorted_reduced
        names = np.empty(len(sample), dtype=np.int64)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample] = names
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    # The others: first symbol, then the rank of the place after it.
    key = s[rest] << 32 | rank[rest + 1]
    rest = rest[np.argsort(key, kind="stable")]
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before_ones = np.searchsorted(s[ones] << 32 | rank[ones + 1], s[rest] << 32 | rank[rest + 1])
    pairs = np.concatenate([s[twos] << 32 | s[twos + 1], s[rest] << 32 | s[rest + 1]])
    dense = _names(np.argsort(pairs, kind="stable"), pairs)
    before_twos = np.searchsorted(dense[: len(twos)] << 32 | rank[twos + 2], dense[len(twos) :] << 32 | rank[rest + 2])
    at = before_ones + before_twos + np.arange(len(rest))
    out = np.empty(n, dtype=np.int64)
    others = np.ones(n, dtype=bool)
    others[at] = False
    out[at], out[others] = rest, sampled
    return out


def repeated_starts(strings: list[bytes], length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each place of the joined strings are inside one
    string and start at another place too."""
    joined = np.frombuffer(b"".join(strings), dtype=np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    left = np.repeat(ends, [len(s) for s in strings]) - np.arange(len(joined))
    out = np.zeros(len(joined), dtype=bool)
    order = suffix_order(joined)
    order = order[left[order] >= length]
    if len(order) < 2:
        return out
    views = np.lib.stride_tricks.sliding_window_view(joined, length)
    for low in range(0, len(order) - 1, 20_000):
        here = order[low : low + 20_001]
        prefixes = views[here]
        same = (prefixes[1:] == prefixes[:-1]).all(axis=1)
        out[here[1:][same]] = True
        out[here[:-1][same]] = True
    return out


def _strings(source: DataFrame, needed: DataFrame, length: int) -> DataFrame:
    """``needed`` rows ``(anchor, n, d, tag, place)`` with the bytes of their runs."""
    rows = repeats.with_texts(source, needed, ["anchor", "n", "place"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("d", "tag", "runs"))
        for blob, d, tag, found in zip(repeats.unpacked(batch.column("blob")), *columns):
            start, size = repeats.unpack(np.array([r["place"] for r in found], dtype=np.int64))
            for r, a, n in zip(found, start.tolist(), size.tolist()):
                out.append((r["anchor"], r["n"], d, tag, a, blob[a : a + n + length - 1]))
        kinds = (*(pa.int64() for _ in range(5)), pa.binary())
        arrays = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["anchor", "n", "d", "tag", "start", "bytes"])

    return map_batches(rows, "anchor BIGINT, n BIGINT, d BIGINT, tag BIGINT, start BIGINT, bytes BINARY", run, repeats.BATCH)


SPANS = "d BIGINT, tag BIGINT, start BIGINT, length BIGINT"


def _spans(table: pa.Table, row: np.ndarray, offset: np.ndarray) -> pa.Table:
    """Flagged windows (row and offset in its run, both in order) as spans of windows."""
    d, tag, start = (table.column(c).to_numpy()[row] for c in ("d", "tag", "start"))
    place = start + offset
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    cut = np.flatnonzero(new)
    size = np.diff(np.append(cut, len(row)))
    arrays = [pa.array(x.astype(np.int64)) for x in (d[cut], tag[cut], place[cut], size)]
    return pa.Table.from_arrays(arrays, names=["d", "tag", "start", "length"])


def repeated_inside(source: DataFrame, contents: DataFrame, unit: repeats.Unit) -> DataFrame:
    """Rows ``(d, tag, start, length)``: windows of runs that occur once as a whole, but
    whose window occurs under the same anchor in another content."""
    length = unit.window
    groups = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.min("n").alias("least"))
    mixed = groups.filter("contents > 1 AND least = 1").select("anchor", (F.col("contents") > CONTENTS).alias("hot"))
    needed = written(contents.join(mixed, "anchor").select("anchor", "hot", "n", "d", "tag", "place"))
    total = needed.filter("NOT hot").agg(F.sum(repeats.length_of("place") + length)).first()[0] or 0
    tasks = 1 + int(total // TASK_BYTES)

    def sort(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        strings = table.column("bytes").to_pylist()
        flagged = repeated_starts(strings, length)
        sizes = np.array([len(s) for s in strings])
        row = np.repeat(np.arange(len(strings)), sizes)
        offset = np.arange(len(flagged)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        flagged &= table.column("n").to_numpy()[row] == 1
        return _spans(table, row[flagged], offset[flagged])

    usual = _strings(source, needed.filter("NOT hot").drop("hot"), length)
    sorted_ = usual.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(tasks)).alias("task")).applyInArrow(sort, SPANS)

    def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = _bytes_of(batch.column("bytes"))
        counts = np.maximum(np.diff(at) - length + 1, 0)
        row = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = pa.array(repeats.window_hashes(data, at[row] + offset, unit), pa.binary())
        n, d, tag, start = (batch.column(c).to_numpy()[row] for c in ("n", "d", "tag", "start"))
        columns = [hashes, *(pa.array(x) for x in (n, d, tag, start + offset))]
        return pa.RecordBatch.from_arrays(columns, names=["hash", "n", "d", "tag", "start"])

    hot = needed.filter("hot").drop("hot")
    if hot.isEmpty():
        return sorted_
    windows = written(map_batches(_strings(source, hot, length), "hash BINARY, n BIGINT, d BIGINT, tag BIGINT, start BIGINT", explode, repeats.BATCH // 4))
    often = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("hash")
    split = windows.filter("n = 1").join(often, "hash").select("d", "tag", "start", F.lit(1).cast("bigint").alias("length"))
    return sorted_.union(split)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64)


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row of ``df``: ``(key, n_bytes, n_removed, n_spans, kept)``.

    Texts count as UTF-8 bytes. Every byte covered by a string of ``length`` bytes that
    also starts anywhere else, in this or another text, is removed; strings are judged on
    the input. ``n_spans`` counts maximal removed runs, ``kept`` (binary) is the rest. Null
    and empty texts have no bytes. Repeated rows are copies of each other.
    """
    unit = repeats.Unit(False, length, seed)
    source = repeats.keyed(df, key, text)
    occurrences, contents = repeats.repeated_runs(source, unit)
    copies = occurrences.join(contents.filter("n > 1").select("anchor", "content"), ["anchor", "content"])
    whole = copies.select("d", "tag", repeats.start_of("place").alias("start"), repeats.length_of("place").alias("length"))
    gone = whole.union(repeated_inside(source, contents, unit))
    by_text = gone.groupBy("d", "tag").agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    joined = repeats.packed_texts(source).join(by_text, ["d", "tag"], "left").drop("tag")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("starts", "lengths"))
        for blob, starts, lengths in zip(repeats.unpacked(batch.column("blob")), *columns):
            if not starts:
                out.append((len(blob), 0, 0, blob))
                continue
            low = np.array(starts)
            gone = repeats.covered(len(blob), low, low + np.array(lengths) + length - 1)
            kept = np.frombuffer(blob, dtype=np.uint8)[~gone].tobytes()
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((len(blob), int(gone.sum()), spans, kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column("d"), *arrays], names=["d", "n_bytes", "n_removed", "n_spans", "kept"])

    out = map_batches(joined, "d BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY", run, repeats.BATCH)
    return out.select(F.nullif("d", F.lit(repeats.NO_KEY)).alias(key), "n_bytes", "n_removed", "n_spans", "kept")
