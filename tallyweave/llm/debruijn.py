"""Substring dedup on a compacted de Bruijn graph of token windows.

Edges are windows of ``WINDOW`` words. Windows under one anchor are compacted where they
are read (a run); repeated runs that always follow each other are compacted further by
joins and one pass in the order of their first document, giving nonbranching paths. The
occurrences of a path are spans of the documents; source coordinates verify that a span
is unbroken and tell the first occurrence from later ones, which are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyweave.llm import repeats
from tallyweave.llm.common import map_batches, written
from tallyweave.llm.hashing import Words

WINDOW, SEED = 20, 6


def paths(contents: DataFrame) -> DataFrame:
    """Rows ``(anchor, content, path, offset)``: nonbranching paths of repeated runs.

    Along such a path all runs occur equally often and, in the first document that has
    them, one right after the other. ``path`` is the first run's anchor and content, ``offset``
    the windows before a run. One document's runs are read in order, never one content's
    occurrences. A link is a proposal; spans are verified by their coordinates.
    """
    repeated = contents.filter("n > 1").select("anchor", "content", "n", "d", "tag", *_place())
    after = repeated.select("d", "tag", (F.col("start") + F.col("length")).alias("start"), F.col("n").alias("n_before"))
    linked = repeated.join(after, ["d", "tag", "start"], "left").withColumn("head", F.coalesce(F.col("n_before") != F.col("n"), F.lit(True)))
    order = Window.partitionBy("d", "tag").orderBy("start")
    island = F.max(F.when(F.col("head"), F.struct("start", "anchor", "content"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    named = linked.withColumn("island", island)
    path = F.struct("island.anchor", "island.content").alias("path")
    return named.select("anchor", "content", path, (F.col("start") - F.col("island.start")).alias("offset"))


def _place() -> list:
    return [repeats.start_of("place").alias("start"), repeats.length_of("place").alias("length")]


def repeated_spans(occurrences: DataFrame, contents: DataFrame) -> DataFrame:
    """Rows ``(d, tag, path, start, length)``: later occurrences of paths, in windows.

    Runs of one path at one alignment of one document make a span where their coordinates
    leave no gap, and stay single where they do.
    """
    first = contents.filter("n > 1").select("anchor", "content", *[F.col(c).alias(f"{c}0") for c in ("d", "tag", "place")])
    known = written(first.join(paths(contents), ["anchor", "content"]))
    later = occurrences.join(known, ["anchor", "content"]).filter("d <> d0 OR tag <> tag0 OR place <> place0")
    placed = later.select("d", "tag", "path", "offset", *_place()).distinct()
    spans = placed.groupBy("d", "tag", "path", (F.col("start") - F.col("offset")).alias("shift")).agg(
        F.min("start").alias("low"),
        F.max(F.col("start") + F.col("length")).alias("high"),
        F.sum("length").alias("windows"),
        F.collect_list(F.struct("start", "length")).alias("runs"),
    )
    whole = F.array(F.struct(F.col("low").alias("start"), (F.col("high") - F.col("low")).alias("length")))
    cut = F.when(F.col("windows") == F.col("high") - F.col("low"), whole).otherwise(F.col("runs"))
    return spans.select("d", "tag", "path", F.inline(cut))


def repeated_windows(source: DataFrame, contents: DataFrame, unit: repeats.Unit) -> DataFrame:
    """Rows ``(d, tag, start, length)``: single windows that start earlier elsewhere, in the
    first occurrences of runs whose anchor also has other contents."""
    mixed = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("anchor")
    needed = contents.join(mixed, "anchor").select("d", "tag", "place")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, at = unit.items(pa.array([b.decode() for b in repeats.unpacked(batch.column("blob"))], pa.string()))
        hashes: list[bytes] = []
        rows, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, found in enumerate(batch.column("runs").to_pylist()):
            start, length = repeats.unpack(np.array([r["place"] for r in found], dtype=np.int64))
            place = np.repeat(start, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            hashes += repeats.window_hashes(items, at[i] + place, unit)
            rows.append(np.full(len(place), i))
            places.append(place)
        of, place = np.concatenate(rows), np.concatenate(places)
        d, tag = (batch.column(c).to_numpy(zero_copy_only=False)[of] for c in ("d", "tag"))
        columns = [pa.array(hashes, pa.binary()), *(pa.array(x, pa.int64()) for x in (d, tag, place))]
        return pa.RecordBatch.from_arrays(columns, names=["hash", "d", "tag", "start"])

    schema = "hash BINARY, d BIGINT, tag BIGINT, start BIGINT"
    windows = written(map_batches(repeats.with_texts(source, needed, ["place"]), schema, run, repeats.BATCH))
    first = windows.groupBy("hash").agg(F.min(F.struct("d", "tag", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = windows.join(first, "hash").filter("d <> first.d OR tag <> first.tag OR start <> first.start")
    return later.select("d", "tag", "start", F.lit(1).cast("bigint").alias("length"))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per row of ``df``: ``(key, n_words, n_removed, kept)``.

    Removes every word covered by a window of ``window`` words whose sequence also starts
    earlier: in a document with a smaller key, or before in the same one. ``kept`` holds
    the other words, joined by one blank. Words are what blanks and the control characters
    9 to 13 separate. Null texts have no words. A null key comes first. Rows with equal key
    and text are one document; equal keys with different texts go in an order of their own.
    """
    unit = repeats.Unit(True, window, seed)
    source = repeats.keyed(df, key, text)
    occurrences, contents = repeats.repeated_runs(source, unit)
    spans = repeated_spans(occurrences, contents).select("d", "tag", "start", "length")
    gone = spans.union(repeated_windows(source, contents, unit))
    by_text = gone.groupBy("d", "tag").agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    joined = repeats.packed_texts(source).join(by_text, ["d", "tag"], "left").drop("tag")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(pa.array([b.decode() for b in repeats.unpacked(batch.column("blob"))], pa.string()))
        starts, lengths = batch.column("starts").to_pylist(), batch.column("lengths").to_pylist()
        total, removed, kept = [], [], []
        raw = words.data.tobytes()
        for a, b, start, length in zip(words.at.tolist(), words.at[1:].tolist(), starts, lengths):
            keep = np.ones(b - a, dtype=bool)
            if start:
                low = np.array(start)
                keep = ~repeats.covered(b - a, low, low + np.array(length) + window - 1)
            at = np.flatnonzero(keep) + a
            total.append(b - a)
            removed.append(b - a - len(at))
            kept.append(b" ".join([raw[x:y] for x, y in zip(words.start[at].tolist(), words.end[at].tolist())]).decode())
        columns = [batch.column("d"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["d", "n_words", "n_removed", "kept"])

    out = map_batches(joined, "d BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING", run, repeats.BATCH)
    return out.select(F.nullif("d", F.lit(repeats.NO_KEY)).alias(key), "n_words", "n_removed", "kept")
