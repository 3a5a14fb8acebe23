"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned from a bounded sample (principal components, then iterative
quantisation) turns vectors into binary codes, one bit per component and at most 64. A
code is split into substrings of 8 bits, each with an index of its own. Two codes within a
Hamming radius must be close in at least one substring (pigeonhole), so probing the
buckets near the query's substrings finds every code within the radius; these are
reranked by the distance of the original vectors.

All rows are indexed, in blocks of bounded size; the stated queries meet every block in
groups of bounded size, and only the nearest few of a block leave it. Queries that find
fewer than wanted within the radius are searched again without it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyweave.llm.common import written

# Rows that the rotation and the radius are learned from, on average, taken by hash.
SAMPLE = 4_096
# Sampled queries for the radius, and the share of their neighbours it must reach.
SAMPLE_QUERIES, REACH = 256, 0.975
BITS = 64
SUBSTRING = 8
# Rows of one index block, and queries of one group.
BLOCK, GROUP = 8_192, 2_048
ROUNDS = 30


@dataclass(frozen=True)
class Coder:
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of substrings, one byte each."""
        return np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distance of row pairs, summed component by component in double precision."""
    total = np.zeros(len(queries))
    for a, b in zip(queries.T, vectors.T):
        total += np.square(a - b)
    return np.sqrt(total)


def learn(sample: np.ndarray, k: int) -> Coder:
    """Rotation and radius from sampled vectors (at least one)."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:BITS].T
    projected = centred @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(axes.shape[1], axes.shape[1])))
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = (left @ right).T
    coder = Coder(mean, axes @ turn, axes.shape[1])
    # The sample is thinner than the whole, so its neighbours are farther: the radius errs on the wide side.
    codes = coder.codes(sample)
    far = []
    for i in range(min(SAMPLE_QUERIES, len(sample))):
        apart = np.square(sample - sample[i]).sum(axis=1)
        apart[i] = np.inf
        nearest = np.argsort(apart, kind="stable")[: min(k, len(sample) - 1)]
        far.append(np.bitwise_count(codes[nearest] ^ codes[i]).sum(axis=1))
    radius = int(np.ceil(np.quantile(np.concatenate(far), REACH))) if len(sample) > 1 else coder.bits
    return Coder(mean, coder.rotation, radius)


class Index:
    """One bucket table per substring over a block's codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = [np.argsort(column, kind="stable") for column in codes.T]
        self.first = [np.searchsorted(column[o], np.arange(257)) for column, o in zip(codes.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        if radius >= 8 * len(code):
            return np.arange(len(self.codes))
        near = np.zeros(len(self.codes), dtype=bool)
        # If every substring differed by more than its limit, the sum would exceed the radius.
        spare = radius - len(code) + 1
        for j, value in enumerate(code.tolist()):
            limit = (spare + j) // len(code)
            if limit < 0:
                continue
            order, first = self.order[j], self.first[j]
            for probe in _PROBES[min(limit, 8)]:
                bucket = value ^ probe
                near[order[first[bucket] : first[bucket + 1]]] = True
        rows = np.flatnonzero(near)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


# Values of a substring that differ in at most so many bits.
_PROBES = [[v for v in range(256) if v.bit_count() <= limit] for limit in range(9)]


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows ``(id, v)`` that take part: no null, zero or non-finite vector, nor a null key,
    and of the commonest dimension (the smaller one of equally common ones)."""
    v = F.col(vector).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    good = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & whole).select(
        F.col(key).cast("bigint").alias("id"), v.alias("v")
    )
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else np.empty((0, 1))


def _search(rows: DataFrame, queries: DataFrame, coder: Coder, radius: int, k: int, n_rows: int, n_queries: int) -> DataFrame:
    """Rows ``(query_id, id, score)``: the nearest ``k`` of every block within the radius."""
    blocks, groups = max(1, -(-n_rows // BLOCK)), max(1, -(-n_queries // GROUP))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    placed = rows.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"), every(groups).alias("grp"))
    asked = queries.select("id", "v", every(blocks).alias("block"), F.pmod(F.xxhash64("id", "v"), F.lit(groups)).cast("int").alias("grp"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("id").to_numpy()
        vectors = _matrix(left.column("v"), len(left))
        query_ids = right.column("id").to_numpy()
        asked_vectors = _matrix(right.column("v"), len(right))
        out_query, out_id, out_score = [], [], []
        if len(left) and len(right):
            index = Index(coder.codes(vectors))
            for query, vector, code in zip(query_ids, asked_vectors, coder.codes(asked_vectors)):
                found = index.within(code, radius)
                found = found[ids[found] != query]
                if not len(found):
                    continue
                score = distances(np.broadcast_to(vector, (len(found), len(vector))), vectors[found])
                best = np.lexsort((ids[found], score))[:k]
                out_query.append(np.full(len(best), query))
                out_id.append(ids[found][best])
                out_score.append(score[best])
        columns = [np.concatenate(x) if x else np.empty(0) for x in (out_query, out_id, out_score)]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))]
        return pa.Table.from_arrays(arrays, names=["query_id", "id", "score"])

    met = placed.groupBy("block", "grp").cogroup(asked.groupBy("block", "grp"))
    return met.applyInArrow(cell, "query_id BIGINT, id BIGINT, score DOUBLE")


def nearest(df: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows ``(query_id, rank, key, score)``: the ``k`` nearest rows found for each query.

    ``is_query`` is a condition on ``key``. Candidates are all rows but those with the
    query's own key; score is the Euclidean distance of the original vectors in double
    precision, ties go to the smaller key. Rows with a null key or a null, zero or
    non-finite vector take no part. A query row that is repeated counts once.
    """
    rows = valid_vectors(df, key, vector)
    queries = rows.filter(is_query(F.col("id"))).dropDuplicates(["id"])
    n_rows, n_queries = rows.count(), queries.count()
    rate = min(1.0, SAMPLE / max(1, n_rows))
    sampled = rows.filter(F.pmod(F.xxhash64("v", "id"), F.lit(1 << 30)) < int(rate * (1 << 30))).orderBy("id")
    sample = np.array([r["v"] for r in sampled.select("v").collect()])
    if not len(sample):
        sample = np.array([r["v"] for r in rows.limit(1).collect()])
    coder = learn(sample, k) if len(sample) else Coder(np.zeros(1), np.ones((1, 1)), 1)
    order = Window.partitionBy("query_id").orderBy("score", "id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = written(best(_search(rows, queries, coder, coder.radius, k, n_rows, n_queries)))
    full = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k, n_rows - 1))
    short = written(queries.join(full, queries["id"] == full["query_id"], "left_anti"))
    n_short = short.count()
    if n_short:
        again = best(_search(rows, short, coder, coder.bits, k, n_rows, n_short))
        first = first.join(full.select("query_id"), "query_id", "left_semi").select(*again.columns).union(again)
    return first.select("query_id", "rank", F.col("id").alias(key), "score")
