"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges are kept in one bucket per merge rank; a bucket holds positions of a linked list
of tokens. A bitmap of 64-way words over the buckets, three levels deep, names the
lowest rank that has work: find-first-set at each level, no heap. An entry whose pair has
changed since it was filed is stale and skipped when its bucket is taken.

Many pre-tokens share one list: links never cross from one to the next, so taking ranks
in order over all of them makes the same merges as taking each alone, and a bucket is
merged at once with array operations. The time is near linear in the length of the list,
so a pre-token of a million characters costs no more per character than a short one.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tallyweave.llm.common import held, map_batches
from tallyweave.llm.pretokens import PieceEncoder, spans

NONE = np.int64(1) << 40
# Bytes of texts that are encoded at once, and entries per cache of the encoder.
BATCH, CACHE_ENTRIES = 500_000, 200_000


class RankQueue:
    """Buckets of positions by rank; ``pop`` takes the lowest rank that has any."""

    def __init__(self, ranks: int) -> None:
        self.levels: list[list[int]] = []
        size = ranks
        while True:
            size = (size + 63) // 64
            self.levels.append([0] * size)
            if size == 1:
                break
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held.append(positions)
            return
        self.buckets[rank] = [positions]
        for level in self.levels:
            rank, bit = rank >> 6, rank & 63
            before = level[rank]
            level[rank] = before | (1 << bit)
            if before:
                break

    def pop(self) -> tuple[int, np.ndarray] | None:
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = (rank << 6) | ((word & -word).bit_length() - 1)
        found, at = self.buckets.pop(rank), rank
        for level in self.levels:
            at, bit = at >> 6, at & 63
            level[at] &= ~(1 << bit)
            if level[at]:
                break
        return rank, found[0] if len(found) == 1 else np.concatenate(found)


class Vocabulary:
    """Merge ranks of a rank file: token bytes to id, id being the rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = max(ranks.values()) + 1
        tokens = {i: t for t, i in ranks.items()}
        lengths = [len(tokens.get(i, b"")) for i in range(self.size)]
        self.token_length = np.array(lengths, dtype=np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(self.size)), dtype=np.uint8)
        self.bytes_ = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        # Open addressing in arrays, so that many pairs are looked up at once.
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        keys = np.array(list(pairs), dtype=np.int64)
        values = np.array(list(pairs.values()), dtype=np.int64)
        at = self._slot(keys)
        self.probes = 1
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.ones(len(keys), dtype=bool)
            left[put] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & ((1 << self.bits) - 1)
            self.probes += bool(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the pair does not merge."""
        keys = left * self.size + right
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def _one(self, word: bytes) -> list[int]:
        """Ids of one pre-token by the plain rule: merge the leftmost pair of lowest rank."""
        tokens = [int(self.bytes_[b]) for b in word]
        while len(tokens) > 1:
            ranked = [self.pairs.get(a * self.size + b, NONE) for a, b in zip(tokens, tokens[1:])]
            best = min(ranked)
            if best == NONE:
                break
            at = ranked.index(best)
            tokens[at : at + 2] = [int(best)]
        return tokens

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens one after the other, and how many each has."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(words) else 0
        if not n:
            return np.empty(0, dtype=np.int32), lengths
        token = self.bytes_[np.frombuffer(b"".join(words), dtype=np.uint8)]
        of = np.repeat(np.arange(len(words)), lengths)
        following = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        filled = lengths > 0
        following[ends[filled] - 1] = -1
        before[(ends - lengths)[filled]] = -1
        rank = np.full(n, NONE)
        inner = np.flatnonzero(following >= 0)
        rank[inner] = self.pair_ranks(token[inner], token[inner + 1])
        alive = np.ones(n, dtype=bool)
        queue = RankQueue(self.size)
        self._file(queue, inner, rank)
        redo: set[int] = set()
        while (taken := queue.pop()) is not None:
            r, at = taken
            at = np.unique(at[alive[at] & (rank[at] == r)])
            if not len(at):
                continue
            right = following[at]
            if len(at) > 1:
                at = at[_alternate(at, right)]
                right = following[at]
            after, prior = following[right], before[at]
            token[at] = r
            alive[right] = False
            rank[right] = NONE
            following[at] = after
            linked = after >= 0
            before[after[linked]] = at[linked]
            changed = np.concatenate([at, prior[prior >= 0]])
            # A neighbour that was merged into the pair before it is gone by now.
            changed = np.unique(changed[alive[changed]])
            nexts = following[changed]
            rank[changed] = NONE
            has = nexts >= 0
            changed, nexts = changed[has], nexts[has]
            rank[changed] = fresh = self.pair_ranks(token[changed], token[nexts])
            early = fresh < r
            if early.any() and len(at) > 1:
                # A lower rank came up while several pairs of one pre-token were merged
                # together; alone, it would have gone first. Such pre-tokens start over.
                words_here, times = np.unique(of[at], return_counts=True)
                redo.update(np.intersect1d(words_here[times > 1], of[changed[early]]).tolist())
            self._file(queue, changed, rank)
        ids = token[alive].astype(np.int32)
        counts = np.bincount(of[alive], minlength=len(words))
        if redo:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for w in redo:
                parts[w] = np.array(self._one(words[w]), dtype=np.int32)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, counts

    @staticmethod
    def _file(queue: RankQueue, positions: np.ndarray, rank: np.ndarray) -> None:
        ranks = rank[positions]
        real = ranks < NONE
        positions, ranks = positions[real], ranks[real]
        if not len(positions):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(ranks)]
        for a, b in zip(starts, starts[1:]):
            queue.push(int(ranks[a]), positions[a:b])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after the other, and how many each id has."""
        lengths = self.token_length[ids]
        return self.token_bytes[spans(self.token_start[ids], lengths)], lengths


def _alternate(at: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of runs of overlapping pairs (``aaaa``), every second one, from the left."""
    overlaps = np.concatenate([[False], right[:-1] == at[1:]])
    place = np.arange(len(at))
    start = np.maximum.accumulate(np.where(overlaps, 0, place))
    return (place - start) % 2 == 0


def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


class Coder:
    """A rank file's vocabulary and, once texts are encoded, its encoder."""

    def __init__(self, path: str) -> None:
        self.words = vocabulary(path)
        self.encoders: dict[str, PieceEncoder] = {}

    def encoder(self, pattern: str) -> PieceEncoder:
        if pattern not in self.encoders:

            def encode_many(pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
                return self.words.encode([p.encode() for p in pretokens])

            self.encoders[pattern] = PieceEncoder(pattern, encode_many, np.int32, entries=CACHE_ENTRIES)
        return self.encoders[pattern]


def coder(path: str) -> Coder:
    """The coder of a rank file, kept in the worker."""
    return held(("bpe", path), lambda: Coder(path))


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)


def _as_binary(words: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """What the ids of each row stand for."""
    flat, lengths = words.decode(ids)
    total = np.concatenate([[0], np.cumsum(lengths)])
    ends = total[_offsets(counts)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds the token ids of the whole ``text``, as ``array<int>``.

    ``path`` names a rank file that every executor can open, ``pattern`` splits text into
    pre-tokens. A null or empty text has no ids. Rows and other columns stay as they are;
    a column named ``into`` is replaced. ``decoded`` names one more column, for the bytes
    that the ids decode to, worked out in the same pass.
    """
    added = [T.StructField(into, T.ArrayType(T.IntegerType(), False))]
    added += [T.StructField(decoded, T.BinaryType())] if decoded else []
    names = [f.name for f in added]
    kept = df.drop(*names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, counts = coder(path).encoder(pattern).encode(batch.column(text))
        columns = [pa.ListArray.from_arrays(pa.array(_offsets(counts)), pa.array(flat))]
        if decoded:
            columns.append(_as_binary(coder(path).words, flat, counts))
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return map_batches(kept, T.StructType([*kept.schema.fields, *added]), run, BATCH)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the bytes that ``ids`` stand for; null ids give no bytes."""
    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(ids)
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        out = _as_binary(coder(path).words, lists.flatten().to_numpy(zero_copy_only=False), counts)
        return pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, into])

    return map_batches(kept, schema, run)
