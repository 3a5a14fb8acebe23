"""Token ids in compressed binary shards: one wavelet matrix per shard.

A shard file holds the ids of consecutive documents as bit-planes, most significant bit
first; each plane lists its bit in the order that stable partitions by the planes before
it have left. With counts of ones per block, a shard answers access, rank, select and
count from the file, and one pass over the planes gives all ids back.

File format, little-endian: ``WVM1``; three uint64: tokens, documents, planes; then
sections of a uint64 length and zstd-compressed bytes: the documents' ids (int64, with a
flag byte per document, 0 where the id is null), their token counts (uint64), and per plane the number of zeros (uint64) and
the packed bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyweave.llm.common import ROWS_HANDED, give_back_memory, held, in_small_batches, map_batches, written
from tallyweave.llm.pretokens import PieceEncoder

MAGIC = b"WVM1"
# A shard ends with the document that brings it to so many tokens.
SHARD_TOKENS = 1 << 20
# Entries per cache of the encoder, of which a task slot has one.
CACHE_ENTRIES = 1_000_000
# Bits per rank block.
BLOCK = 512


class WaveletMatrix:
    """Access, rank, select and count over one shard's ids."""

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int]) -> None:
        self.size, self.planes, self.zeros = size, planes, zeros
        self._ranks: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, here = [], [], ids
        for k in range(bits - 1, -1, -1):
            bit = (here & here.dtype.type(1 << k)) != 0
            planes.append(np.packbits(bit))
            low, high = np.flatnonzero(~bit), np.flatnonzero(bit)
            zeros.append(len(low))
            following = np.empty_like(here)
            here.take(low, out=following[: len(low)], mode="clip")
            here.take(high, out=following[len(low) :], mode="clip")
            here = following
        return cls(len(ids), planes, zeros)

    def ids(self) -> np.ndarray:
        """All ids, in order."""
        bits = len(self.planes)
        here = np.zeros(self.size, dtype=np.uint16 if bits <= 16 else np.uint32)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            bit = np.unpackbits(plane, count=self.size).view(bool)
            here[zeros:] |= here.dtype.type(1 << k)
            before = np.empty_like(here)
            before[np.flatnonzero(~bit)] = here[:zeros]
            before[np.flatnonzero(bit)] = here[zeros:]
            here = before
        return here

    def _ones(self, plane: int, end: int) -> int:
        """Ones among the first ``end`` bits of a plane."""
        packed = self.planes[plane]
        if plane not in self._ranks:
            per_byte = np.bitwise_count(packed).astype(np.int64)
            starts = np.arange(0, max(1, len(per_byte)), BLOCK // 8)
            sums = np.add.reduceat(per_byte, starts) if len(per_byte) else np.zeros(1, dtype=np.int64)
            self._ranks[plane] = np.concatenate([[0], np.cumsum(sums)])
        block = end // BLOCK
        first = block * (BLOCK // 8)
        rest = np.unpackbits(packed[first : first + BLOCK // 8])[: end - block * BLOCK]
        return int(self._ranks[plane][block]) + int(rest.sum())

    def _bit(self, plane: int, at: int) -> int:
        return (int(self.planes[plane][at >> 3]) >> (7 - (at & 7))) & 1

    def access(self, at: int) -> int:
        if not 0 <= at < self.size:
            raise IndexError(at)
        value = 0
        for plane, zeros in enumerate(self.zeros):
            bit, ones = self._bit(plane, at), self._ones(plane, at)
            at = zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among the first ``end`` ids stand below the last plane."""
        low, high = 0, end
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            a, b = self._ones(plane, low), self._ones(plane, high)
            low, high = (zeros + a, zeros + b) if token >> (bits - 1 - plane) & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, end: int) -> int:
        """Occurrences of ``token`` among the first ``end`` ids."""
        low, high = self._range(token, end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th occurrence of ``token``, from 0; -1 if there are fewer."""
        low, high = self._range(token, self.size)
        if not 0 <= k < high - low:
            return -1
        at = low + k
        for plane in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - plane) & 1
            wanted = at - self.zeros[plane] + 1 if bit else at + 1
            left, right = 0, self.size
            while left < right:
                middle = (left + right) // 2
                ones = self._ones(plane, middle + 1)
                if (ones if bit else middle + 1 - ones) < wanted:
                    left = middle + 1
                else:
                    right = middle
            at = left
        return at


def to_file(ids: np.ndarray, doc_ids: list[int | None], counts: list[int], bits: int) -> bytes:
    """One shard's file."""
    matrix = WaveletMatrix.build(ids, bits)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8).tobytes()
    documents = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    sections = [documents + known, np.array(counts, dtype="<u8").tobytes()]
    sections += [struct.pack("<Q", zeros) + plane.tobytes() for zeros, plane in zip(matrix.zeros, matrix.planes)]
    packed = [squeeze(s) for s in sections]
    head = MAGIC + struct.pack("<3Q", len(ids), len(doc_ids), bits)
    return head + b"".join(struct.pack("<Q", len(p)) + p for p in packed)


def from_file(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """The matrix of a file, its documents' ids and their token counts."""
    if data[:4] != MAGIC:
        raise ValueError("not a shard file")
    size, documents, bits = struct.unpack_from("<3Q", data, 4)
    spread = zstandard.ZstdDecompressor().decompress
    at, sections = 28, []
    for _ in range(2 + bits):
        (length,) = struct.unpack_from("<Q", data, at)
        sections.append(spread(data[at + 8 : at + 8 + length]))
        at += 8 + length
    ids = np.frombuffer(sections[0], dtype="<i8", count=documents).tolist()
    known = sections[0][8 * documents :]
    counts = np.frombuffer(sections[1], dtype="<u8").astype(np.int64)
    zeros = [struct.unpack_from("<Q", s)[0] for s in sections[2:]]
    planes = [np.frombuffer(s, dtype=np.uint8, offset=8) for s in sections[2:]]
    return WaveletMatrix(size, planes, zeros), [d if k else None for d, k in zip(ids, known)], counts


def _encoder(path: str, pattern: str) -> tuple[PieceEncoder, int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    size = tokenizer.get_vocab_size()
    kind = np.uint16 if size <= 1 << 16 else np.uint32

    def encode_many(pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]
        counts = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        return np.fromiter(chain.from_iterable(encoded), dtype=kind, count=int(counts.sum())), counts

    specials = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return PieceEncoder(pattern, encode_many, kind, specials, CACHE_ENTRIES), size


SHARDS = "part INT, shard INT, n_docs BIGINT, n_tokens BIGINT, file BINARY"


def write_shards(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", end: int = 0, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Encodes the whole ``text`` of every row, appends ``end`` to each and writes shards.

    Rows are dealt by ranges of ``key``, so shards in the order of (part, shard) hold
    documents in ascending order of ``key``: nulls first, equal keys by the texts' hash.
    The table of shard files is written in the shared folder by Spark's own writer, so a
    lost executor costs only its tasks. Null text counts as empty. ``key`` is an integer.
    """
    spread = F.xxhash64(text)
    dealt = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), spread.alias("spread"))
    dealt = dealt.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread")

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_HANDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = held(("wavelet", path, pattern), lambda: _encoder(path, pattern))
        bits, kind = (16, np.uint16) if size <= 1 << 16 else (32, np.uint32)
        part, shard = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        parts: list[np.ndarray] = []
        counts: list[int] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            row = [[part], [shard], [len(keys)], [len(ids)], [to_file(ids, keys, counts, bits)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(v, t) for v, t in zip(row, types)]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "shard", "n_docs", "n_tokens", "file"])

        for batch in in_small_batches(batches):
            ids, sizes = encoder.encode(batch.column("text"))
            # The end mark goes behind each document's ids.
            ids = np.insert(ids, np.cumsum(sizes), end)
            ends = np.cumsum(sizes + 1)
            at = 0
            for i, (k, e) in enumerate(zip(batch.column("key").to_pylist(), ends.tolist())):
                keys.append(k)
                counts.append(int(sizes[i]) + 1)
                tokens += counts[-1]
                if tokens >= shard_tokens:
                    parts.append(ids[at:e])
                    yield flush()
                    shard, keys, parts, counts, tokens, at = shard + 1, [], [], [], 0, e
            parts.append(ids[at:])
        if keys:
            yield flush()
        give_back_memory()

    return written(dealt.mapInArrow(run, SHARDS))


def read_documents(shards: DataFrame) -> DataFrame:
    """Rows ``(doc_id, start, n_tokens, ids_crc32)`` read back from the shard files.

    ``start`` counts the ids of all documents before it. Offsets come from the shards'
    token counts, one row per part and shard; the files themselves stay where they are.
    """
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shards.select("part", "shard", F.coalesce(inside, F.lit(0)).alias("inside")).join(parts, "part")
    offsets = written(offsets.select("part", "shard", (F.col("before") + F.col("inside")).alias("offset")))

    def run(batch: pa.RecordBatch) -> pa.Table:
        tables = []
        for data, offset in zip(batch.column("file"), batch.column("offset").to_pylist()):
            matrix, doc_ids, counts = from_file(data.as_py())
            ids = matrix.ids().astype("<u4").tobytes()
            ends = np.cumsum(counts)
            sums = [zlib.crc32(ids[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
            columns = [pa.array(doc_ids, pa.int64()), pa.array(offset + ends - counts), pa.array(counts), pa.array(sums, pa.int64())]
            tables.append(pa.Table.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]))
        return pa.concat_tables(tables)

    files = shards.select("part", "shard", "file").join(offsets, ["part", "shard"]).select("file", "offset")
    return map_batches(files, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT", run)
