"""Phrase collocations, counted in HAT-tries.

Each task counts the phrases of its texts in a HAT-trie: the label and the first words lead
through nodes to hash containers of the words that follow; a container that grows too large
bursts into a node with containers of its own. When the trie has as many entries as a task
may hold, whole subtrees, the largest first, are spilled as sorted runs; what is left goes
out the same way at the end. Spark brings the runs of each part of the prefixes (label and
the first two words) together and merges them, so a phrase that fills the corpus costs one
entry per run.

Most phrases are rare, and need not be told apart. Before the tries, passes over the texts
count 40-bit hashes of phrases, length by length, as one of ``k`` words can only be frequent
if both of its parts of ``k - 1`` words are: packed sorted runs of a few bytes a phrase, merged
per range of hashes. A table of bits, as large for any input, then tells which phrases may be
frequent; hashes that phrases share only let more of them into the tries, never fewer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave.llm import bits
from tallyweave.llm.common import ROWS_HANDED, give_back_memory, in_small_batches, written
from tallyweave.llm.hashing import Words, mix, new_key, spans_hash

# What ends a piece, and what separates words in it.
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
# Entries of a container before it bursts, of a task's trie before it spills, and words
# that a task numbers.
BURST, ENTRIES, WORDS = 4_096, 300_000, 300_000
BATCH = 700_000
# Phrases in one run of hashes, and characters of all texts for each range of hashes.
RUN, RANGE_CHARACTERS = 2_000_000, 8_000_000
RUNS = "part BIGINT, run BINARY"
_RUN = pa.schema([("label", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


class _Node(dict):
    """Children by the next word, and the count of the phrase that ends here."""

    count = 0


class HatTrie:
    """Counts by path; ``size`` is the number of paths."""

    def __init__(self, burst: int = BURST) -> None:
        self.burst, self.size = burst, 0
        self.root = _Node()

    def add(self, path: tuple[int, ...], n: int) -> None:
        node, depth = self.root, 0
        while True:
            word = path[depth]
            depth += 1
            child = node.get(word)
            if type(child) is _Node:
                if depth == len(path):
                    self.size += not child.count
                    child.count += n
                    return
                node = child
                continue
            rest = path[depth:]
            if child is None:
                node[word] = {rest: n}
                self.size += 1
                return
            before = child.get(rest)
            if before is not None:
                child[rest] = before + n
                return
            child[rest] = n
            self.size += 1
            if len(child) > self.burst:
                node[word] = _burst(child)
            return

    def subtrees(self) -> list[tuple[int, int]]:
        """``(entries, first word)``, the largest first."""
        return sorted(((_size(child), word) for word, child in self.root.items()), reverse=True)

    def take(self, word: int) -> list[tuple[tuple[int, ...], int]]:
        """Removes a whole subtree and returns its paths with their counts."""
        found = list(_paths(self.root.pop(word), (word,)))
        self.size -= len(found)
        return found


def _burst(container: dict) -> _Node:
    node = _Node()
    for rest, n in container.items():
        if rest:
            node.setdefault(rest[0], {})[rest[1:]] = n
        else:
            node.count = n
    return node


def _size(child: dict) -> int:
    if type(child) is not _Node:
        return len(child)
    return bool(child.count) + sum(map(_size, child.values()))


def _paths(child: dict, path: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
    if type(child) is not _Node:
        for rest, n in child.items():
            yield path + rest, n
        return
    if child.count:
        yield path, child.count
    for word, below in child.items():
        yield from _paths(below, (*path, word))


class _Counter:
    """A task's trie, the numbers of its words, and what it spills."""

    def __init__(self, burst: int, entries: int, parts: int) -> None:
        self.trie, self.entries, self.parts = HatTrie(burst), entries, parts
        self.numbers: dict[bytes, int] = {}
        self.words: list[bytes] = []

    def number(self, word: bytes) -> int:
        found = self.numbers.get(word)
        if found is None:
            found = self.numbers[word] = len(self.words)
            self.words.append(word)
        return found

    def spilled(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees, until half of the entries are left, or none."""
        if not everything and self.trie.size <= self.entries and len(self.words) <= WORDS:
            return
        everything = everything or len(self.words) > WORDS
        for _, word in self.trie.subtrees():
            if not everything and self.trie.size <= self.entries // 2:
                return
            runs: dict[int, list[tuple]] = {}
            for path, n in self.trie.take(word):
                words = tuple(map(self.words.__getitem__, path))
                # A prefix is a label and at most two words; its phrases all go to one part.
                runs.setdefault(zlib.crc32(b" ".join(words[:3])) % self.parts, []).append((words[0], b" ".join(words[1:]), n))
            yield _run_rows({part: sorted(run) for part, run in runs.items()})
        self.numbers.clear()
        self.words.clear()


def _hashes(values: pa.Array, key: int) -> np.ndarray:
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)
    return spans_hash(data, offsets[:-1], offsets[1:], key)


def _run_rows(runs: dict[int, list[tuple]]) -> pa.RecordBatch:
    """Rows ``(part, run)``: sorted ``(label, phrase, n)`` entries, packed and compressed."""
    packed = []
    for run in runs.values():
        columns = [pa.array([r[i] for r in run], pa.binary()).cast(pa.string()) for i in (0, 1)]
        batch = pa.RecordBatch.from_arrays([*columns, pa.array([r[2] for r in run], pa.int64())], schema=_RUN)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _RUN, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        packed.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(list(runs), pa.int64()), pa.array(packed, pa.binary())], names=["part", "run"])


class _Phrases:
    """Phrases of a batch of ``(label, text)`` rows."""

    def __init__(self, batch: pa.RecordBatch, key: int) -> None:
        labels = batch.column("label").dictionary_encode()
        self.names = [x.encode() for x in labels.dictionary.to_pylist()]
        self.words = Words(batch.column("text"), lower=True, blanks=ENDS + BLANKS)
        self.label = np.repeat(labels.indices.to_numpy(zero_copy_only=False).astype(np.int64), self.words.counts())
        self.codes, self.values = self.words.codes()
        self.marks = _hashes(pa.array(self.names, pa.large_binary()), key)
        self.hashed = _hashes(self.values, key)
        ends = np.cumsum(np.isin(np.arange(256), list(ENDS))[self.words.data])
        text = np.repeat(np.arange(len(batch)), self.words.counts())
        # What changes where a piece or a text ends.
        self.piece = ends[self.words.start] + text if len(text) else text

    def starts(self, size: int) -> np.ndarray:
        """Words from which ``size`` words stand in one piece of one text."""
        n = max(len(self.piece) - size + 1, 0)
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1 :][:n])

    def hashes(self, start: np.ndarray, size: int) -> np.ndarray:
        """40-bit hashes of the phrases of ``size`` words from each start, with their labels."""
        out = mix(self.marks[self.label[start]] + np.uint64(size))
        for k in range(size):
            out = mix(out + self.hashed[self.codes[start + k]])
        return out >> np.uint64(64 - bits.HASH_BITS)

    def that_may_be(self, table: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
        """Those of the starts whose phrase may be in the table."""
        return start[bits.may_hold(table, mix(self.hashes(start, size)))]


def may_be_frequent(texts: DataFrame, sizes: list[int], least: int, ranges: int, key: int, shorter: np.ndarray | None) -> list[np.ndarray]:
    """A table of bits for each of the ``sizes``: phrases whose hash occurs ``least`` times or
    more. ``shorter`` has those of one word less than the first size."""
    spark = texts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_HANDED)
    shared = None if shorter is None else spark.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {k: [] for k in sizes}

        def flush(size: int) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held[size]), return_counts=True)
            held[size] = []
            part = (values * np.uint64(ranges) >> np.uint64(bits.HASH_BITS)).astype(np.int64)
            parts, first = np.unique(part, return_index=True)
            edges = [*first.tolist(), len(values)]
            packed = [bits.packed(values[a:b], n[a:b]) for a, b in zip(edges, edges[1:])]
            columns = [pa.array([size] * len(parts), pa.int32()), pa.array(parts), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["size", "part", "run"])

        for batch in in_small_batches(batches, BATCH):
            phrases = _Phrases(batch, key)
            for size in sizes:
                start = phrases.starts(size)
                if shared is not None:
                    for offset in (0, 1):
                        start = phrases.that_may_be(shared.value, start + offset, size - 1) - offset
                if len(start):
                    held[size].append(phrases.hashes(start, size))
                if sum(map(len, held[size])) > RUN:
                    yield flush(size)
        for size in sizes:
            if held[size]:
                yield flush(size)
        give_back_memory()

    def merge(table: pa.Table) -> pa.Table:
        found = [bits.unpacked(r) for r in table.column("run").to_pylist()]
        values, counts = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(values, kind="stable")
        values = values[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        often = values[first][np.add.reduceat(counts[order].astype(np.int64), first) >= least]
        sizes = pa.array(np.full(len(often), table.column("size")[0].as_py(), dtype=np.int32))
        return pa.Table.from_arrays([sizes, pa.array(mix(often).view(np.int64))], names=["size", "h"])

    packed = texts.select("label", "text").mapInArrow(run, "size INT, part BIGINT, run BINARY")
    found = written(packed.groupBy("size", "part").applyInArrow(merge, "size INT, h BIGINT"))
    return [bits.table(found.filter(F.col("size") == k).select("h")) for k in sizes]


def runs(texts: DataFrame, key: int, may_be: list[np.ndarray], parts: int) -> DataFrame:
    """Rows ``(part, run)`` of ``(label, text)`` rows: sorted runs of counts of the phrases of
    ``k`` words that ``may_be[k - 1]`` lets through, dealt by their prefix, and of entries with
    a null phrase, which count all words."""
    spark = texts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_HANDED)
    shared = [spark.sparkContext.broadcast(table) for table in may_be]
    burst, entries = BURST, ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(burst, entries, parts)
        totals: dict[bytes, int] = {}
        for batch in in_small_batches(batches, BATCH):
            phrases = _Phrases(batch, key)
            codes, values = phrases.codes, phrases.values
            for name, n in zip(phrases.names, np.bincount(phrases.label, minlength=len(phrases.names)).tolist()):
                totals[name] = totals.get(name, 0) + n
            names_at = np.array([counter.number(x) for x in phrases.names], dtype=np.int64)
            numbers = np.full(len(values), -1, dtype=np.int64)
            for size, table in enumerate(shared, start=1):
                start = phrases.that_may_be(table.value, phrases.starts(size), size)
                if not len(start):
                    continue
                first, n = _distinct(phrases.label, codes, start, size, len(values))
                used = np.unique(codes[first[:, None] + np.arange(size)])
                used = used[numbers[used] < 0]
                numbers[used] = [counter.number(w) for w in values.take(pa.array(used)).to_pylist()]
                paths = np.column_stack([names_at[phrases.label[first]], *(numbers[codes[first + k]] for k in range(size))])
                for path, count in zip(map(tuple, paths.tolist()), n.tolist()):
                    counter.trie.add(path, count)
            yield from counter.spilled()
        yield from counter.spilled(True)
        if totals:
            yield _run_rows({0: [(label, None, n) for label, n in totals.items()]})
        give_back_memory()

    return texts.select("label", "text").mapInArrow(run, RUNS)


def _distinct(label: np.ndarray, codes: np.ndarray, start: np.ndarray, size: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """A start of each distinct phrase, and how often it is there."""
    name = label[start]
    for k in range(size):
        _, first, name, n = np.unique(name * many + codes[start + k], return_index=True, return_inverse=True, return_counts=True)
    return start[first], n


def merged(found: DataFrame, least: int) -> DataFrame:
    """Rows ``(label, phrase, n)``: the runs of each part merged, counts of ``least`` or more,
    and all words of a label under a null phrase."""

    def merge(table: pa.Table) -> pa.Table:
        read = [pa.ipc.open_stream(r).read_all() for r in table.column("run").to_pylist()]
        added = pa.concat_tables(read).group_by(["label", "phrase"]).aggregate([("n", "sum")])
        added = added.select(["label", "phrase", "n_sum"]).rename_columns(["label", "phrase", "n"])
        keep = pa.compute.or_(pa.compute.greater_equal(added["n"], least), pa.compute.is_null(added["phrase"]))
        return added.filter(keep)

    return found.groupBy("part").applyInArrow(merge, "label STRING, phrase STRING, n BIGINT")


def frequent_phrases(texts: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(label, phrase, size, n)`` of all phrases of up to ``longest`` words that occur
    ``least`` times or more under their label, and rows ``(label, total)`` of all words."""
    key = new_key()
    characters = texts.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    ranges = 1 + characters // RANGE_CHARACTERS
    may_be = may_be_frequent(texts, [1, 2][:longest], least, ranges, key, None)
    while len(may_be) < longest and may_be[-1].any():
        may_be += may_be_frequent(texts, [len(may_be) + 1], least, ranges, key, may_be[-1])
    counted = written(merged(runs(texts, key, may_be, ranges), least))
    totals = counted.filter("phrase IS NULL").select("label", F.col("n").alias("total"))
    size = F.size(F.split("phrase", " ", -1))
    return counted.filter("phrase IS NOT NULL").withColumn("size", size), totals


def _exact(*factors: Column | str) -> Column:
    """Product as a decimal of 38 digits."""
    out = None
    for c in factors:
        one = (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
        out = one if out is None else out * one
    return out


def mine(
    df: DataFrame, text: str = "text", label: str = "lang", longest: int = 5, least: int = 100, covered: int = 100, top: int = 2000,
) -> DataFrame:
    """Rows ``(label, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each label.

    A-Z is lower-cased; texts are split at ``.,;:!?`` and line ends into pieces, pieces at
    blanks and tabs into words. A candidate is a phrase of 2 to ``longest`` words of one
    piece with ``a`` >= ``least`` occurrences under its label. Cut behind its first words,
    it scores 1000 a n / (l r), rounded down, ``l`` and ``r`` being the counts of both parts
    and ``n`` that of all words; its lowest cut counts, of equal ones the first. A candidate
    inside a longer one that occurs at least ``covered`` hundredths as often is dropped.
    Order: score, then ``a``, both descending, then the phrase's bytes.

    A null label is ``und``. Null and empty texts have no words; repeated rows count as
    often as they are there. Other columns are not read.
    """
    source = df.select(F.coalesce(F.col(label).cast("string"), F.lit("und")).alias("label"), F.coalesce(text, F.lit("")).alias("text"))
    counts, totals = frequent_phrases(source, longest, least)
    candidates = counts.filter("size > 1")
    words = F.split("phrase", " ", -1)

    def part(start: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", start, size), " ")

    split = candidates.withColumn("words", words)
    cuts = split.select("label", "phrase", F.col("n").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "label", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right")
    )
    left = counts.select("label", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("label", F.col("phrase").alias("right"), F.col("n").alias("r"))
    sized = cuts.join(left, ["label", "left"]).join(right, ["label", "right"]).join(totals, "label")
    scores = sized.withColumns({"over": _exact(F.col("a") * 1000, "total"), "under": _exact("l", "r")})
    scores = scores.withColumn("score", F.expr("over div under"))
    best = scores.groupBy("label", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", F.col("total").alias("n"))).alias("best"))

    # Parts of longer candidates, each with the count of the commonest of those.
    size = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m")
    inner = split.filter("size > 2").select("label", "words", "n", "size", size)
    inner = inner.select("label", "words", "n", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
    inside = inner.groupBy("label", part(F.col("i"), F.col("m")).alias("phrase")).agg(F.max("n").alias("longer"))
    kept = best.join(inside, ["label", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("best.a") * covered)
    )
    order = Window.partitionBy("label").orderBy(F.desc("best.score"), F.desc("best.a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        F.col("label").alias(label), F.col("rank").cast("bigint").alias("rank"), "phrase", *[f"best.{c}" for c in ("a", "l", "r", "n", "score")]
    )
