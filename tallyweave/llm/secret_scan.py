"""Secret scans: fixed patterns, and character Markov models for what they miss.

Two first-order character models are trained from labelled samples: values that the fixed
patterns find in a bounded sample of documents are random strings, other words of the
same documents are ordinary identifiers. A word whose log-likelihood ratio speaks for the
random model becomes one more span.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyweave.llm.common import map_batches, texts_of

# Kinds, patterns and least lengths of the base scan, in the order of kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

# Characters of a word that the models judge, and of one they are trained with.
WORD = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
TRAINING_WORD = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# A code for every code point below 128; others never occur in a judged word.
_CODES = np.full(128, len(SYMBOLS), dtype=np.int64)
_CODES[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
SIZE = len(SYMBOLS) + 1

# Bounds of the training sample: documents on average, ordinary words of each.
SAMPLE_DOCUMENTS = 4_000
SAMPLE_WORDS = 50
# Bits for the random model that a span needs, in all and per character.
LEAST_BITS, LEAST_BITS_EACH = 24.0, 1.2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, ends exclusive, in code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _secret_values(text: str) -> list[str]:
    out = [m[1] for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    out += [m[0] for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return out + HEX.findall(text)


def _pairs(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each character and of the one before it (a mark before the first)."""
    codes = _CODES[np.frombuffer(word.encode("ascii", "replace"), dtype=np.uint8) & 127]
    return np.concatenate([[len(SYMBOLS)], codes[:-1]]), codes


def count_transitions(df: DataFrame, text: str = "text", documents: int = SAMPLE_DOCUMENTS) -> np.ndarray:
    """Counts ``[label, before, character]`` over a bounded sample, label 1 being random strings.

    The sample takes documents by hash, at a rate that gives ``documents`` of them on
    average whatever the input's size, and ``SAMPLE_WORDS`` ordinary words of each.
    """
    rate = min(1.0, documents / max(1, df.count()))
    sampled = df.select(F.col(text).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(rate * (1 << 30)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.zeros((2, SIZE, SIZE), dtype=np.int64)
        for document in texts_of(batch):
            spans = base_spans(document)
            words = _outside(TRAINING_WORD.finditer(document), spans)
            ordinary = [m[0] for m, _ in zip(words, range(SAMPLE_WORDS))]
            for label, values in ((0, ordinary), (1, _secret_values(document))):
                for value in values:
                    np.add.at(counts[label], _pairs(value), 1)
        label, before, after = np.nonzero(counts)
        columns = [pa.array(x, pa.int64()) for x in (label, before, after, counts[label, before, after])]
        return pa.RecordBatch.from_arrays(columns, names=["label", "before", "after", "n"])

    pairs = map_batches(sampled, "label BIGINT, before BIGINT, after BIGINT, n BIGINT", run)
    counts = np.zeros((2, SIZE, SIZE))
    # One row per label and pair of symbols: 9,248 at most.
    for row in pairs.groupBy("label", "before", "after").agg(F.sum("n").alias("n")).collect():
        counts[row["label"], row["before"], row["after"]] = row["n"]
    return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Bits for the random model per transition.

    Both models are smoothed towards their own character frequencies, and those towards
    the uniform distribution; with no samples at all, every ratio is 0.
    """
    models = []
    for table in counts:
        single = table.sum(axis=0)[: len(SYMBOLS)] + 1.0
        single = single / single.sum()
        rows = table[:, : len(SYMBOLS)]
        strength = 8.0
        models.append((rows + strength * single) / (rows.sum(axis=1, keepdims=True) + strength))
    ordinary, random = models
    return np.pad(np.log2(random / ordinary), ((0, 0), (0, 1)))


def _outside(words: Iterable[re.Match], spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """Words that meet no span; both are in order, so each is passed once."""
    covered = _merged([(a, b) for a, _, b in spans])
    i = 0
    for m in words:
        while i < len(covered) and covered[i][1] <= m.start():
            i += 1
        if i == len(covered) or covered[i][0] >= m.end():
            yield m


def all_spans(text: str, ratios: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Base spans and words that the models call random; score in bits, 0 for base spans."""
    base = base_spans(text)
    found = [(a, kind, b, 0.0) for a, kind, b in base]
    for m in _outside(WORD.finditer(text), base):
        word = m[0]
        if word.isdigit() or len(set(word)) < 6:
            continue
        bits = float(ratios[_pairs(word)].sum())
        if bits >= LEAST_BITS and bits >= LEAST_BITS_EACH * len(word):
            found.append((m.start(), 3, m.end(), bits))
    return sorted(found)


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("bits", T.DoubleType()),
        ]
    )
)


def scan(df: DataFrame, counts: np.ndarray, text: str = "text", into: str = "secrets") -> DataFrame:
    """Adds the spans of secrets in the whole text: kind, start, end (exclusive), in code
    points, sorted by start, then kind. Null text has none. A column ``into`` is replaced."""
    kept = df.drop(into)
    ratios = log_ratios(counts)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, SPANS)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": KINDS[k], "start": a, "end": b, "bits": bits} for a, k, b, bits in all_spans(t, ratios)]
            for t in texts_of(batch, text)
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, arrow)], names=[*batch.schema.names, into])

    return map_batches(kept, schema, run)


def redact(df: DataFrame, text: str = "text", spans: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """Replaces every span, overlapping ones as one, by ``mark`` and drops ``spans``.

    Rows without spans stay as they are, null texts included.
    """
    kept = df.drop(spans)
    names = kept.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text).to_pylist()
        for i, found in enumerate(batch.column(spans).to_pylist()):
            if found:
                out, at = [], 0
                for a, b in _merged([(s["start"], s["end"]) for s in found]):
                    out += [texts[i][at:a], mark]
                    at = b
                texts[i] = "".join(out) + texts[i][at:]
        columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(df, kept.schema, run)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def bits_of(word: str, counts: np.ndarray) -> float:
    """Log-likelihood ratio of one word, in bits for the random model."""
    return float(log_ratios(counts)[_pairs(word)].sum()) if word else 0.0

