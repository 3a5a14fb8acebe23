"""Language identification by cross-parsing against suffix automata.

For each language, a suffix automaton of sampled labelled text knows every substring of
it. A text is parsed greedily into phrases, each the longest match in that automaton; the
number of phrases times the log of the sample's length, per character, estimates the
cross entropy in bits. The language that needs fewest bits wins.
Every letter of the samples keeps its identity, whatever its script; a letter that a sample
lacks is a phrase of its own.

Training is bounded by documented parameters (``Sample``); prediction reads whole texts,
in blocks of ``BLOCK`` characters that each start a new phrase, many blocks in lockstep.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyweave.llm.common import held, map_batches, texts_of

# Characters of a block that is parsed in one run.
BLOCK = 512
# Blocks that go in lockstep, and places that are tried at once for a state's steps.
BLOCKS, WINDOW = 8_192, 512
# Characters of evidence that the score counts at most.
EVIDENCE = 40


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled sample: languages by frequency, distinct excerpts per
    language by hash order, characters taken from each document and kept per language."""

    languages: int = 128
    documents: int = 64
    excerpt: int = 2_000
    characters: int = 32_000


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in follow[at]:
            follow[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = follow[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and follow[at].get(symbol) == target:
                    follow[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return follow


def packed(follow: list[dict[int, int]], classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The automaton as ``owner``, ``goto`` and ``start``, of a size that grows with its
    transitions and the number of classes, not with their product.

    Each state is a number of its own, the start 0. From state s, class c leads on to
    ``goto[s + c]`` if ``owner[s + c]`` is s. Otherwise the phrase ended, and the next one
    begins with c in state ``start[c]``, which is 0 if the sample lacks c.
    """
    steps = [np.fromiter(out, dtype=np.int64, count=len(out)) for out in follow]
    degree = np.fromiter(map(len, follow), dtype=np.int64, count=len(follow))
    degree[0] = 0  # The start needs no steps: all that begins there begins a phrase.
    number = np.zeros(len(follow), dtype=np.int64)
    spare = np.ones(2 * len(follow) + WINDOW, dtype=bool)  # numbers that no state has
    spare[0] = False
    empty = np.ones(len(spare) + classes, dtype=bool)  # places that no step has

    def grow(least: int) -> None:
        nonlocal spare, empty
        if least > len(spare):
            more = np.ones(max(least, 2 * len(spare)) - len(spare), dtype=bool)
            spare, empty = np.concatenate([spare, more]), np.concatenate([empty, more])

    # States with most steps first, each at the first number where all of its steps fit.
    order = np.argsort(-degree, kind="stable")
    at = 1
    for state in order[: int((degree > 1).sum())].tolist():
        while True:
            grow(at + WINDOW)
            fits = spare[at : at + WINDOW].copy()
            for c in steps[state].tolist():
                fits &= empty[at + c : at + c + WINDOW]
            first = int(fits.argmax())
            if fits[first]:
                break
            at += WINDOW
        number[state] = at + first
        spare[at + first] = False
        empty[at + first + steps[state]] = False
    # A single step fits nearly anywhere and fills what is left between.
    single = np.flatnonzero(degree == 1)
    by = np.array([steps[state][0] for state in single.tolist()], dtype=np.int64)
    kinds, counts = np.unique(by, return_counts=True)
    for k in np.argsort(-counts, kind="stable").tolist():
        c, states = int(kinds[k]), single[by == kinds[k]]
        while True:
            found = np.flatnonzero(spare & empty[c : c + len(spare)])[: len(states)]
            if len(found) == len(states):
                break
            grow(len(spare) + 1)
        number[states] = found
        spare[found] = False
        empty[found + c] = False
    last = np.flatnonzero(degree[1:] == 0) + 1
    grow(len(spare) + len(last))
    number[last] = np.flatnonzero(spare)[: len(last)]

    owner = np.full(int(number.max()) + classes, -1, dtype=np.int32)
    goto = np.zeros(len(owner), dtype=np.int32)
    of = np.repeat(number, degree)
    place = of + np.concatenate([np.zeros(0, dtype=np.int64), *steps[1:]])
    owner[place] = of
    goto[place] = number[[target for out in follow[1:] for target in out.values()]]
    start = np.zeros(classes, dtype=np.int32)
    start[steps[0]] = number[list(follow[0].values())]
    return owner, goto, start


class Model:
    """Parsing tables of all languages. Class 0 is a letter that no sample has, class 1
    anything that is no letter, and every letter of a sample has a class of its own."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.languages = sorted(samples)
        seen = Counter(c for text in samples.values() for c in text if c.isalpha())
        self.size = len(seen) + 2
        self.classes = np.where(_is_letter(), 0, 1).astype(np.min_scalar_type(self.size))
        for number, c in enumerate(sorted(sorted(seen), key=lambda c: -seen[c]), start=2):
            self.classes[ord(c)] = number
        coded = [self.codes([samples[name]])[0] for name in self.languages]
        self.tables = [packed(suffix_automaton(codes.tolist()), self.size) for codes in coded]
        self.weights = np.array([math.log2(max(2, len(codes))) for codes in coded])

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all characters, a run of others than letters being one, and their
        number in each text."""
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        codes = self.classes[np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)]
        stay = codes != 1
        stay[1:] |= codes[:-1] != 1
        ends = np.cumsum(lengths)
        stay[(ends - lengths)[lengths > 0]] = True
        kept = np.concatenate([[0], np.cumsum(stay)])
        return codes[stay], kept[ends] - kept[ends - lengths]

    def bits(self, texts: list[str]) -> np.ndarray:
        """Estimated bits per character of each text under each language."""
        codes, lengths = self.codes(texts)
        blocks = -(-lengths // BLOCK)
        of = np.repeat(np.arange(len(texts)), blocks)
        place = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(lengths) - lengths, blocks) + place * BLOCK
        size = np.minimum(BLOCK, np.repeat(lengths, blocks) - place * BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, of = start[order], size[order], of[order]
        sums = np.zeros((len(texts), len(self.tables)))
        for low in range(0, len(of), BLOCKS):
            part = slice(low, low + BLOCKS)
            found = self._phrases(codes, start[part], size[part])
            for language, phrases in enumerate(found):
                sums[:, language] += np.bincount(of[part], weights=phrases, minlength=len(texts))
        return sums * self.weights / np.maximum(lengths, 1)[:, None]

    def _phrases(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
        """For each language, the phrases of blocks that are given longest first."""
        # Blocks with more than t characters are the first active[t].
        active = np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist()
        line = np.concatenate([codes[start[:n] + t] for t, n in enumerate(active)])
        for owner, goto, begin in self.tables:
            fresh = begin[line]
            state = np.zeros(len(start), dtype=np.int32)
            phrases = np.zeros(len(start), dtype=np.int32)
            at = 0
            for n in active:
                s = state[:n]
                place = s + line[at : at + n]
                ended = owner[place] != s
                phrases[:n] += ended
                state[:n] = np.where(ended, fresh[at : at + n], goto[place])
                at += n
            yield phrases

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text; ``und`` for a text without a letter."""
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        bits = self.bits([t.lower() for t in texts])
        best = bits.argmin(axis=1)
        gap = bits - bits.min(axis=1, keepdims=True)
        evidence = np.minimum([len(t) for t in texts], EVIDENCE)[:, None]
        score = 1 / np.exp2(-gap * evidence).sum(axis=1)
        return [
            (self.languages[b], float(s)) if any(map(str.isalpha, t)) else ("und", 0.0)
            for t, b, s in zip(texts, best.tolist(), score.tolist())
        ]


def held_out(key: Column) -> Column:
    """Rows whose crc32 of the key as text leaves 2 when divided by 4; a null key does not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def samples(labelled: DataFrame, text: str, label: str, bounds: Sample = Sample()) -> dict[str, str]:
    """Sampled text per language, at most ``bounds`` in all; the only rows that the driver sees.
    Equal excerpts of a language count once, however many rows have them."""
    usable = labelled.filter(F.col(label).isNotNull() & (F.length(text) > 0)).select(
        F.col(label).alias("label"), F.substring(text, 1, bounds.excerpt).alias("excerpt")
    ).withColumn("place", F.xxhash64("excerpt"))
    common = usable.groupBy("label").count().orderBy(F.desc("count"), "label").limit(bounds.languages)
    # Only hashes are shuffled; the excerpts of the few that are taken are looked up after.
    by_hash = Window.partitionBy("label").orderBy("place")
    places = usable.select("label", "place").distinct().withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= bounds.documents)
    taken = places.join(F.broadcast(common), "label", "left_semi")
    first = usable.join(F.broadcast(taken), ["label", "place"]).select("label", "n", "excerpt").distinct()
    out: dict[str, str] = {}
    for row in first.orderBy("label", "n", "excerpt").collect():
        before = out.get(row["label"], "")
        if len(before) < bounds.characters:
            out[row["label"]] = f"{before}\n{row['excerpt'].lower()}"[: bounds.characters]
    return out


def predict(df: DataFrame, learned: dict[str, str], text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the language and its score (0 to 1), from the whole text, as columns ``into``.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    Ties go to the language that sorts first. Columns of these names are replaced.
    """
    kept = df.drop(*into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(learned)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = ("language", *sorted(shared.value.items()))
        found = held(key, lambda: Model(shared.value)).predict(texts_of(batch, text))
        columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *into])

    # Blocks go in lockstep, so more of them at once cost less each.
    return map_batches(kept, schema, run, 1_500_000)


def identify(
    df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", bounds: Sample = Sample(), into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Learns from the rows that are not held out and have a key, then predicts every row."""
    learning = df.filter(F.col(key).isNotNull() & ~held_out(F.col(key)))
    return predict(df, samples(learning, text, label, bounds), text, into)
