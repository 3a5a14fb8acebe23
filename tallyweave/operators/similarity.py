"""Exact similarity join on Ratcliff-Obershelp ratio, over a metric index.

ratio(a, b) = 2M / (|a| + |b|), M the characters in matching blocks. With S = |a| + |b|
and ratio >= t:

* M >= tS/2, and M cannot exceed either length, so lengths must be within t / (2 - t) of
  each other. Strings only meet in classes of compatible lengths.
* M cannot exceed the characters both strings have, repeats counted. So the counts of
  characters of both, as vectors, are at most S - 2M apart in the L1 metric.
* At most S - 2M characters stay unmatched, and one of them lies between any two
  blocks, so there are at most S - 2M + 1 blocks. A block of m characters holds m - 1
  bigrams, hence the strings share at least 3M - S - 1 >= S(1.5t - 1) - 1 bigrams.

Some right strings are pivots. A right string belongs to the cell of its length class, its
nearest pivot, and the band of its distance to it. By the triangle inequality, a left
string reaches within r = S(1 - t) only cells whose pivot is at most 2r further away than
its nearest one, and of those only the bands next to its own distance.

Where just the best ``k`` are asked for, a left string first meets its own cell. The score
of the ``k``-th best there is one that the result cannot stay below, so the search goes on
with it in place of t: the denser the strings, the nearer it has to look.

Cells are cut into blocks of bounded size, one row per string and block. Inside a task,
counts of characters and of bigrams (hashed into a fixed number of bins, which can only
raise the bounds) turn most pairs away, best bounds first. No pair that counts is lost. The
plan is lazy: pivots are one row of ``PIVOTS`` vectors at most, so its broadcast is bounded.

The scoring function ignores characters that make up more than a hundredth of a right
string of 200 characters or more, as its usual settings do. That can only lower a ratio,
so the bounds still lose nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave import constants as K
from tallyweave.session import shared

_EPS = 1e-9
# Lengths of one class differ by at most this factor.
_CLASS = 1.15
# Strings of one side that meet in one task.
BLOCK = 2_000
# Pivots at most, right strings for each, and the width of a band as a share of the length.
PIVOTS, STRINGS_A_PIVOT, BAND = 32, 100, 0.25
_LETTERS, _PAIRS = 64, 128
# Scores this close may round alike.
_ROUNDING = 0.0011


def _class(length: np.ndarray | int) -> np.ndarray:
    return np.floor(np.log(length) / math.log(_CLASS) + _EPS).astype(np.int64)


def _longest(c: int) -> int:
    """No string of the class is longer."""
    return math.floor(_CLASS ** (c + 1) + 1e-6)


def _band_width(c: int) -> int:
    return max(1, round(BAND * _CLASS**c))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _profile(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, counts of hashed characters and counts of hashed bigrams of each text."""
    letters = np.zeros((len(texts), _LETTERS), dtype=np.int32)
    pairs = np.zeros((len(texts), _PAIRS), dtype=np.int32)
    for row, text in enumerate(texts):
        codes = _codes(text)
        letters[row] = np.bincount((codes % _LETTERS).astype(np.int64), minlength=_LETTERS)
        mixed = (codes[:-1] * np.uint64(1_000_003) + codes[1:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(57)
        pairs[row] = np.bincount(mixed.astype(np.int64), minlength=_PAIRS)
    return np.array([len(t) for t in texts], dtype=np.int64), letters, pairs


def _letters(texts: list[str]) -> np.ndarray:
    """Counts of hashed characters, none over 255: such a cut never takes vectors apart."""
    out = np.zeros((len(texts), _LETTERS), dtype=np.int32)
    for row, text in enumerate(texts):
        out[row] = np.minimum(np.bincount((_codes(text) % _LETTERS).astype(np.int64), minlength=_LETTERS), 255)
    return out


def _pivots(right: DataFrame) -> DataFrame:
    """One row ``(one, pivots)``: the vectors of some right strings, more for more strings.

    Of each of ``PIVOTS`` classes of strings by hash, the one that comes first.
    """

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [v.astype(np.uint8).tobytes() for v in _letters(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(found, pa.binary()), batch.column("n")], names=["at", "vector", "n"])

    at = F.xxhash64("text")
    first = F.min(F.struct(at.alias("at"), "text")).alias("first")
    some = right.groupBy(F.pmod(at, F.lit(PIVOTS)).alias("slot")).agg(first, F.count(F.lit(1)).alias("n"))
    some = some.select("first.at", "first.text", "n").mapInArrow(vectors, "at BIGINT, vector BINARY, n BIGINT")
    many = F.greatest(F.least(F.ceil(F.sum("n") / STRINGS_A_PIVOT), F.lit(PIVOTS)), F.lit(1)).cast("int")
    listed = some.agg(F.sort_array(F.collect_list(F.struct("at", "vector"))).alias("listed"), many.alias("many"))
    return listed.select(F.lit(1).alias("one"), F.slice("listed.vector", F.lit(1), F.col("many")).alias("pivots"))


def _placed(df: DataFrame, pivots: DataFrame) -> DataFrame:
    """Adds ``class, pivot, band`` (the cell), ``d`` (distance to its pivot) and ``distances``
    (to all of them) to rows with a ``text``."""
    kept = df.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", class INT, pivot INT, band INT, d INT, distances BINARY"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.stack([np.frombuffer(v, dtype=np.uint8) for v in batch.column("pivots")[0].as_py()]).astype(np.int32)
            texts = batch.column("text").to_pylist()
            letters = _letters(texts)
            distances = np.stack([np.abs(letters - p).sum(axis=1) for p in points], axis=1).astype(np.int32)
            nearest = distances.argmin(axis=1)
            d = distances[np.arange(len(texts)), nearest]
            kind = _class(np.array([len(t) for t in texts]))
            band = d // np.array([_band_width(c) for c in kind.tolist()])
            added = [pa.array(x.astype(np.int32)) for x in (kind, nearest, band, d)]
            packed = pa.array([row.tobytes() for row in distances], pa.binary())
            names = [*kept, "class", "pivot", "band", "d", "distances"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added, packed], names=names)

    return df.withColumn("one", F.lit(1)).join(F.broadcast(pivots), "one").drop("one").mapInArrow(run, schema)


def reached(length: int, distances: np.ndarray, score: float) -> list[tuple[int, int, int, int]]:
    """``(class, pivot, band, distance to the pivot)`` of all cells that may hold strings of
    at least that score to one of that length."""
    if score > 1:
        return []
    low = max(1, math.ceil(length * score / (2 - score) - _EPS))
    high = math.floor(length * (2 - score) / score + _EPS)
    out = []
    nearest = int(distances.min())
    for c in range(int(_class(low)), int(_class(high)) + 1):
        r = math.floor((length + min(high, _longest(c))) * (1 - score) + _EPS)
        width = _band_width(c)
        for pivot in np.flatnonzero(distances <= nearest + 2 * r).tolist():
            d = int(distances[pivot])
            out += [(c, pivot, band, d) for band in range(max(0, d - r) // width, (d + r) // width + 1)]
    return out


_CELL = ["place", "class", "pivot", "band"]
_REACH = "place STRING, text STRING, class INT, pivot INT, band INT, d INT, least DOUBLE"


def _reach_rows(rows: list[tuple]) -> pa.Table:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=_names(_REACH))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _reaching(left: DataFrame, threshold: float) -> DataFrame:
    """Left strings, one row for each cell in reach of the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for place, text, packed in zip(*(batch.column(c).to_pylist() for c in ("place", "text", "distances"))):
                distances = np.frombuffer(packed, dtype=np.int32)
                rows += [(place, text, *cell, threshold) for cell in reached(len(text), distances, threshold)]
            yield from _reach_rows(rows).to_batches()

    return left.mapInArrow(run, _REACH)


class _Block:
    """Right strings of one cell, in the order of their distance to its pivot."""

    def __init__(self, texts: list[str], d: np.ndarray) -> None:
        order = np.argsort(d, kind="stable")
        self.order, self.d = order, d[order]
        self.texts = [texts[i] for i in order.tolist()]
        self.length, self.letters, self.pairs = _profile(self.texts)
        self.longest = int(self.length.max())
        self.matchers: dict[int, SequenceMatcher] = {}

    def near(self, text: str, d: int, least: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows that may score at least ``least``, the most that each can score, and how many
        rows were looked at: those whose distance to the pivot is near enough."""
        n = len(text)
        r = math.floor((n + self.longest) * (1 - least) + _EPS)
        low, high = np.searchsorted(self.d, [d - r, d + r + 1])
        if low == high:
            return np.empty(0, dtype=np.int64), np.empty(0), 0
        _, letters, pairs = _profile([text])
        total = n + self.length[low:high]
        most = np.minimum(self.letters[low:high], letters).sum(axis=1)
        # 3M - S - 1 bigrams are shared at least.
        most = np.minimum(most, (np.minimum(self.pairs[low:high], pairs).sum(axis=1) + total + 1) // 3)
        most = np.minimum(most, np.minimum(self.length[low:high], n))
        bound = 2 * most / total
        rows = np.flatnonzero(bound >= least - _EPS)
        return rows + low, bound[rows], int(high - low)

    def score(self, text: str, row: int) -> float:
        matcher = self.matchers.get(row)
        if matcher is None:
            # It prepares its second string once for all first ones.
            matcher = self.matchers[row] = SequenceMatcher(None, "", self.texts[row])
        matcher.set_seq1(text)
        return matcher.ratio()


def _best(block: _Block, entries: list[list[dict]], text: str, d: int, least: float, k: int) -> list[tuple[dict, float]]:
    """Entries of the best scores of at least ``least``: the best ``k`` after rounding are
    among them, ties in the order of the entries."""
    rows, bounds, _ = block.near(text, d, least)
    found: dict[tuple, tuple[float, dict]] = {}
    kth = least
    for i in np.argsort(-bounds, kind="stable").tolist():
        if bounds[i] < kth - _ROUNDING:
            break
        score = block.score(text, int(rows[i]))
        if score < least:
            continue
        for entry in entries[int(block.order[rows[i]])]:
            name = (entry["canonical"], entry["group"])
            if name not in found or found[name][0] < score:
                found[name] = (score, entry)
        if len(found) >= k:
            kth = max(least, sorted((s for s, _ in found.values()), reverse=True)[k - 1])
    out, same = [], {}
    for name, (score, entry) in sorted(found.items()):
        # Of equal scores only the first k entries can be among the best k.
        same[score] = same.get(score, 0) + 1
        if score >= kth - _ROUNDING and same[score] <= k:
            out.append((entry, score))
    return out


def _sides(left: DataFrame, right: DataFrame, within: str | None) -> tuple[DataFrame, DataFrame]:
    place = [F.col(within).cast("string").alias("place")] if within else [F.lit("").alias("place")]

    def side(df: DataFrame) -> DataFrame:
        kept = [c for c in ("entries",) if c in df.columns]
        found = df.select(*place, "text", *kept).filter((F.col("text") != "") & F.col("place").isNotNull())
        return found if kept else found.distinct()

    return side(left), side(right)


def _indexed(right: DataFrame, pivots: DataFrame) -> DataFrame:
    """Right strings in their cells, with the blocks of a cell and their own."""
    cell = Window.partitionBy(*_CELL)
    placed = shared(_placed(right, pivots), *_CELL).drop("distances")
    counted = placed.withColumn("blocks", F.ceil(F.count(F.lit(1)).over(cell) / BLOCK).cast("int"))
    return counted.withColumn("block", _block())


def _block() -> Column:
    return F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int")


def _sizes(right: DataFrame) -> DataFrame:
    return right.groupBy(*_CELL).agg(F.first("blocks").alias("blocks"))


def _meet(reach: DataFrame, right: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of the rows of every block and of the left strings that reach its cell."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    keys = [*_CELL, "block"]
    asked = reach.join(_sizes(right), _CELL).select(*_names(_REACH), every)
    return asked.groupBy(*keys).cogroup(right.drop("blocks").groupBy(*keys)).applyInArrow(function, schema)


def _from(table: pa.Table) -> _Block:
    return _Block(table.column("text").to_pylist(), table.column("d").to_numpy())


def similar_pairs(
    left: DataFrame, right: DataFrame, threshold: float = K.SIMILARITY_REVIEW, within: str | None = None
) -> DataFrame:
    """Rows ``(a, b, score)`` with score at or over the threshold, unrounded.

    Both inputs have a column ``text``; repeats count once and blanks have no pairs. If
    both also have a column ``within``, only strings of equal values there are compared:
    a caller who knows places or other blocks gives it, nothing is assumed by default.
    """
    a, b = _sides(left, right, within)
    pivots = _pivots(b)
    reach = _reaching(_placed(a, pivots), threshold)

    def compare(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and held.num_rows:
            block = _from(held)
            for text, d in zip(asked.column("text").to_pylist(), asked.column("d").to_pylist()):
                for row in block.near(text, d, threshold)[0].tolist():
                    score = block.score(text, row)
                    if score >= threshold:
                        found.append((text, block.texts[row], score))
        kinds = (pa.string(), pa.string(), pa.float64())
        return pa.Table.from_arrays([pa.array([p[k] for p in found], kind) for k, kind in enumerate(kinds)], names=["a", "b", "score"])

    found = _meet(reach, _indexed(b, pivots), compare, "a STRING, b STRING, score DOUBLE")
    # A pair may be similar in several places.
    return found.distinct() if within else found


def _narrowed(left: DataFrame, right: DataFrame, threshold: float, k: int) -> DataFrame:
    """Left strings, one row for each cell in reach of the ``k``-th best score that their own
    cell has for them, or of the threshold."""

    def look(asked: pa.Table, held: pa.Table) -> pa.Table:
        rows = []
        block = _from(held) if held.num_rows else None
        entries = held.column("entries").to_pylist() if block else []
        for place, text, d, packed in zip(*(asked.column(c).to_pylist() for c in ("place", "text", "d", "distances"))):
            best = _best(block, entries, text, d, threshold, k) if block else []
            scores = sorted((s for _, s in best), reverse=True)
            least = max(threshold, scores[k - 1] - _ROUNDING) if len(scores) >= k else threshold
            rows += [(place, text, *cell, least) for cell in reached(len(text), np.frombuffer(packed, dtype=np.int32), least)]
        return _reach_rows(rows)

    keys = [*_CELL, "block"]
    own = left.join(_sizes(right), _CELL, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    asked = own.withColumn("block", _block()).drop("blocks")
    return asked.groupBy(*keys).cogroup(right.drop("blocks").groupBy(*keys)).applyInArrow(look, _REACH)


def best_entries(left: DataFrame, right: DataFrame, threshold: float, k: int, within: str | None = None) -> DataFrame:
    """Rows ``(a, canonical, group, score)``, unrounded: for each left ``text``, entries that
    include its best ``k`` by score rounded to 3 digits, canonical and group.

    ``right`` has distinct ``text`` and ``entries``, an array of ``(canonical, group)``; an
    entry's score is the best of its texts, and at or over the threshold.
    """
    a, b = _sides(left, right, within)
    b = shared(b, "text")
    pivots = _pivots(b)
    b = _indexed(b, pivots)

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and held.num_rows:
            block, entries = _from(held), held.column("entries").to_pylist()
            for text, d, least in zip(*(asked.column(c).to_pylist() for c in ("text", "d", "least"))):
                found += [(text, e["canonical"], e["group"], s) for e, s in _best(block, entries, text, d, least, k) if s >= threshold]
        kinds = (pa.string(), pa.string(), pa.string(), pa.float64())
        return pa.Table.from_arrays([pa.array([p[i] for p in found], kind) for i, kind in enumerate(kinds)], names=["a", "canonical", "group", "score"])

    reach = _narrowed(_placed(a, pivots), b, threshold, k)
    return _meet(reach, b, search, "a STRING, canonical STRING, `group` STRING, score DOUBLE")


def pairs_looked_at(left: DataFrame, right: DataFrame, threshold: float, k: int) -> DataFrame:
    """One row ``(possible, looked_at)``: all pairs of both sides, and those of them that
    ``best_entries`` holds against each other, in a string's own cell and in its reach."""
    a, b = _sides(left, right, None)
    pivots = _pivots(b)
    placed, b = shared(_placed(a, pivots), *_CELL), _indexed(b, pivots)

    def count(asked: pa.Table, held: pa.Table) -> pa.Table:
        looked = 0
        if asked.num_rows and held.num_rows:
            block = _from(held)
            for text, d, least in zip(*(asked.column(c).to_pylist() for c in ("text", "d", "least"))):
                looked += block.near(text, d, least)[2]
        return pa.Table.from_arrays([pa.array([looked], pa.int64())], names=["looked_at"])

    home = placed.select("place", "text", "class", "pivot", "band", "d", F.lit(float(threshold)).alias("least"))
    met = _meet(home, b, count, "looked_at BIGINT").union(_meet(_narrowed(placed, b, threshold, k), b, count, "looked_at BIGINT"))
    one = F.lit(1).alias("one")
    possible = a.agg(F.count(F.lit(1)).alias("n")).select(one, "n").join(b.agg(F.count(F.lit(1)).alias("m")).select(one, "m"), "one")
    looked = met.agg(F.coalesce(F.sum("looked_at"), F.lit(0)).alias("looked_at")).select(one, "looked_at")
    return possible.join(looked, "one").select((F.col("n") * F.col("m")).alias("possible"), "looked_at")
