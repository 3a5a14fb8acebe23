"""Periodic runs of words, found on a grammar.

A run is a stretch of words in which words ``q`` apart are identical, ``q`` being its least
period, and that no neighbouring word extends. Each text is compressed by Re-Pair: the
commonest pair of neighbouring symbols becomes a rule until no pair repeats; what is left,
the start string, is split in halves. A run that lies inside the expansion of a rule and in
neither of its two parts crosses the boundary between them, so runs are sought there, once
for each rule: for every distance at which the word at the boundary comes again, the
common extensions in both directions tell the run. What a rule has is then translated to
all places where the derivation uses it, and only intervals that no neighbour extends stay.

A run of at least ``LEAST`` words and ``TIMES`` periods repeats each of its stretches of
``LEAST // TIMES`` words at the distance of its period. So only where all such stretches
come again in their text can there be a run, and the grammar is built for those parts; a
rule of a grammar for the whole text would expand to repeated words just the same.

A text is one value of one row, so its grammar is built in one task; texts are dealt over
tasks as they are stored, and nothing is shuffled.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, types as T

from tallyweave.llm.common import map_batches
from tallyweave.llm.hashing import Words, mix
from tallyweave.llm.pretokens import spans

LEAST, TIMES = 24, 3
BATCH = 700_000
# Pairs of a rule and a distance that are looked at in one go.
PAIRS = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)


def repair(symbols: list[int], first_rule: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Start string and rules; rule ``k`` is the symbol ``first_rule + k``.

    Takes the commonest pair first, of equally common ones that which came up first, which
    keeps the grammar shallow.
    """
    n = len(symbols)
    symbol = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i in range(n - 1):
        places[symbol[i], symbol[i + 1]].append(i)
    queue = [(-len(p), k, pair) for k, (pair, p) in enumerate(places.items()) if len(p) > 1]
    heapq.heapify(queue)
    turn = len(places)
    rules: list[tuple[int, int]] = []
    while queue:
        count, _, pair = heapq.heappop(queue)
        a, b = pair
        found, end = [], -1
        for i in sorted(set(places.pop(pair, ()))):
            # Entries whose symbols have changed since are stale; overlapping pairs count once.
            if i != end and symbol[i] == a and after[i] < n and symbol[after[i]] == b:
                found.append(i)
                end = after[i]
        if len(found) < 2:
            continue
        if len(found) < -count:
            # Fewer than it was filed with: another pair may be commoner by now.
            places[pair] = found
            heapq.heappush(queue, (-len(found), turn, pair))
            turn += 1
            continue
        new = first_rule + len(rules)
        rules.append(pair)
        fresh = set()
        for i in found:
            j = after[i]
            right, left = after[j], before[i]
            symbol[i], symbol[j] = new, -1
            after[i] = right
            if right < n:
                before[right] = i
                places[new, symbol[right]].append(i)
                fresh.add((new, symbol[right]))
            if left >= 0:
                places[symbol[left], new].append(left)
                fresh.add((symbol[left], new))
        for p in sorted(fresh):
            if len(places[p]) > 1:
                heapq.heappush(queue, (-len(places[p]), turn, p))
                turn += 1
    start, i = [], 0
    while i < n:
        start.append(symbol[i])
        i = after[i]
    return start, rules


def nodes(start: list[int], rules: list[tuple[int, int]], first_rule: int, least: int) -> list[tuple[int, int, int, list[int]]]:
    """``(length, length of the left part, first place, all places)`` of every rule, and of
    every half of the start string, that expands to at least ``least`` words."""
    length: list[int] = []

    def size(s: int) -> int:
        return length[s - first_rule] if s >= first_rule else 1

    for a, b in rules:
        length.append(size(a) + size(b))
    at = [0]
    for s in start:
        at.append(at[-1] + size(s))
    out = []
    used: list[list[int]] = [[] for _ in rules]
    halves = [(0, len(start))]
    while halves:
        low, high = halves.pop()
        whole = at[high] - at[low]
        if whole < least:
            continue
        if high - low == 1:
            used[start[low] - first_rule].append(at[low])
            continue
        middle = (low + high) // 2
        out.append((whole, at[middle] - at[low], at[low], [at[low]]))
        halves += [(low, middle), (middle, high)]
    # A rule is used by later rules only, so its places are known when its turn comes.
    for k in range(len(rules) - 1, -1, -1):
        if not used[k] or length[k] < least:
            continue
        a, b = rules[k]
        out.append((length[k], size(a), used[k][0], used[k]))
        for part, offset in ((a, 0), (b, size(a))):
            if part >= first_rule and size(part) >= least:
                used[part - first_rule] += [p + offset for p in used[k]]
    return out


class _Extensions:
    """How far equal words go on from two places, by hashes of spans."""

    def __init__(self, items: np.ndarray) -> None:
        n = len(items)
        factors = np.full(n + 1, _BASE, dtype=np.uint64)
        factors[0] = 1
        self.power = np.cumprod(factors, dtype=np.uint64)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(items.astype(np.uint64) + _BASE) * self.power[:n], out=self.sums[1:])

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        s = self.sums
        return (s[a + size] - s[a]) * self.power[b - a] == s[b + size] - s[b]

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from ``a`` and ``b`` on, ``a`` before ``b``; never too few of them."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            good = self._equal(a, b, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def back(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words before ``a`` and ``b``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            good = self._equal(a - middle, b - middle, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def _exact(items: np.ndarray, a: int, b: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around ``a`` in which words ``b - a`` apart are equal, by comparing them."""
    ahead = items[a : high - (b - a)] != items[b:high]
    back = (items[low:a] != items[low + b - a : b])[::-1]
    return a - (int(back.argmax()) if back.any() else len(back)), b + (int(ahead.argmax()) if ahead.any() else len(ahead))


def crossing_runs(items: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray, least: int, times: int) -> tuple[np.ndarray, ...]:
    """``(node, start, end, period)`` of runs inside ``low`` to ``high`` that hold the places
    on both sides of ``middle``; the least period of each."""
    n = len(items)
    order = np.argsort(items, kind="stable")
    rank = items[order] * (n + 1) + order
    extend = _Extensions(items)
    longest = (high - low) // times
    found: list[tuple[np.ndarray, ...]] = []
    for right in (True, False):
        # One whole period lies on the right side of the boundary, or one on the left.
        anchor = middle - 1 if right else middle
        most = np.minimum(longest, high - middle if right else middle - low)
        here = items[anchor] * (n + 1)
        first = np.searchsorted(rank, here + (anchor + 1 if right else anchor - most))
        last = np.searchsorted(rank, here + (anchor + most + 1 if right else anchor))
        counts = last - first
        cuts = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, int(counts.sum()) + PAIRS, PAIRS))
        for x, y in zip([0, *(cuts[:-1] + 1).tolist()], (cuts + 1).tolist()):
            part = slice(x, min(y, len(counts)))
            node = np.repeat(np.arange(part.start, part.stop), counts[part])
            other = order[spans(first[part], counts[part])]
            if not len(node):
                continue
            period = np.abs(other - anchor[node])
            a = middle[node] if right else middle[node] - period
            b = a + period
            ahead = extend.ahead(a, b, high[node] - b)
            back = extend.back(a, b, a - low[node])
            size = ahead + back + period
            good = (size >= np.maximum(least, times * period)) & (a - back < middle[node]) & (b + ahead > middle[node])
            found.append(tuple(v[good] for v in (node, a - back, b + ahead, period, a)))
    if not found:
        return (np.empty(0, dtype=np.int64),) * 4
    node, start, end, period, a = (np.concatenate(v) for v in zip(*found))
    least_ = _least_periods(node, start, end, period)
    # Hashes may only have said too much; where they did, words decide for the whole node.
    wrong = {k for k, s, e, q in zip(*(v.tolist() for v in least_)) if (items[s : e - q] != items[s + q : e]).any()}
    if not wrong:
        return least_
    for i in np.flatnonzero(np.isin(node, list(wrong))).tolist():
        k, q = node[i], int(period[i])
        start[i], end[i] = _exact(items, int(a[i]), int(a[i]) + q, int(low[k]), int(high[k]))
    good = (end - start >= np.maximum(least, times * period)) & (start < middle[node]) & (end > middle[node])
    return _least_periods(*(v[good] for v in (node, start, end, period)))


def _least_periods(node: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((period, end, start, node))
    node, start, end, period = (v[order] for v in (node, start, end, period))
    new = np.ones(len(node), dtype=bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return tuple(v[new] for v in (node, start, end, period))


def repeating_parts(codes: np.ndarray, at: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of texts, of ``least`` words or more, of which every
    stretch of ``least // times`` words comes again in its text."""
    size = max(1, least // times)
    n = len(codes) - size + 1
    none = np.empty(0, dtype=np.int64)
    if n <= 0:
        return none, none
    key = np.zeros(n, dtype=np.uint64)
    mixed = mix(codes.astype(np.uint64) + _BASE)
    for k in range(size):
        key = key * _BASE + mixed[k : k + n]
    text = np.searchsorted(at, np.arange(n), side="right") - 1
    inside = np.arange(n) + size <= at[text + 1]
    key = mix(key ^ mix(text.astype(np.uint64)))
    # Most stretches occur once; a table of counts leaves few to sort.
    slot = (key >> np.uint64(64 - 20)).astype(np.int64)
    maybe = np.flatnonzero(inside & (np.bincount(slot[inside], minlength=1 << 20)[slot] > 1))
    order = maybe[np.argsort(key[maybe], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(n + 1, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.diff(np.concatenate([[0], again.astype(np.int8)]))
    # A part ends with its text, whatever comes behind it.
    starts = np.flatnonzero(again[:-1] & ((edge[:-1] == 1) | np.isin(np.arange(n), at)))
    ends_of = np.flatnonzero(again[:-1] & (~again[1:] | np.isin(np.arange(1, n + 1), at)))
    long = ends_of - starts + size >= least
    return starts[long], ends_of[long] + size


def find_runs(codes: np.ndarray, at: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of all runs of the texts ``at`` in ``codes``, sorted by start,
    then period; places in ``codes``."""
    none = np.empty(0, dtype=np.int64)
    starts, ends = repeating_parts(codes, at, least, times)
    if not len(starts):
        return none, none, none
    # All parts after each other, each between marks that equal nothing else.
    size = ends - starts
    marks = np.concatenate([[0], np.cumsum(size + 1)])
    many = int(codes.max()) + 1
    items = many + np.arange(marks[-1] + 1)
    begin = marks[:-1] + 1
    items[spans(begin, size)] = codes[spans(starts, size)]
    first_rule = int(items.max()) + 1
    low, middle, high, used = [], [], [], []
    for b, n in zip(begin.tolist(), size.tolist()):
        text = items[b : b + n].tolist()
        for whole, left, place, places in nodes(*repair(text, first_rule), first_rule, least):
            low.append(b + place)
            middle.append(b + place + left)
            high.append(b + place + whole)
            used.append(np.array(places, dtype=np.int64) - place)
    if not low:
        return none, none, none
    node, s, e, q = crossing_runs(items, *(np.array(v, dtype=np.int64) for v in (low, middle, high)), least, times)
    if not len(node):
        return none, none, none
    # To all places of the derivation, where neither neighbour extends the run.
    times_used = np.array([len(u) for u in used], dtype=np.int64)
    shift = np.concatenate(used)[spans((np.cumsum(times_used) - times_used)[node], times_used[node])]
    s, e, q = (np.repeat(v, times_used[node]) for v in (s, e, q))
    s, e = s + shift, e + shift
    whole = (items[s - 1] != items[s - 1 + q]) & (items[e] != items[e - q])
    _, s, e, q = _least_periods(np.zeros(int(whole.sum()), dtype=np.int64), s[whole], e[whole], q[whole])
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    part = np.searchsorted(begin, s, side="right") - 1
    back = starts[part] - begin[part]
    return s + back, e + back, q


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]), False)


def collapse(df: DataFrame, text: str = "text", runs: str = "runs", into: str = "collapsed", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Adds the runs of each whole ``text``, and the text without their repeats.

    ``runs`` is an array of ``(start, length, period)`` by start, then period, in words
    numbered from 0; words are what blanks and the control characters 9 to 13 separate. A
    run has at least ``least`` words and ``times`` (3 or more) of its least period.
    ``into`` holds the words, joined by one blank, that no run contains after its first
    ``period`` words. Null, empty and short texts have no runs; a null text collapses to an
    empty one. Rows are judged one by one: repeated rows and null keys change nothing, and
    columns named ``runs`` or ``into`` are replaced.
    """
    if times < 3 or least < times:
        raise ValueError("a run has at least three periods, and a word in each")
    kept = df.drop(runs, into)
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField(runs, RUNS, False), T.StructField(into, T.StringType(), False)])
    arrow = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column(text))
        codes, _ = words.codes()
        start, end, period = find_runs(codes, words.at, least, times)
        keep = np.ones(len(codes) + 1, dtype=np.int64)
        if len(start):
            edges = np.zeros(len(codes) + 1, dtype=np.int64)
            np.add.at(edges, start + period, 1)
            np.add.at(edges, end, -1)
            keep = (np.cumsum(edges) == 0).astype(np.int64)
        of = np.searchsorted(words.at, start, side="right") - 1
        found = pa.StructArray.from_arrays([pa.array(x) for x in (start - words.at[of], end - start, period)], names=["start", "length", "period"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(batch)))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), found).cast(arrow)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), lists, _joined(words, keep[:-1].astype(bool))], names=[*names, runs, into]
        )

    return map_batches(kept, schema, run, BATCH)


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    values = words.values().filter(pa.array(keep))
    counts = np.concatenate([[0], np.cumsum(keep)])[words.at]
    lists = pa.LargeListArray.from_arrays(pa.array(counts.astype(np.int64)), values)
    joined = pa.compute.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
    return joined.cast(pa.large_string()).cast(pa.string())
