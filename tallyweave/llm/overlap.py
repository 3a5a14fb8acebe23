"""Jaccard join of n-gram sets by T-occurrence search.

Two sets that are similar enough share so many n-grams that one has at least ``T`` of the
other's. A query merges the short inverted lists of its n-grams with a heap and probes the
long ones by binary search (DivideSkip): with ``L`` lists set aside, whoever is not in
``T - L`` of the others cannot reach ``T``. What reaches it and is similar is a link.

Lists are held where they are needed. By the same count, similar sets also share one of
the first n-grams of both, in any one order of all n-grams; here frequent ones come last,
others by their hash. All sets that have an n-gram so early form a list of it, and go to
the cell of the list's least set, among sets of compatible sizes; most lists of one group
of similar sets have the same least set, so a set goes to few cells. The smaller of two
similar sets has the n-gram even earlier, so a list without one that early needs no cell.
In a cell, sets whose bit signatures differ in more places than similar sets can are turned
away; parts of the rest that signatures connect are searched once, however many cells have
them, in blocks of bounded size. Equal sets are one class from the start.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tallyweave.llm import bits
from tallyweave.llm.common import ROWS_HANDED, give_back_memory, in_small_batches, map_batches, written
from tallyweave.llm.components import components
from tallyweave.llm.hashing import Words, chained, mix, new_key, window_starts
from tallyweave.llm.pretokens import spans

# Texts beyond which an n-gram counts as frequent, and how many of those are kept at most
# (2 MB); which n-grams these are changes the work, never the links.
FREQUENT, MOST_FREQUENT = 300, 1 << 18
# Sets that are searched at once, and rows of a task that takes several small cells.
BLOCK, TASK_ROWS = 1_000, 4_000
# Least and greatest bits of a signature.
SIGNATURE = (256, 1 << 16)
# Entries of the short lists beyond which all lists of a query are counted at once.
HEAP = 2_000
BATCH = 700_000
# Entries that a task packs at once, and entries of one range of hashes, about.
RUN, RANGE = 2_000_000, 600_000
# What a set is to a list: its n-gram comes early enough for the smaller of two similar
# sets, and the list is of its own class of sizes.
EARLY, OWN = 1, 2


def gram_sets(column: pa.Array, size: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` words, one text after the other,
    and where each text's begin.

    A-Z is lower-cased. A text of fewer words has one run of all its words.
    """
    words = Words(column, lower=True)
    values = words.hashes(key)
    start, counts = window_starts(words.at, size)
    hashes = chained(values, start, size)
    short = np.flatnonzero((counts == 0) & (words.counts() > 0))
    text = np.concatenate([np.repeat(np.arange(len(column)), counts), short])
    hashes = np.concatenate([hashes, chained(values, words.at[short], size - 1, words.counts()[short])])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(column) + 1))


def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """N-grams of a set that any similar set shares at least."""
    return -(-sizes * percent // 100)


def least_overlap_of_smaller(sizes: np.ndarray, percent: int) -> np.ndarray:
    """N-grams that a set shares at least with any similar set of its size or a greater one."""
    return -(-2 * sizes * percent // (100 + percent))


def signature_room(percent: int) -> float:
    """Bits for an n-gram with which signatures of sets that share nothing differ in half as
    many places again as those of similar sets may; 2 at most."""
    apart = 2 * (100 - percent) / (100 + percent)
    return next((room for room in (0.5, 1.0) if room / 2 * -np.expm1(-4 / room) >= 1.5 * apart), 2.0)


def signature(grams: np.ndarray, room: float = 2.0) -> bytes:
    """Bits, ``room`` or more for an n-gram, of which each n-gram turns one over: two signatures
    of one length differ in at most as many places as the sets have n-grams of their own."""
    size = int(np.clip(1 << (int(np.ceil(room * len(grams))) - 1).bit_length(), *SIGNATURE))
    odd = np.bincount((mix(grams) >> np.uint64(48)).astype(np.int64) % size, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(signatures: list[bytes]) -> np.ndarray:
    """All signatures folded to the least of their lengths, as rows of 64-bit numbers."""
    least = min(map(len, signatures))
    rows = [np.bitwise_xor.reduce(np.frombuffer(s, dtype=np.uint64).reshape(-1, least // 8), axis=0) for s in signatures]
    return np.stack(rows)


def _may_be_similar(sizes: np.ndarray, signatures: list[bytes], percent: int) -> np.ndarray:
    """For each two sets whether they differ and may be similar, by sizes and signatures."""
    out = np.zeros((len(sizes), len(sizes)), dtype=bool)
    folded = _folded(signatures)
    width = max(1, 2_000_000 // max(1, folded.size))
    for low in range(0, len(sizes), width):
        a, b = sizes[low : low + width, None], sizes[None, :]
        apart = np.bitwise_count(folded[low : low + width, None, :] ^ folded[None, :, :]).sum(axis=2, dtype=np.int64)
        # 100 I >= percent U, with U + I the sum of sizes and U - I what only one has.
        good = apart * (100 + percent) <= (a + b) * (100 - percent)
        out[low : low + width] = good & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
    np.fill_diagonal(out, False)
    return out


def with_a_partner(sizes: np.ndarray, signatures: list[bytes], percent: int) -> np.ndarray:
    """Which sets may be similar to another one, by sizes and signatures."""
    return _may_be_similar(sizes, signatures, percent).any(axis=1)


def parts(sizes: np.ndarray, signatures: list[bytes], percent: int) -> list[np.ndarray]:
    """The sets that may be similar to another one, in parts: none may be similar to a set of
    another part."""
    good = _may_be_similar(sizes, signatures, percent)
    used = np.flatnonzero(good.any(axis=1))
    if not len(used):
        return []
    good = good[np.ix_(used, used)]
    label = np.arange(len(used))
    while True:
        least = np.minimum(label, np.where(good, label, len(used)).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    order = np.argsort(label, kind="stable")
    return np.split(used[order], np.flatnonzero(np.diff(label[order])) + 1)


class Index:
    """Inverted lists over sets; a list holds the numbers of the sets that have an n-gram."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        grams = np.concatenate(sets)
        own = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((own, grams))
        self.grams, self.first, list_of, self.length = np.unique(grams[order], return_index=True, return_inverse=True, return_counts=True)
        self.members = own[order]
        # Sorted pairs of list and member, for binary probes.
        self.pairs = list_of * len(sets) + self.members

    def overlap(self, lists: np.ndarray, member: int) -> int:
        """In how many of the lists the member is, by binary search."""
        probes = lists * len(self.sets) + member
        at = np.minimum(np.searchsorted(self.pairs, probes), len(self.pairs) - 1)
        return int((self.pairs[at] == probes).sum())

    def similar(self, query: np.ndarray, percent: int, open_: np.ndarray, connected: np.ndarray) -> list[int]:
        """Members among ``open_`` similar to the query, one of each part that ``connected``
        numbers alike.

        ``L`` is chosen by what it costs, as DivideSkip does: where even the short lists are
        long, no list is set aside, and all of them are merged by counting.
        """
        a = len(query)
        least = int(least_overlap(np.int64(a), percent))
        at = np.minimum(np.searchsorted(self.grams, query), len(self.grams) - 1)
        lists = at[self.grams[at] == query]
        if len(lists) < least:
            return []
        open_ = open_ & (100 * np.minimum(self.sizes, a) >= percent * np.maximum(self.sizes, a))
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        # T - L: how many of the short lists a member must be in.
        few = 1 + least // 16
        short, long = lists[: len(lists) - least + few], lists[len(lists) - least + few :]
        if int(self.length[short].sum()) > HEAP:
            shared = np.bincount(self.members[spans(self.first[lists], self.length[lists])], minlength=len(self.sets))
            good = np.flatnonzero(open_ & (100 * shared >= percent * (a + self.sizes - shared)))
            return good[np.unique(connected[good], return_index=True)[1]].tolist()
        place = spans(self.first[short], self.length[short])
        of = np.repeat(np.arange(len(short)), self.length[short])
        held = open_[self.members[place]]
        place, of = place[held], of[held]
        runs = [r.tolist() for r in np.split(self.members[place], np.flatnonzero(np.diff(of)) + 1)] if len(place) else []
        found, done = [], set()
        for member, seen in groupby(heapq.merge(*runs)):
            shared = sum(1 for _ in seen)
            if shared < few or connected[member] in done:
                continue
            shared += self.overlap(long, member)
            if 100 * shared >= percent * (a + int(self.sizes[member]) - shared):
                found.append(member)
                done.add(connected[member])
        return found


def search(nodes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets ``left`` and ``right`` that connect all that are connected there."""
    index = Index([sets[i] for i in right])
    node = nodes[right]
    same = left is right
    label = {int(n): int(n) for n in np.concatenate([nodes[left], node])}

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    connected = node.copy()
    out = []
    for k, i in enumerate(left.tolist()):
        mine = root(int(nodes[i]))
        open_ = connected != mine
        if same:
            open_[k:] = False
        if not open_.any():
            continue
        for member in index.similar(sets[i], percent, open_, connected):
            a, b = root(int(nodes[i])), root(int(node[member]))
            if a != b:
                label[max(a, b)] = min(a, b)
                connected[(connected == a) | (connected == b)] = min(a, b)
                out.append((int(nodes[i]), int(node[member])))
    return out


def _set_rows(source: DataFrame, size: int, percent: int, secret: int) -> DataFrame:
    """Rows ``(d, h, n_shingles, set_id, number, signature)``; the last three null without words."""
    room = signature_room(percent)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, at = gram_sets(batch.column("text"), size, secret)
        sets = [grams[a:b] for a, b in zip(at, at[1:])]
        ids = [_set_id(s) if len(s) else None for s in sets]
        signs = [signature(s, room) if len(s) else None for s in sets]
        numbers = [_number(i) if i else None for i in ids]
        columns = [pa.array(np.diff(at)), pa.array(ids, pa.binary()), pa.array(numbers, pa.int64()), pa.array(signs, pa.binary())]
        names = ["d", "h", "n_shingles", "set_id", "number", "signature"]
        return pa.RecordBatch.from_arrays([batch.column("d"), batch.column("h"), *columns], names=names)

    return map_batches(source, "d BIGINT, h BIGINT, n_shingles BIGINT, set_id BINARY, number BIGINT, signature BINARY", run, BATCH)


def _short(hashes: np.ndarray) -> np.ndarray:
    """The first bits of hashes that are spread over all of them."""
    return hashes >> np.uint64(64 - bits.HASH_BITS)


class _Prefixes:
    """First n-grams of each text's set, ``frequent`` ones (as ``_often`` gives them, sorted) behind
    the others.

    ``text`` has their texts, ``early`` whether they are among the first ones of the smaller
    of two similar sets; ``sizes`` and ``sets`` are of all texts.
    """

    def __init__(self, column: pa.Array, size: int, percent: int, secret: int, frequent: np.ndarray) -> None:
        grams, at = gram_sets(column, size, secret)
        self.sizes = np.diff(at)
        self.sets = [grams[a:b] for a, b in zip(at, at[1:])]
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(grams)) - at[text]
        if len(frequent):
            # Within a text by hash already.
            short = mix(_short(mix(grams)))
            late = frequent[np.minimum(np.searchsorted(frequent, short), len(frequent) - 1)] == short
            grams = grams[np.lexsort((late, text))]
        first = place <= (self.sizes - least_overlap(self.sizes, percent))[text]
        self.grams, self.text = grams[first], text[first]
        self.early = (place <= (self.sizes - least_overlap_of_smaller(self.sizes, percent))[text])[first]

    def entries(self, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lists, their classes of sizes, the texts, and what these are to the lists."""
        # Similar sets are in one class of sizes or in neighbouring ones.
        step = np.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0
        kind = np.floor(np.log(np.maximum(self.sizes, 1)) / step).astype(np.int64)[self.text]
        early = self.early
        role = np.concatenate([np.where(early, EARLY | OWN, OWN), np.full(int(early.sum()), EARLY)]).astype(np.int8)
        kind = np.concatenate([kind, kind[early] + 1])
        grams = np.concatenate([self.grams, self.grams[early]])
        return mix(grams ^ mix(kind.astype(np.uint64))), kind, np.concatenate([self.text, self.text[early]]), role


def _set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _number(set_id: bytes) -> int:
    """64 bits of a set's id; sets that share them by chance go to the cells of both."""
    return int.from_bytes(set_id[:8], "little", signed=True)


def _often(source: DataFrame, emit: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], ranges: int, least: int, roles: int) -> DataFrame:
    """Rows ``(h, n)``: the short hashes, mixed, that ``emit`` gives ``least`` times or more, and
    under each of the ``roles`` at least once.

    Tasks pack them as sorted runs, a few bytes for each, which are merged by range.
    """
    source.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_HANDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            hashes, role = (np.concatenate(x) for x in zip(*held))
            held.clear()
            for r in np.unique(role).tolist():
                values, n = np.unique(hashes[role == r], return_counts=True)
                here, first = np.unique((values * np.uint64(ranges) >> np.uint64(bits.HASH_BITS)).astype(np.int64), return_index=True)
                edges = [*first.tolist(), len(values)]
                runs = [bits.packed(values[a:b], n[a:b]) for a, b in zip(edges, edges[1:])]
                columns = [pa.array(here), pa.array([r] * len(here), pa.int32()), pa.array(runs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "role", "run"])

        for batch in in_small_batches(batches, BATCH):
            held.append(emit(batch))
            if sum(len(x) for x, _ in held) > RUN:
                yield from flush()
        if held:
            yield from flush()
        give_back_memory()

    def merge(table: pa.Table) -> pa.Table:
        found = [bits.unpacked(r) for r in table.column("run").to_pylist()]
        values, counts = (np.concatenate(x) for x in zip(*found))
        role = np.repeat(table.column("role").to_numpy(), [len(x) for x, _ in found])
        order = np.argsort(values, kind="stable")
        values = values[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        n = np.add.reduceat(counts[order].astype(np.int64), first)
        good = (n >= least) & (np.bitwise_or.reduceat(role[order], first) & roles == roles)
        return pa.Table.from_arrays([pa.array(x) for x in (mix(values[first][good]).view(np.int64), n[good])], names=["h", "n"])

    return source.mapInArrow(run, "range BIGINT, role INT, run BINARY").groupBy("range").applyInArrow(merge, "h BIGINT, n BIGINT")


def memberships(source: DataFrame, classes: DataFrame, size: int, percent: int, secret: int) -> DataFrame:
    """Rows ``(cell, number)``: the cells of sets, told by 64 bits of their id. Similar sets
    that differ share a cell."""
    spark = source.sparkSession
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = 1 + total * (100 - percent) // 100 // RANGE
    # Of equal sets, one text is enough; a few others may pass.
    one = spark.sparkContext.broadcast(bits.table(classes.select(F.xxhash64("node", "h").alias("w"))))
    texts = source.select(F.xxhash64("d", "h").alias("w"), "text")

    def prefixes(batch: pa.RecordBatch, frequent: np.ndarray) -> _Prefixes:
        may = bits.may_hold(one.value, batch.column("w").to_numpy().view(np.uint64))
        return _Prefixes(batch.column("text").filter(pa.array(may)), size, percent, secret, frequent)

    def first_grams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        grams = _short(mix(prefixes(batch, np.empty(0, np.uint64)).grams))
        return grams, np.zeros(len(grams), dtype=np.int8)

    rows = _often(texts, first_grams, ranges, FREQUENT + 1, 0).orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").toArrow()
    frequent = spark.sparkContext.broadcast(np.sort(rows.column("h").to_numpy().view(np.uint64)))

    def lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys, _, _, role = prefixes(batch, frequent.value).entries(percent)
        return _short(keys), role

    # Most lists hold one set, or none early enough, or none of their own class of sizes;
    # only the others are brought together.
    several = spark.sparkContext.broadcast(bits.table(_often(texts, lists, ranges, 2, EARLY | OWN).select("h")))

    def listed(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = prefixes(batch, frequent.value)
        keys, kind, text, role = found.entries(percent)
        may = bits.may_hold(several.value, mix(_short(keys)))
        own = np.array([_number(_set_id(s)) for s in found.sets], dtype=np.int64)[text]
        columns = [pa.array(x[may]) for x in (keys.view(np.int64), kind, own, role)]
        return pa.RecordBatch.from_arrays(columns, names=["list", "kind", "number", "role"])

    met = written(map_batches(texts, "list BIGINT, kind BIGINT, number BIGINT, role TINYINT", listed, BATCH))
    ends = met.groupBy("list").agg(F.min("number").alias("least"), F.max("number").alias("last"), F.bit_or("role").alias("roles"))
    ends = ends.filter((F.col("least") < F.col("last")) & (F.col("roles") == (EARLY | OWN))).select("list", "least")
    return met.drop("role").join(ends, "list").select(F.xxhash64("kind", "least").alias("cell"), "number").distinct()


LINKS = "a BIGINT, b BIGINT"
LEFT, RIGHT, BOTH = 0, 1, 2


def _links_in_cells(rows: DataFrame, keys: list[str], size: int, percent: int, secret: int) -> DataFrame:
    """Links ``(a, b)`` in the groups ``keys`` of rows ``(cell, side, node, text)``."""

    def find(table: pa.Table) -> pa.Table:
        cell, side, nodes = (table.column(c).to_numpy() for c in ("cell", "side", "node"))
        grams, at = gram_sets(table.column("text").combine_chunks(), size, secret)
        sets = [grams[a:b] for a, b in zip(at, at[1:])]
        found = []
        order = np.argsort(cell, kind="stable")
        for here in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            if (side[here] == BOTH).all():
                found += search(nodes, sets, here, here, percent)
            else:
                found += search(nodes, sets, here[side[here] != RIGHT], here[side[here] != LEFT], percent)
        return pa.Table.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.groupBy(*keys).applyInArrow(find, LINKS)


def links(source: DataFrame, classes: DataFrame, size: int, percent: int, secret: int) -> DataFrame:
    """Links ``(a, b)`` between classes ``(node, h, number, n_shingles, signature)`` that
    connect whatever is connected by links of at least ``percent``."""
    members = written(memberships(source, classes, size, percent, secret))
    counts = members.groupBy("cell").agg(F.count(F.lit(1)).alias("sets"))
    placed = members.join(counts.select("cell", F.ceil(F.col("sets") / BLOCK).cast("int").alias("blocks")), "cell")
    tasks = 1 + members.count() // TASK_ROWS
    task = F.pmod(F.xxhash64("cell"), F.lit(tasks)).alias("task")

    def keep(table: pa.Table) -> pa.Table:
        cell, sizes = table.column("cell").to_numpy(), table.column("n_shingles").to_numpy()
        signs = table.column("signature").to_pylist()
        ids = np.column_stack([table.column(c).to_numpy() for c in ("node", "h")])
        order = np.argsort(cell, kind="stable")
        names, kept = [], [np.empty((0, 2), np.int64)]
        for here in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            for part in parts(sizes[here], [signs[i] for i in here.tolist()], percent):
                own = ids[here[part]]
                own = own[np.lexsort((own[:, 1], own[:, 0]))]
                # Named by its sets, a part that many cells have is one.
                names += [_number(_set_id(own))] * len(own)
                kept.append(own)
        node, h = np.ascontiguousarray(np.concatenate(kept).T)
        return pa.Table.from_arrays([pa.array(names, pa.int64()), pa.array(node), pa.array(h)], names=["cell", "node", "h"])

    few = placed.filter("blocks = 1").join(classes, "number").select(task, "cell", "node", "h", "n_shingles", "signature")
    small = few.groupBy("task").applyInArrow(keep, "cell BIGINT, node BIGINT, h BIGINT").distinct().withColumn("blocks", F.lit(1))
    many = placed.filter("blocks > 1").join(classes, "number").select("cell", "node", "h", "blocks")
    needed = written(small.union(many))
    # Texts of sets without a possible partner stay where they are.
    wanted = bits.table(needed.select(F.xxhash64("node", "h").alias("w")))
    sent = source.sparkSession.sparkContext.broadcast(wanted)

    def asked(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(bits.may_hold(sent.value, batch.column("w").to_numpy().view(np.uint64))))

    texts = source.select(F.xxhash64("d", "h").alias("w"), F.col("d").alias("node"), "h", "text")
    texts = map_batches(texts, "w BIGINT, node BIGINT, h BIGINT, text STRING", asked, BATCH).drop("w").dropDuplicates(["node", "h"])
    held = needed.join(texts, ["node", "h"])
    found = _links_in_cells(
        held.filter("blocks = 1").select(task, "cell", F.lit(BOTH).alias("side"), "node", "text"), ["task"], size, percent, secret
    )
    large = F.col("blocks") > 1
    if needed.filter(large).isEmpty():
        return found
    return found.union(_links_of_large(written(held.filter(large)), size, percent, secret))


def _links_of_large(members: DataFrame, size: int, percent: int, secret: int) -> DataFrame:
    """Links of cells of several blocks ``(cell, node, text, blocks)``.

    All sets of a cell meet its least one first. Those it is linked with are connected and
    need not meet each other; the others meet all, block by block.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    least = members.groupBy("cell").agg(F.min("node").alias("node"))
    first = members.join(least, ["cell", "node"]).select("cell", every.alias("i"), F.lit(LEFT).alias("side"), "node", "text")
    others = members.join(least, ["cell", "node"], "left_anti").select("cell", block.alias("i"), F.lit(RIGHT).alias("side"), "node", "text")
    near = written(_links_in_cells(first.union(others), ["cell", "i"], size, percent, secret))
    done = least.join(near, least["node"] == near["a"]).select("cell", F.col("b").alias("node")).union(least.select("cell", "node"))
    rest = written(members.join(done, ["cell", "node"], "left_anti"))
    strips = rest.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("strips"))
    left = rest.join(strips, "cell").select(
        "cell", F.pmod(F.xxhash64("node"), F.col("strips")).cast("int").alias("i"), every.alias("j"), F.lit(LEFT).alias("side"), "node", "text"
    )
    strip = F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("i")
    right = members.join(strips, "cell").select("cell", strip, block.alias("j"), F.lit(RIGHT).alias("side"), "node", "text")
    return near.union(_links_in_cells(left.union(right), ["cell", "i", "j"], size, percent, secret))


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """Per row of ``df``: ``(key, n_shingles, component_id)``.

    Texts are linked where the sets of their runs of ``size`` words have a Jaccard
    similarity of at least ``percent`` hundredths (1 to 100); ``component_id`` is the least
    key that links reach, the row's own included. No list, cell or link is capped. Sets are
    compared by hashes of 64 bits under a key that is drawn for each call.

    A null, empty or blank text has an empty set and is linked with nothing. Rows that share
    a key count as one document. A row with a null key is linked with nothing and has a null
    ``component_id``. ``key`` is an integer; other columns are not read.
    """
    secret = new_key()
    source = df.select(F.col(key).cast("bigint").alias("d"), F.xxhash64(key, text).alias("h"), F.col(text).alias("text"))
    rows = written(_set_rows(source, size, percent, secret))
    known = rows.filter("set_id IS NOT NULL AND d IS NOT NULL")
    grouped = known.groupBy("set_id").agg(
        F.min(F.struct("d", "h")).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        F.first("number").alias("number"), F.count(F.lit(1)).alias("rows"),
    )
    columns = ["set_id", F.col("rep.d").alias("node"), F.col("rep.h").alias("h"), "n_shingles", "signature", "number", "rows"]
    classes = written(grouped.select(*columns))
    described = classes.select("node", "h", "n_shingles", "signature", "number")
    found = links(source.filter("d IS NOT NULL"), described, size, percent, secret)
    copies = known.join(classes.filter("rows > 1").select("set_id", "node"), "set_id").filter("d <> node")
    of = components(found.union(copies.select(F.col("d").alias("a"), F.col("node").alias("b"))))
    joined = rows.join(of.withColumnRenamed("node", "d"), "d", "left")
    return joined.select(F.col("d").alias(key), "n_shingles", F.coalesce("component", "d").alias("component_id"))
