"""Near-duplicates by SetSketch registers.

A register keeps how small the least of a set's hash values is, on an exponential scale
with base ``B`` and cut off at both ends. Registers of a union are the greater of both
sets' registers, and those of similar sets are often equal. Bands of registers bring
similar sets together; the counts of greater, lesser and equal registers then tell by
maximum likelihood whether a pair can be similar enough, and full sets decide.

Equal sets are one class from the start, so copies never meet. Classes that share a band
form coarse groups, which are compared in blocks of bounded size; inside a block, pairs
that are already connected are skipped, so a block returns fewer links than rows. Large
groups first lose, in rounds, what a few of their sets connect (``_links_of_large``).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyweave.llm.common import fresh, map_batches, written
from tallyweave.llm.components import components
from tallyweave.llm.hashing import Words, chained, mix, new_key, window_starts

REGISTERS = 120
# Scale of the registers: base, rate, and the greatest value (16 bits).
B, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
# Greatest chance that a pair right at the threshold shares no band.
MISS = 1e-6
# Standard deviations of the estimate that a pair may fall short by and still be checked.
MARGIN = 6.0
# Sets and shingles in one block of a large group.
BLOCK_SETS, BLOCK_SHINGLES = 1_000, 2_000_000
# Blocks up to which a group is compared as a grid; larger ones go through hubs first.
LARGE = 8
# Sets of a large group that all others are compared with at a time, and how often at most.
HUBS, HUB_ROUNDS = 32, 4

_XOR = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64))
_TIMES = mix(np.arange(1001, REGISTERS + 1001, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int, key: int = 0) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` words, A-Z lower-cased.

    A text of fewer words has one run of all its words; one without words has none.
    """
    words = Words(column, lower=True)
    values = words.hashes(key)
    start, counts = window_starts(words.at, size)
    hashes = chained(values, start, size)
    short = chained(values, words.at[:-1], size - 1, words.counts())
    at = np.concatenate([[0], np.cumsum(counts)])
    return [
        np.unique(hashes[a:b]) if b > a else short[i : i + int(n > 0)]
        for i, (a, b, n) in enumerate(zip(at, at[1:], words.counts()))
    ]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set, one row per set; of an empty set all are 0."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    filled = [i for i, s in enumerate(sets) if len(s)]
    # Groups of sets whose hashes stay in the processor's cache.
    group: list[int] = []
    size = 0
    for i in filled:
        group.append(i)
        size += len(sets[i])
        if size > 30_000 or i == filled[-1]:
            values = np.concatenate([sets[k] for k in group])
            at = np.concatenate([[0], np.cumsum([len(sets[k]) for k in group])[:-1]])
            least = np.empty((REGISTERS, len(group)), dtype=np.uint64)
            room = np.empty_like(values)
            for r in range(REGISTERS):
                np.bitwise_xor(values, _XOR[r], out=room)
                np.multiply(room, _TIMES[r], out=room)
                np.minimum.reduceat(room, at, out=least[r])
            uniform = (least.astype(np.float64) + 0.5) / 2.0**64
            exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
            out[group] = np.clip(np.floor(1 - np.log(exponential) / math.log(B)), 0, TOP).astype(np.uint16).T
            group, size = [], 0
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def rows_per_band(threshold: float) -> int:
    """The longest band that misses a pair at the threshold with at most ``MISS``."""
    fits = [r for r in range(1, 13) if REGISTERS % r == 0 and (1 - threshold**r) ** (REGISTERS // r) <= MISS]
    return max(fits, default=1)


def _share(x: np.ndarray) -> np.ndarray:
    """Chance that a register is greater on the side that has the share ``x`` more."""
    return -np.log1p(-x * (B - 1) / B) / math.log(B)


def likelihood_slope(more: np.ndarray, less: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Derivative of the log-likelihood by the similarity, given sizes ``a`` and ``b`` and
    how many registers are greater and lesser. The likelihood is concave, so a slope of at
    least 0 says that the most likely similarity is at least this one."""
    u, v = a / (a + b), b / (a + b)
    left, right = np.maximum(u - v * similarity, 1e-12), np.maximum(v - u * similarity, 1e-12)
    p, q = _share(left), _share(right)
    scale = (B - 1) / B / math.log(B)
    dp, dq = -v * scale / (1 - left * (B - 1) / B), -u * scale / (1 - right * (B - 1) / B)
    equal = REGISTERS - more - less
    return more * dp / p + less * dq / q - equal * (dp + dq) / np.maximum(1 - p - q, 1e-12)


def estimate(a_registers: np.ndarray, b_registers: np.ndarray, a: int, b: int) -> float:
    """Most likely similarity of two sets of known sizes."""
    more = np.array([(a_registers > b_registers).sum()])
    less = np.array([(a_registers < b_registers).sum()])
    low, high = 0.0, min(a, b) / max(a, b)
    for _ in range(40):
        middle = (low + high) / 2
        if likelihood_slope(more, less, np.array([a]), np.array([b]), middle)[0] >= 0:
            low = middle
        else:
            high = middle
    return low


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    shared = int((b[place] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def block_links(
    nodes: np.ndarray, sizes: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Verified links between rows ``left`` and ``right`` that connect all that are connected there."""
    threshold = percent / 100
    least = threshold - MARGIN * math.sqrt(threshold * (1 - threshold) / REGISTERS)
    found = []
    same = left is right
    for start in range(0, len(left), 32):
        rows = left[start : start + 32]
        a, b = sizes[rows][:, None].astype(np.float64), sizes[right][None, :].astype(np.float64)
        fits = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
        fits &= nodes[rows][:, None] != nodes[right][None, :]
        if same:
            fits &= np.arange(start, start + len(rows))[:, None] < np.arange(len(right))[None, :]
        i, j = np.nonzero(fits)
        if not len(i):
            continue
        one, other = sketch[rows[i]], sketch[right[j]]
        more, less = (one > other).sum(axis=1), (one < other).sum(axis=1)
        slope = likelihood_slope(more, less, sizes[rows[i]].astype(float), sizes[right[j]].astype(float), max(least, 0.0))
        good = slope >= 0
        found.append(np.stack([more[good] + less[good], rows[i[good]], right[j[good]]], axis=1))
    if not found:
        return []
    pairs = np.concatenate(found)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for _, i, j in pairs.tolist():
        a, b = root(int(nodes[i])), root(int(nodes[j]))
        if a != b and _similar(sets[i], sets[j], percent):
            parent[max(a, b)] = min(a, b)
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def sketched(df: DataFrame, key: str, text: str, size: int, secret: int = 0) -> DataFrame:
    """Rows ``(d, h, n_shingles, set_id, registers)``: ``d`` the key, ``h`` a hash of key
    and text; the last two null for a text without words."""
    source = df.select(F.col(key).cast("bigint").alias("d"), F.xxhash64(key, text).alias("h"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), size, secret)
        sketch = registers(sets)
        ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        packed = [r.tobytes() if len(s) else None for r, s in zip(sketch, sets)]
        columns = [batch.column("d"), batch.column("h"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["d", "h", "n_shingles", "set_id", "registers"])

    return map_batches(source, "d BIGINT, h BIGINT, n_shingles BIGINT, set_id BINARY, registers BINARY", run, 700_000)


def _bands(classes: DataFrame, rows: int) -> DataFrame:
    """Rows ``(band, node)``: a hash of each band's values and of its number."""
    bands = REGISTERS // rows
    factors = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    numbers = mix(np.arange(5001, 5001 + bands, dtype=np.uint64))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sketch = np.frombuffer(b"".join(batch.column("registers").to_pylist()), dtype=np.uint16)
        values = sketch.reshape(-1, bands, rows).astype(np.uint64) + np.uint64(1)
        keys = mix((values * factors).sum(axis=2, dtype=np.uint64) ^ numbers).view(np.int64)
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), bands)
        return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes)], names=["band", "node"])

    return map_batches(classes.select("node", "registers"), "band BIGINT, node BIGINT", run)


def links(df: DataFrame, classes: DataFrame, key: str, text: str, size: int, percent: int, secret: int = 0) -> DataFrame:
    """Verified links ``(a, b)`` between classes ``(node, h, n_shingles, registers)`` that
    connect whatever is connected by links of at least ``percent``."""
    bands = _bands(classes, rows_per_band(percent / 100))
    leaders = bands.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    stars = bands.join(leaders.select("band", "leader"), "band").filter("node <> leader")
    coarse = components(stars.select(F.col("node").alias("a"), F.col("leader").alias("b")))

    members = written(classes.join(coarse, "node").withColumnRenamed("component", "coarse"))
    sizes = members.groupBy("coarse").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.select("coarse", blocks.alias("blocks"))
    # Small groups share tasks of about one block.
    total = members.agg(F.count(F.lit(1)), F.sum("n_shingles")).first()
    packs = 1 + int(max(total[0] / BLOCK_SETS, (total[1] or 0) / BLOCK_SHINGLES) * 2)
    placed = members.join(sizes, "coarse").select(
        "coarse", "node", "h", "n_shingles", "registers", "blocks",
        F.pmod(F.xxhash64("node", "h"), F.col("blocks")).cast("int").alias("block"),
    )
    source = df.select(F.col(key).cast("bigint").alias("node"), F.xxhash64(key, text).alias("h"), F.col(text).alias("text"))
    held = placed.join(source, ["node", "h"])

    def to_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.tobytes() for s in shingle_sets(batch.column("text"), size, secret)]
        names = ["coarse", "node", "n_shingles", "registers", "blocks", "block"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sets, pa.binary())], names=[*names, "shingles"])

    schema = "coarse BIGINT, node BIGINT, n_shingles BIGINT, registers BINARY, blocks INT, block INT, shingles BINARY"
    sets = map_batches(held, schema, to_sets, 700_000)
    large = F.col("blocks") > LARGE
    split = not sizes.filter(large).isEmpty()
    if split:
        sets = written(sets)
    # Groups of one block share a cell with others; those of a few are a grid of blocks.
    alone = F.col("blocks") > 1
    own, other = F.col("block"), F.col("other")
    cells = sets.filter(~large).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.when(alone, F.col("coarse")).otherwise(F.pmod(F.col("coarse"), F.lit(packs))).alias("cell"),
        F.when(alone, F.least(own, other)).otherwise(-1).alias("i"),
        F.when(alone, F.greatest(own, other)).otherwise(-1).alias("j"),
        F.when(own == other, BOTH).when(own < other, LEFT).otherwise(RIGHT).alias("side"),
        *SET,
    )
    found = _compared(cells, percent)
    return found.union(_links_of_large(sets.filter(large), percent)) if split else found


# Columns of a set, and which side of a comparison it takes in a cell.
SET = ("coarse", "node", "n_shingles", "registers", "shingles")
LEFT, RIGHT, BOTH = 0, 1, 2


def _compared(cells: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` inside the cells ``(cell, i, j)``, between left and right sets of a group."""

    def compare(table: pa.Table) -> pa.Table:
        coarse, nodes, sizes, side = (table.column(c).to_numpy() for c in ("coarse", "node", "n_shingles", "side"))
        sketch = np.frombuffer(b"".join(table.column("registers").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        found = []
        order = np.argsort(coarse, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(coarse[order])) + 1):
            if (side[rows] == BOTH).all():
                found += block_links(nodes, sizes, sketch, sets, rows, rows, percent)
            else:
                found += block_links(nodes, sizes, sketch, sets, rows[side[rows] != RIGHT], rows[side[rows] != LEFT], percent)
        columns = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
        return pa.Table.from_arrays(columns, names=["a", "b"])

    return cells.groupBy("cell", "i", "j").applyInArrow(compare, "a BIGINT, b BIGINT")


def _links_of_large(sets: DataFrame, percent: int) -> DataFrame:
    """Links of the groups of so many blocks that a grid of them would cost too much.

    First all sets of a group are compared with a few of them (hubs). The hub with most
    links, what it is linked with, and what shares a linked hub with those are connected,
    and need no comparison with each other. While that shrinks the rest, further hubs are
    tried. What is left then is compared with everything, block by block.
    """
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    nodes = written(sets.select("coarse", "node").distinct())
    members = sets.select(F.col("coarse").alias("cell"), F.col("block").alias("i"), F.lit(-2).alias("j"), F.lit(LEFT).alias("side"), *SET)
    links = main = None
    rest, left = nodes, nodes.count()
    for turn in range(HUB_ROUNDS):
        by_hash = Window.partitionBy("coarse").orderBy(F.xxhash64("node", F.lit(turn)), "node")
        hubs = rest.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= HUBS).drop("n")
        ahead = sets.join(hubs, ["coarse", "node"]).withColumn("i", every)
        ahead = ahead.select(F.col("coarse").alias("cell"), "i", F.lit(-2).alias("j"), F.lit(RIGHT).alias("side"), *SET)
        found = written(_compared(members.union(ahead), percent))
        links = found if links is None else links.union(found)
        met = nodes.join(found, nodes["node"] == found["a"]).select("coarse", "node", F.col("b").alias("hub"))
        if main is None:
            counts = met.groupBy("coarse", "hub").agg(F.count(F.lit(1)).alias("n"))
            main = counts.groupBy("coarse").agg(F.max_by("hub", F.struct("n", "hub")).alias("node"))
        for _ in range(2):
            # Hubs that are in the connected part or linked with it, and all they are linked with.
            reached = met.join(main, ["coarse", "node"]).select("coarse", "hub").union(main).distinct()
            main = met.join(reached, ["coarse", "hub"]).select("coarse", "node").union(reached).union(main).distinct()
        main = written(main)
        rest = written(nodes.join(main, ["coarse", "node"], "left_anti"))
        before, left = left, rest.count()
        if left <= BLOCK_SETS or left > 0.8 * before:
            break

    open_ = sets.join(rest, ["coarse", "node"]).drop("blocks", "block")
    needed = open_.groupBy("coarse").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("shingles"))
    strips = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    needed = needed.select("coarse", strips.alias("strips"))
    open_ = open_.join(needed, "coarse").withColumn("strip", F.pmod(F.xxhash64("node"), F.col("strips")).cast("int"))
    strip = F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("other")
    cell = F.col("coarse").alias("cell")
    own, other = F.col("strip"), F.col("other")
    side = F.when(own == other, BOTH).when(own < other, LEFT).otherwise(RIGHT).alias("side")
    among = open_.select("*", strip).select(cell, F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), side, *SET)
    blocks = sets.select("coarse", "blocks").distinct()
    # Cells of strips and blocks have a number of their own below those of two strips.
    outward = open_.join(blocks, "coarse").select("*", every.alias("block")).select(
        cell, F.col("strip").alias("i"), (F.lit(-3) - F.col("block")).alias("j"), F.lit(LEFT).alias("side"), *SET
    )
    settled = sets.join(rest, ["coarse", "node"], "left_anti").join(needed, "coarse").select("*", strip).select(
        cell, F.col("other").alias("i"), (F.lit(-3) - F.col("block")).alias("j"), F.lit(RIGHT).alias("side"), *SET
    )
    return links.union(_compared(among.union(outward).union(settled), percent))


def _placed(df: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Rows ``(d, h, n_shingles, component)``, one per row of ``df``."""
    # Shingles are told apart by 64 bits under a key of this run, which no text can foresee.
    secret = new_key()
    rows = written(sketched(df, key, text, size, secret))
    known = rows.filter("set_id IS NOT NULL AND d IS NOT NULL")
    grouped = known.groupBy("set_id").agg(
        F.min(F.struct("d", "h")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"), F.count(F.lit(1)).alias("rows"),
    )
    classes = written(grouped.select("set_id", F.col("rep.d").alias("node"), F.col("rep.h").alias("h"), "n_shingles", "registers", "rows"))
    found = links(df, classes, key, text, size, percent, secret)
    copies = known.join(classes.filter("rows > 1").select("set_id", "node"), "set_id").filter("d <> node")
    of = components(found.union(copies.select(F.col("d").alias("a"), F.col("node").alias("b"))))
    joined = rows.join(of.withColumnRenamed("node", "d"), "d", "left")
    return joined.select("d", "h", "n_shingles", F.coalesce("component", "d").alias("component"))


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``df``: ``(key, n_shingles, component_id, kept)``.

    Texts are linked where the sets of their runs of ``size`` words have a Jaccard
    similarity of at least ``percent`` hundredths. ``component_id`` is the least key that
    links reach, the row's own included; ``kept`` is true where that is the row's own.

    A text without words is linked with nothing. Rows that share a key count as one
    document. A row with a null key is linked with nothing: its ``component_id`` is null
    and it is kept. ``key`` is an integer.
    """
    out = _placed(df, key, text, size, percent)
    own = F.col("component").isNull() | (F.col("component") == F.col("d"))
    return out.select(F.col("d").alias(key), "n_shingles", F.col("component").alias("component_id"), own.alias("kept"))


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one row of each group: that of the least key, of a repeated key the one
    with the least hash of its text. Rows with a null key stay, but for exact repeats."""
    placed = _placed(df, key, text, size, percent)
    first = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("d", "h")).alias("rep"))
    stay = first.select("rep.d", "rep.h").union(placed.filter("component IS NULL").select("d", "h").distinct())
    d, h = fresh(df, "key_of_row"), fresh(df, "hash_of_row")
    named = df.withColumns({d: F.col(key).cast("bigint"), h: F.xxhash64(key, text)})
    stay = stay.withColumnsRenamed({"d": "kept_key", "h": "kept_hash"})
    found = named.join(stay, named[d].eqNullSafe(stay["kept_key"]) & (named[h] == stay["kept_hash"]), "left_semi")
    return found.dropDuplicates([d, h]).drop(d, h)
