import random

import frames
import numpy as np
import pyarrow as pa
import pytest
from tallyweave.llm import bits, overlap
from test_minhash import brute, edited, shingles


def check(spark, rows, size=4, percent=85, clash=True):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = overlap.groups(frames.with_clashes(df) if clash else df, size=size, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [r[:3] for r in brute(rows, size, percent)]


def test_awkward_rows(spark):
    check(spark, [(r[0], r[1]) for r in frames.awkward(frames.words(1, 150))])
    check(spark, [])


def near_copies():
    rows = []
    for g in range(5):
        base = frames.words(200 + g, 160, 5000)
        rows += [(len(rows) + i, edited(900 * g + i, base, i % 9)) for i in range(25)]
    chain = frames.words(500, 200, 5000).split()
    for step in range(10):
        rows.append((1000 - step, " ".join(chain)))
        chain[step * 15 : step * 15 + 4] = [f"y{step}", f"z{step}", f"u{step}", f"v{step}"]
    # Unrelated texts around one passage, and texts that are part of others.
    passage = frames.words(77, 25, 5000)
    rows += [(2000 + i, f"{frames.words(i, 40 + i, 5000)} {passage} {frames.words(i + 300, 60, 5000)}") for i in range(25)]
    rows += [(3000 + i, " ".join(frames.words(90, 240, 5000).split()[: 240 - 9 * i])) for i in range(12)]
    random.Random(4).shuffle(rows)
    return rows


@pytest.mark.parametrize("block, frequent, heap", [(1_000, 300, 2_000), (6, 4, 0)])
def test_groups_chains_and_common_passages(spark, monkeypatch, block, frequent, heap):
    # Small blocks take the way of large cells.
    monkeypatch.setattr(overlap, "BLOCK", block)
    monkeypatch.setattr(overlap, "FREQUENT", frequent)
    monkeypatch.setattr(overlap, "HEAP", heap)
    check(spark, near_copies(), clash=False)


def test_other_sizes_and_thresholds(spark):
    rows = near_copies()
    check(spark, rows, 2, 60, clash=False)
    check(spark, rows[:60] + rows[:9], 3, 100, clash=False)


@pytest.mark.parametrize("heap", [2_000, 0])
def test_search_finds_all_connected(monkeypatch, heap):
    monkeypatch.setattr(overlap, "HEAP", heap)
    pick = np.random.default_rng(3)
    for trial in range(60):
        base = [np.unique(pick.integers(0, 60, 30)) for _ in range(3)]
        sets = [np.unique(np.concatenate([b[pick.random(len(b)) < 0.95], pick.integers(60, 90, pick.integers(0, 3))])).astype(np.uint64) for b in base for _ in range(8)]
        nodes = np.arange(len(sets))
        parent = nodes.copy()
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                shared = len(np.intersect1d(x, y))
                if 100 * shared >= 80 * (len(x) + len(y) - shared):
                    parent[parent == parent[i]] = parent[j]
        got = nodes.copy()
        every = np.arange(len(sets))
        for a, b in overlap.search(nodes, sets, every, every, 80):
            got[got == got[a]] = got[b]
        assert (got[:, None] == got).tolist() == (parent[:, None] == parent).tolist()


def test_signatures_turn_no_similar_pair_away():
    pick = np.random.default_rng(5)
    for n in (1, 7, 40, 600, 5_000):
        one = np.unique(overlap.mix(pick.integers(0, 1 << 60, n).astype(np.uint64)))
        other = one[int(len(one) * 0.15) :]
        if 100 * len(other) >= 85 * len(one):
            assert overlap.with_a_partner(np.array([len(one), len(other)]), [overlap.signature(one), overlap.signature(other)], 85).all()
    far = [np.unique(overlap.mix(pick.integers(0, 1 << 60, 500).astype(np.uint64))) for _ in range(9)]
    assert not overlap.with_a_partner(np.array([len(s) for s in far]), [overlap.signature(s) for s in far], 85).any()


def test_gram_sets_follow_the_rule():
    texts = [None, "", " ", "A b", "a B c", "a b c d a b c", "é\x0bÉ x\ty\r\nz"]
    for size in (1, 3, 4):
        grams, at = overlap.gram_sets(pa.array(texts), size, 5)
        assert np.diff(at).tolist() == [len(shingles(t, size)) for t in texts]


def test_table_of_bits(spark):
    pick = np.random.default_rng(1)
    hashes = pick.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    table = bits.table(spark.createDataFrame([(int(h.view(np.int64)),) for h in hashes], "any BIGINT"))
    assert bits.may_hold(table, hashes).all()
    assert bits.may_hold(table, overlap.mix(hashes)).mean() < 0.01
    assert not bits.table(spark.createDataFrame([], "any BIGINT")).any()


def shuffled(spark):
    """Bytes of all stages so far that are known."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}


def test_few_bytes_are_shuffled(spark):
    # Half of the words come from one passage of their own topic, so many n-grams are shared.
    topics = [frames.words(t, 2_000, 3000).split() for t in range(40)]
    rows = []
    for i in range(1_600):
        at = random.Random(i).randrange(1_700)
        rows.append((i, f"{frames.words(i, 150, 100_000)} {' '.join(topics[i % 40][at : at + 150])}"))
    before = shuffled(spark)
    overlap.groups(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4).cache()).collect()
    moved = sum(n for stage, n in shuffled(spark).items() if stage not in before)
    assert moved < 1.5 * sum(len(t) for _, t in rows)


@pytest.mark.parametrize("frequent", [300, 4])
def test_similar_sets_share_a_cell(spark, monkeypatch, frequent):
    monkeypatch.setattr(overlap, "FREQUENT", frequent)
    monkeypatch.setattr(overlap, "RANGE", 700)
    rows = [r for r in near_copies() if r[1]]
    for percent in (60, 85):
        df = spark.createDataFrame(rows, "d BIGINT, text STRING").selectExpr("d", "xxhash64(d, text) AS h", "text")
        sets = overlap._set_rows(df, 4, percent, 5)
        classes = sets.groupBy("set_id").agg({"d": "min"}).withColumnRenamed("min(d)", "d").join(sets.drop("set_id"), "d")
        cells = {}
        for r in overlap.memberships(df, classes.withColumnRenamed("d", "node"), 4, percent, 5).collect():
            cells.setdefault(r.number, set()).add(r.cell)
        number = {r.d: r.number for r in sets.collect()}
        grams = {d: shingles(t, 4) for d, t in rows}
        similar = 0
        for d, _ in rows:
            for e, _ in rows:
                shared = len(grams[d] & grams[e])
                if d < e and number[d] != number[e] and 100 * shared >= percent * len(grams[d] | grams[e]):
                    similar += 1
                    assert cells[number[d]] & cells[number[e]]
        assert similar > 100


@pytest.mark.parametrize("percent", [30, 60, 85, 95])
def test_parts_hold_all_similar_pairs(percent):
    pick = np.random.default_rng(percent)
    sets = []
    for n in (3, 90, 700):
        base = overlap.mix(pick.integers(0, 1 << 60, n).astype(np.uint64))
        sets += [np.unique(base[pick.random(n) < 0.97]) for _ in range(6)] + [np.unique(overlap.mix(base))]
    sets = [s for s in sets if len(s)]
    room = overlap.signature_room(percent)
    signs = [overlap.signature(s, room) for s in sets]
    found = overlap.parts(np.array([len(s) for s in sets]), signs, percent)
    part = {i: k for k, p in enumerate(found) for i in p.tolist()}
    assert all(len(p) > 1 for p in found) and sum(map(len, found)) == len(part)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)):
                assert part[i] == part[j]
    if percent >= 85:
        assert all(len(sets[i]) > 50 and i % 7 < 6 or len(sets[i]) < 50 for i in part)
        assert max(map(len, signs)) * 8 <= 1024
