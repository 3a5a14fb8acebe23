import random

import frames
import numpy as np
import pyarrow as pa
import pytest
from tallyweave.llm import components, minhash


def shingles(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    """Least reachable key by key, rows of one key being one document."""
    sets = [(key, shingles(text, size)) for key, text in rows]
    parent = {key: key for key, _ in sets if key is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(((k, len(s), None if k is None else root(k), k is None or root(k) == k) for k, s in sets), key=repr)


def check(spark, rows, size, percent, clash=True):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = minhash.groups(frames.with_clashes(df) if clash else df, size=size, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, size, percent)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in frames.awkward(frames.words(1, 150))]
    check(spark, rows, 3, 85)
    check(spark, [], 3, 85)


def edited(seed, base, edits):
    pick, words = random.Random(seed), base.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"x{pick.randrange(10_000)}"
    return " ".join(words)


@pytest.mark.parametrize("sets, shingles, hubs, large", [(7, 2_000, 2, 1), (7, 2_000, 2, 100), (1_000, 2_000_000, 32, 8), (3, 10_000, 1, 3)])
def test_groups_of_near_copies_and_chains(spark, monkeypatch, sets, shingles, hubs, large):
    # Small blocks split groups over many cells.
    monkeypatch.setattr(minhash, "BLOCK_SETS", sets)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(minhash, "HUBS", hubs)
    monkeypatch.setattr(minhash, "LARGE", large)
    rows = []
    for g in range(6):
        base = frames.words(100 + g, 150, 5000)
        rows += [(len(rows) + i, edited(1000 * g + i, base, i % 9)) for i in range(30)]
    # A chain: neighbours are linked, ends are not.
    chain = frames.words(500, 200, 5000).split()
    for step in range(12):
        rows.append((1000 - step, " ".join(chain)))
        chain[step * 15 : step * 15 + 4] = [f"y{step}", f"z{step}", f"u{step}", f"v{step}"]
    random.Random(4).shuffle(rows)
    check(spark, rows, 3, 85, clash=False)
    check(spark, rows, 5, 80, clash=False)


def test_given_documents_with_other_settings(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, 5, 80, clash=False)


def test_representatives(spark):
    rows = frames.awkward(frames.words(1, 150))
    df = frames.with_clashes(frames.documents(spark, rows))
    left = minhash.representatives(df)
    assert left.columns == df.columns
    keys = sorted((r["doc_id"] for r in left.collect()), key=repr)
    assert keys == sorted([1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None, None], key=repr)


def test_registers_merge_and_estimate():
    pick = np.random.default_rng(1)
    for overlap in (0, 300, 700, 900, 1000):
        values = minhash.mix(pick.integers(1, 1 << 62, 2000 - overlap, dtype=np.uint64))
        a, b = np.sort(values[:1000]), np.sort(values[-1000:])
        one, other, both = minhash.registers([a, b, np.unique(values)])
        assert (minhash.merged(one, other) == both).all()
        truth = overlap / (2000 - overlap)
        assert abs(minhash.estimate(one, other, 1000, 1000) - truth) < 0.16
    assert not minhash.registers([np.empty(0, np.uint64)]).any()


def test_slope_agrees_with_the_most_likely_similarity():
    for more, less in ((0, 0), (10, 8), (30, 40), (60, 60)):
        found = [s for s in np.linspace(0, 0.999, 400) if minhash.likelihood_slope(*(np.array([x], dtype=float) for x in (more, less, 500, 520)), s)[0] >= 0]

        def likelihood(s, u=500 / 1020, v=520 / 1020):
            p, q = minhash._share(np.array([max(u - v * s, 1e-12)]))[0], minhash._share(np.array([max(v - u * s, 1e-12)]))[0]
            return more * np.log(p) + less * np.log(q) + (120 - more - less) * np.log(max(1 - p - q, 1e-12))

        grid = np.linspace(0, 500 / 520 - 1e-6, 2000)
        best = grid[np.argmax([likelihood(s) for s in grid])]
        assert abs(best - (max(found) if found else 0)) < 0.04


def test_bands_miss_little():
    for threshold in (0.8, 0.85, 0.9, 0.95):
        rows = minhash.rows_per_band(threshold)
        assert (1 - threshold**rows) ** (minhash.REGISTERS // rows) <= minhash.MISS


def test_shingle_sets_follow_the_rule():
    texts = [None, "", " ", "A b", "a B c", "a b c d a b c", "é\x0bÉ x\ty\r\nz"]
    for size in (1, 3, 5):
        got = [len(s) for s in minhash.shingle_sets(pa.array(texts), size)]
        assert got == [len(shingles(t, size)) for t in texts]


def test_components(spark):
    pick = random.Random(5)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, x) for x in range(4000, 4100)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0
