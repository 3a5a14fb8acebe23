import math

import numpy as np
from pyspark.sql import functions as F
from tallyweave.llm import ann
from tallyweave.llm.queries import op9_neighbours

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def brute(vectors, queries, k):
    out = {}
    for q in queries:
        apart = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(vectors[q], v))), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, s) for s, i in apart[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_over_all_queries(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    got = found(op9_neighbours(spark, folder))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    hits = total = 0
    for q, near in got.items():
        apart = np.sqrt(np.square(x - x[ids == q]).sum(axis=1))
        apart[ids == q] = np.inf
        want = set(ids[np.lexsort((ids, apart))[:10]].tolist())
        hits, total = hits + len(want & {i for i, _ in near}), total + 10
        place = {i: n for n, i in enumerate(ids.tolist())}
        assert np.allclose([s for _, s in near], [apart[place[i]] for i, _ in near], rtol=1e-14)
    assert hits / total >= 0.95


def test_small_tables_are_searched_whole(spark):
    pick = np.random.default_rng(3)
    vectors = {i: pick.normal(size=5).astype(np.float32).tolist() for i in range(0, 90, 10)}
    vectors[33] = vectors[30]
    vectors[34] = vectors[30]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], SCHEMA)
    clash = df.withColumns({c: F.lit(1) for c in ("id", "v", "block", "score", "rank")})
    got = found(ann.nearest(clash, lambda i: i % 30 == 0, k=20))
    want = brute({i: np.array(v, dtype=np.float32).astype(float).tolist() for i, v in vectors.items()}, [0, 30, 60], 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert got[30][:2] == [(33, 0.0), (34, 0.0)]


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (None, [1.0, 1.0], 1), (8, [1.0, 2.0, 3.0], 1), (9, [2.0, 0.0], None), (9, [2.0, 0.0], None), (10, [-inf, 1.0], 1)]
    got = found(ann.nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i >= 0, k=10))
    assert set(got) == {0, 1, 9}
    assert [i for i, _ in got[1]] == [0, 9, 9] and [i for i, _ in got[9]] == [0, 1]
    empty = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(empty, lambda i: i >= 0).count() == 0
    lone = spark.createDataFrame([(1, [1.0, 0.0], 1)], SCHEMA)
    assert ann.nearest(lone, lambda i: i >= 0).count() == 0


def test_probing_finds_every_code_within_the_radius():
    pick = np.random.default_rng(5)
    codes = pick.integers(0, 256, (500, 4)).astype(np.uint8)
    index = ann.Index(codes)
    for radius in (0, 1, 3, 5, 9, 14, 32):
        for code in codes[:25]:
            apart = np.bitwise_count(codes ^ code).sum(axis=1)
            assert index.within(code, radius).tolist() == np.flatnonzero(apart <= radius).tolist()
