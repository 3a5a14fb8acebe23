"""The two substring operators against plain scans of all windows."""

import hashlib
import random
from collections import Counter, defaultdict

import frames
import numpy as np
import pytest
from tallyweave.llm import debruijn, hashing, repeats, suffix
from tallyweave.llm.queries import op6_suffix


def split(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_words(rows, size):
    """Rows of equal key and text are one document; a null key comes first."""
    texts = [(-1 if k is None else k, t or "") for k, t in rows]
    first = {}
    order = sorted({(k, tag(k, t), t) for k, t in texts})
    words = {(k, t): split(t) for k, t in texts}
    gone = defaultdict(set)
    for k, _, t in order:
        w = words[k, t]
        for i in range(len(w) - size + 1):
            if first.setdefault(tuple(w[i : i + size]), (k, t, i)) != (k, t, i):
                gone[k, t].update(range(i, i + size))
    out = []
    for (key, _), (k, t) in zip(rows, texts):
        kept = [x for i, x in enumerate(words[k, t]) if i not in gone[k, t]]
        out.append((key, len(words[k, t]), len(gone[k, t]), " ".join(kept)))
    return sorted(out, key=repr)


_tags = {}


def tag(key, text):
    return _tags.get((key, text), 0)


def words_case(spark, rows, size=6, seed=2, clash=False):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    for r in repeats.keyed(df, "doc_id", "text").collect():
        _tags[-1 if r["d"] == repeats.NO_KEY else r["d"], r["text"] or ""] = r["tag"]
    got = debruijn.dedup(frames.with_clashes(df) if clash else df, window=size, seed=seed)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_words(rows, size)


def passages(seed, n, vocabulary):
    """Texts from shared passages, whole, cut and repeated inside one text."""
    pick = random.Random(seed)
    shared = [frames.words(seed + i, pick.randrange(4, 40), vocabulary).split() for i in range(6)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(pick.randrange(6)):
            part = pick.choice(shared)
            low = pick.randrange(len(part))
            out += [*part[low : pick.randrange(low, len(part)) + 1], *frames.words(pick.randrange(10**6), pick.randrange(5), vocabulary).split()]
        rows.append((pick.randrange(1000) if i % 3 else i + 1000, " ".join(out)))
    return [(k, t) for (k, t) in {k: t for k, t in rows}.items()]


@pytest.mark.parametrize("seed, vocabulary", [(1, 400), (2, 3), (3, 1)])
def test_words_against_all_windows(spark, seed, vocabulary):
    words_case(spark, passages(seed, 80, vocabulary))


def test_words_awkward(spark):
    words_case(spark, [(r[0], r[1]) for r in frames.awkward(frames.words(1, 120))], 20, 6, clash=True)
    words_case(spark, [])


def test_words_of_long_texts_in_pieces(spark, monkeypatch):
    text = frames.words(3, 3000)
    words_case(spark, [(1, text), (2, "x y " + text[500:9000])], 20, 6)


def test_pieces_find_the_same_windows(monkeypatch):
    import pyarrow as pa

    unit = repeats.Unit(True, 20, 6)
    sums, at = unit.items(pa.array(["a b", frames.words(1, 500), "", frames.words(2, 90, 2), frames.words(1, 500)]))
    whole = repeats.runs(sums, at, unit)
    monkeypatch.setattr(repeats, "PIECE", 37)
    cut = repeats.runs(sums, at, unit)

    def windows(found):
        text, start, length, anchor = found
        return {(t, s + k): a for t, s, n, a in zip(text.tolist(), start.tolist(), length.tolist(), anchor.tolist()) for k in range(n)}

    assert windows(whole) == windows(cut)
    assert len(windows(whole)) == sum(max(0, n - 19) for n in np.diff(at))


def brute_bytes(rows, size):
    """Every row is a text of its own."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + size] for _, t in texts for i in range(len(t) - size + 1))
    out = []
    for k, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((k, len(t), int(gone.sum()), int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0, kept))
    return sorted(out, key=repr)


def bytes_case(spark, rows, size=24, seed=8, clash=False):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = suffix.dedup(frames.with_clashes(df) if clash else df, length=size, seed=seed)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert sorted(((*r[:4], bytes(r[4])) for r in got.collect()), key=repr) == brute_bytes(rows, size)


@pytest.mark.parametrize("hot", [4_000, 2])
def test_bytes_against_all_windows(spark, monkeypatch, hot):
    # With 2, most anchors take the way of very frequent ones.
    monkeypatch.setattr(suffix, "CONTENTS", hot)
    bytes_case(spark, passages(5, 70, 400))
    bytes_case(spark, passages(6, 40, 1))


def test_bytes_awkward(spark):
    bytes_case(spark, [(r[0], r[1]) for r in frames.awkward(frames.words(1, 120))], 200, 32, clash=True)
    bytes_case(spark, [])


def test_suffix_order():
    pick = np.random.default_rng(0)
    for _ in range(500):
        symbols = pick.integers(0, int(pick.integers(1, 5)), int(pick.integers(0, 60)))
        want = sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
        assert suffix.suffix_order(symbols).tolist() == want


def test_repeated_starts():
    pick = np.random.default_rng(1)
    for _ in range(200):
        strings = [bytes(pick.integers(0, 2, int(pick.integers(0, 40))).astype(np.uint8)) for _ in range(int(pick.integers(1, 6)))]
        length = int(pick.integers(2, 9))
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        want = [i + length <= len(s) and seen[s[i : i + length]] > 1 for s in strings for i in range(len(s))]
        assert suffix.repeated_starts(strings, length).tolist() == want


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = [(k, n, g, s, hashlib.sha256(kept).hexdigest()) for k, n, g, s, kept in brute_bytes(rows, 200)]
    assert sorted((tuple(r) for r in op6_suffix(spark, folder).collect()), key=repr) == sorted(want, key=repr)


def test_hashes_depend_on_content_alone():
    import pyarrow as pa

    texts = ["alpha beta", None, "", "x alpha  beta\nalpha", "ALPHA"]
    words = hashing.Words(pa.array(texts))
    found = [words.data[a:b].tobytes() for a, b in zip(words.start, words.end)]
    assert found == [b"alpha", b"beta", b"x", b"alpha", b"beta", b"alpha", b"ALPHA"]
    assert words.counts().tolist() == [2, 0, 0, 4, 1]
    by_word = defaultdict(set)
    for w, h in zip(found, words.hashes().tolist()):
        by_word[w].add(h)
    assert all(len(x) == 1 for x in by_word.values()) and len({min(x) for x in by_word.values()}) == 4
    lower = hashing.Words(pa.array(texts), lower=True).hashes()
    assert lower[-1] == lower[0]
