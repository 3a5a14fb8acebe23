import random

import frames
import numpy as np
import pytest
from tallyweave.llm import periodic


def brute(w, least=24, times=3):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                start = i
                while i + q < len(w) and w[i] == w[i + q]:
                    i += 1
                if i + q - start >= max(least, times * q):
                    found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def found_runs(texts, least, times):
    codes = np.array([x for t in texts for x in t], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out = [[] for _ in texts]
    for s, e, q in zip(*(x.tolist() for x in periodic.find_runs(codes, at, least, times))):
        k = int(np.searchsorted(at, s, side="right")) - 1
        out[k].append((s - int(at[k]), e - s, q))
    return out


def repetitive(pick):
    out = []
    for _ in range(pick.randrange(5)):
        base = [pick.randrange(pick.choice([1, 2, 5, 50])) for _ in range(pick.randrange(1, 15))]
        out += base * pick.randrange(1, 9)
        out = out[: len(out) - pick.randrange(4)]
        if pick.random() < 0.3:
            out = out + out
    return out


@pytest.mark.parametrize("least, times", [(24, 3), (6, 3), (12, 4), (3, 3)])
def test_runs_against_all_periods(least, times):
    pick = random.Random(least)
    for _ in range(250):
        texts = [repetitive(pick) for _ in range(pick.randrange(1, 5))]
        assert found_runs(texts, least, times) == [brute(t, least, times) for t in texts]


def test_words_decide_where_hashes_say_too_much(monkeypatch):
    plain = periodic._Extensions._equal
    monkeypatch.setattr(periodic._Extensions, "_equal", lambda self, a, b, n: plain(self, a, b, n) | ((a + n) % 5 == 0))
    pick = random.Random(9)
    for _ in range(100):
        text = repetitive(pick)
        assert found_runs([text], 9, 3) == [brute(text, 9, 3)]


def test_grammar_expands_to_the_text():
    pick = random.Random(2)
    for _ in range(200):
        text = repetitive(pick)
        start, rules = periodic.repair(text, 100)

        def expanded(s):
            return [s] if s < 100 else [x for part in rules[s - 100] for x in expanded(part)]

        assert [x for s in start for x in expanded(s)] == text
        pairs = list(zip(start, start[1:]))
        # No pair repeats, but for overlapping ones.
        assert all(pairs.count(p) < 2 or p[0] == p[1] for p in pairs)
        for whole, left, place, places in periodic.nodes(start, rules, 100, 2):
            assert 0 < left < whole and place == places[0]
            assert all(text[p : p + whole] == text[place : place + whole] for p in places)


def test_long_texts_of_few_words():
    for period in (1, 7, 3_000):
        pick = random.Random(period)
        base = [pick.randrange(10**6) for _ in range(period)]
        text = (base * (20_000 // period + 1))[:20_000]
        assert found_runs([text], 24, 3) == [[(0, 20_000, period)]]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert found_runs([b], 24, 3) == [brute(b)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows_and_edges(spark):
    rows = frames.awkward(frames.words(1, 120))
    rows += [(20, "a\tb\n" * 40, "en", "a", 1), (21, "x " + "é ü ß " * 9 + "x", "en", "a", 1), (22, "one " * 23, "en", "a", 1), (None, "one " * 24, "en", "a", 1)]
    df = frames.with_clashes(frames.documents(spark, rows))
    got = periodic.collapse(df)
    assert got.columns == [*df.columns, "runs", "collapsed"]
    want = []
    for key, text, *_ in rows:
        words = (text or "").split()
        runs = brute(words)
        want.append((key, runs, collapsed(words, runs)))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert periodic.collapse(frames.documents(spark, [])).count() == 0
    assert got.filter("h = 'own h'").count() == len(rows)
    with pytest.raises(ValueError):
        periodic.collapse(df, times=2)
