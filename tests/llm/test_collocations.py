import random
import re
from collections import Counter

import frames
import pytest
from tallyweave.llm import collocations


def brute(rows, longest=5, least=100, covered=100, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", lower):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    often = {p: n for p, n in counts.items() if n >= least and len(p[1]) > 1}
    longer = Counter()
    for (lang, w), n in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], n)
    out = []
    for (lang, w), a in often.items():
        if 100 * longer[lang, w] >= covered * a and longer[lang, w]:
            continue
        n = totals[lang]
        score, k = min((1000 * a * n // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]], n))
    out.sort()
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right, n in out:
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, n, -score))
    return sorted(ranked)


def texts(seed, n):
    pick = random.Random(seed)
    fixed = ["New York city hall", "of the people", "a b a b a b", "ÉCOLE\x85x é", "ſ K"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randrange(12)):
            parts.append(pick.choice(fixed) if pick.random() < 0.4 else frames.words(pick.randrange(10**6), pick.randrange(6), 12))
            parts.append(pick.choice([" ", "\t", ". ", ",", "\n", "\r", "  ", "\x0b"]))
        rows.append(("".join(parts), pick.choice(["en", "de", None, ""])))
    return rows


def check(spark, rows, **settings):
    df = spark.createDataFrame([(t, lang, "own") for t, lang in rows], "text STRING, lang STRING, label STRING")
    got = collocations.mine(df, **settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, **settings)


@pytest.mark.parametrize("burst, entries", [(4_096, 300_000), (3, 20)])
def test_against_all_phrases(spark, monkeypatch, burst, entries):
    # Small tries burst and spill all the time.
    monkeypatch.setattr(collocations, "BURST", burst)
    monkeypatch.setattr(collocations, "ENTRIES", entries)
    rows = texts(1, 150) + [(None, "en"), ("", None), ("...", "en")]
    check(spark, rows, least=6)
    check(spark, rows, least=3, longest=3, covered=60, top=7)


def test_few_words_and_none(spark):
    check(spark, [], least=2)
    check(spark, [("once only", "en")], least=2)
    check(spark, [("a " * 400, "en"), ("a b. " * 50, "en")], least=100)


def test_products_past_64_bits(spark):
    scores = spark.range(1).select(
        collocations._exact(collocations.F.lit(9 * 10**15), collocations.F.lit(9 * 10**18)).alias("over"),
        collocations._exact(collocations.F.lit(3 * 10**15), collocations.F.lit(3 * 10**18 + 1)).alias("under"),
    )
    assert scores.selectExpr("over div under").first()[0] == (9 * 10**15 * 9 * 10**18) // (3 * 10**15 * (3 * 10**18 + 1))


def test_trie_counts_and_spills_whole_subtrees():
    pick = random.Random(3)
    trie, want = collocations.HatTrie(burst=4), Counter()
    for _ in range(3_000):
        path = tuple(pick.randrange(6) for _ in range(pick.randrange(2, 6)))
        n = pick.randrange(1, 5)
        trie.add(path, n)
        want[path] += n
        assert trie.size == len(want)
    sizes = trie.subtrees()
    assert sizes == sorted(sizes, reverse=True) and sum(n for n, _ in sizes) == len(want)
    for n, word in sizes:
        found = trie.take(word)
        assert len(found) == n and dict(found) == {p: c for p, c in want.items() if p[0] == word}
    assert trie.size == 0
