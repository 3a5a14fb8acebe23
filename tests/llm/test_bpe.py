import base64
import hashlib
import random

import frames
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tallyweave.llm import bpe, pretokens
from tallyweave.llm.queries import RANKS, bpe_digest


@pytest.fixture(scope="module")
def truth():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder():
    return bpe.coder(RANKS).encoder(public_tokenizers.PATTERN)


def encoded(by, texts):
    ids, counts = by.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_same_ids_as_the_library(truth):
    every = "".join(chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000)
    texts = ["", "a" * 5000, "ab" * 3000, " \n \n\t x  y   z\n\nq \n", "é" * 777 + "日本語テキスト" * 50, every, "x".join(every[:400])]
    texts += [" lead", "\nlead", "tail ", "tail\n", "a  b", "a   b c", "it's we'll 'S", "!!??" * 900, "<|endoftext|>", "\x1c a\x85b  c", "a\xa0 x", "a\xa0  x", "a\u3000\n\nx", "!\x1c!", " \u2003"]
    pick = random.Random(2)
    texts += ["".join(pick.choice("ab c\n\té日1.'s\xa0\u2009") for _ in range(pick.randrange(60))) for _ in range(400)]
    for text, ids in zip(texts, encoded(encoder(), texts)):
        assert ids == truth.encode_ordinary(text), text[:50]


def test_full_caches_change_nothing(truth, monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 7)
    monkeypatch.setattr(pretokens, "LONGEST_KEPT", 5)
    fresh = pretokens.PieceEncoder(public_tokenizers.PATTERN, encoder().encode_many, np.int32)
    texts = [frames.words(i, 40) + ". Longer-word's end" for i in range(20)]
    for _ in range(2):
        assert encoded(fresh, texts) == [truth.encode_ordinary(t) for t in texts]


def test_queue_takes_lowest_rank_first():
    queue = bpe.RankQueue(300_000)
    ranks = random.Random(1).sample(range(300_000), 500)
    for r in ranks:
        queue.push(r, np.array([r]))
        queue.push(r, np.array([r + 1]))
    taken = []
    while (found := queue.pop()) is not None:
        assert found[1].tolist() == [found[0], found[0] + 1]
        taken.append(found[0])
    assert taken == sorted(ranks)


def test_lower_rank_that_comes_up_goes_first():
    # "cd" (5) makes "abcd" (4) possible, and then "dab" must not be merged before it.
    tokens = [bytes([b]) for b in range(256)]
    ranks = {t: 100 + i for i, t in enumerate(tokens)}
    ranks |= {b"ab": 50, b"cd": 60, b"abcd": 10, b"cdab": 20}
    words = bpe.Vocabulary(ranks)
    for word in (b"abcdabcd", b"cdabcd", b"ababcdcd" * 3, b"cdcdabab"):
        assert words.encode([word])[0].tolist() == words._one(word)


def test_round_trip_and_edges(spark, truth):
    rows = frames.awkward(frames.words(1, 120))
    df = frames.with_clashes(frames.documents(spark, rows))
    coded = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS)
    assert set(df.columns) <= set(coded.columns)
    got = sorted(tuple(r) for r in bpe_digest(coded.na.fill(-1, ["doc_id"])).collect())
    want = []
    for key, text, *_ in rows:
        ids = truth.encode_ordinary(text or "")
        numbers = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((-1 if key is None else key, len(ids), numbers, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    at_once = bpe.encode(df, RANKS, public_tokenizers.PATTERN, decoded="decoded").select("ids", "decoded").collect()
    assert sorted(map(repr, at_once)) == sorted(map(repr, coded.select("ids", "decoded").collect()))
    assert bpe.encode(frames.documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    assert coded.filter("h = 'own h' AND score = 'own score'").count() == len(rows)
