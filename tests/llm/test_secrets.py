import hashlib
import random
import re

import frames
import numpy as np
import pytest
from tallyweave.llm import secret_scan as S
from tallyweave.llm.queries import op3_secrets


def plain(text):
    """The base scan written straight from its rule."""
    found = []
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    for m in re.finditer(f"({letters})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_spans():
    pick = random.Random(3)
    parts = ["token", "API_KEY", "apikey", "pass", "word", "=", ": ", '"', "'", " ", "AKIA", "ABCDEFGH12345678", "abcdef0123456789" * 2, "short", "é", "ſecret", "toKen", "12345678"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(12)))
        assert S.base_spans(text) == plain(text), text


@pytest.fixture(scope="module")
def counts():
    out = np.zeros((2, S.SIZE, S.SIZE))
    pick = random.Random(1)
    ordinary = ["customer_account", "internationalisation", "configuration_manager", "thousandfold", "otherwise", "responsibilities", "straightforwardly", "understanding"]
    symbols = S.SYMBOLS[:62]
    for _ in range(400):
        np.add.at(out[0], S._pairs(pick.choice(ordinary)), 1)
        np.add.at(out[1], S._pairs("".join(pick.choice(symbols) for _ in range(30))), 1)
    return out


def test_models_tell_random_strings_from_identifiers(counts):
    pick = random.Random(9)
    for _ in range(50):
        assert S.bits_of("".join(pick.choice(S.SYMBOLS[:62]) for _ in range(32)), counts) > S.LEAST_BITS
    for word in ("customer_configuration", "internationalmanager", "straightforward_understanding"):
        assert S.bits_of(word, counts) < 0
    ratios = S.log_ratios(counts)
    text = "see wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLE and internationalisation_manager"
    assert [(k, text[a:b]) for a, k, b, _ in S.all_spans(text, ratios)] == [(3, "wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLE")]
    # No samples: no opinion.
    assert not S.log_ratios(np.zeros_like(counts)).any()


def test_edges_and_redaction(spark, counts):
    key = "0123456789abcdef" * 2
    rows = [(1, f"a token = {key} b", "en", "s", 9), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "é" * 10 + f" AKIA{'X' * 16} " + "word " * 100_000, "en", "s", 1),
            (5, "clean", "en", "s", 5), (5, "clean", "en", "s", 5), (None, f"password={key}{key} token: {key}", "en", "s", 5)]
    df = frames.with_clashes(frames.documents(spark, rows))
    found = S.scan(df, counts, into="spans_found")
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans_found"]] for r in found.collect()}
    assert spans[1] == [("assign", 2, 42), ("hex", 10, 42)]
    assert spans[4] == [("access", 11, 31)]
    assert spans[2] == spans[3] == spans[5] == []
    cleaned = S.redact(found, spans="spans_found")
    assert cleaned.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert (texts[1], texts[2], texts[3], texts[5], texts[None]) == ("a [SECRET] b", None, "", "clean", "[SECRET] [SECRET]")
    assert S.scan(df.limit(0), S.count_transitions(df.limit(0))).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_secrets(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]] or "")
        digest = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("random")] == [x for x in digest.split(",") if x]


def test_many_spans_in_one_text():
    import time

    pick = random.Random(8)
    word = "".join(pick.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(40))
    text = " ".join(f'token="{word[i % 20 :]}" {word} plain words' for i in range(4_000))
    ratios = S.log_ratios(np.zeros((2, S.SIZE, S.SIZE)))
    ratios[:, :-1] = 3.0
    start = time.perf_counter()
    found = S.all_spans(text, ratios)
    assert time.perf_counter() - start < 2
    base = S.base_spans(text)
    assert len(base) == 4_000 and sum(kind == 3 for _, kind, _, _ in found) == 4_000
    assert not any(a < y and x < b for (a, _, b), (x, kind, y, _) in zip(base, [f for f in found if f[1] == 3]))
