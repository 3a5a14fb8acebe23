"""The pipeline against a plain version of each stage, on its own input."""

import base64
import hashlib

import corpus_pipeline
import frames
import public_tokenizers
import pytest
import tiktoken
from tallyweave.llm import secret_scan
from tallyweave.llm.queries import RANKS
from test_decontaminate import brute as leaks
from test_minhash import brute as near
from test_secrets import plain


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Given documents, with a few that each stage must catch."""
    given = "/root/testdata/sf0.001"
    out = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{given}/documents.parquet")
    item = spark.read.parquet(f"{given}/benchmark.parquet").first()["text"]
    clean = frames.words(77, 200)
    rows = [
        (100_001, None, "en", "x", 0), (100_002, "12 345", "en", "x", 6), (100_003, clean, "en", "x", 5), (100_004, clean + " more", "en", "x", 5),
        (100_005, frames.words(78, 80) + " " + item, "en", "x", 5), (100_006, frames.words(79, 80) + " password=abcdef0123456789", "en", "x", 5),
    ]
    docs.unionByName(frames.documents(spark, rows)).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{given}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near-duplicates", "decontamination", "secrets", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, folder).cache()
        seen[name] = (before, docs)
        if name != "tokens":
            assert docs.schema.simpleString() == before.schema.simpleString()

    def pairs(df):
        return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]

    before, after = map(pairs, seen["language"])
    assert sorted(after) == sorted((k, t) for k, t in before if t and any(c.isalpha() for c in t))
    before, after = map(pairs, seen["near-duplicates"])
    kept = {k for k, _, _, keep in near(before, 5, 80) if keep}
    assert sorted(after) == sorted((k, t) for k, t in before if k in kept)
    before, after = map(pairs, seen["decontamination"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {k for k, _, n, *_ in leaks(before, items) if n}
    assert 100_005 in hit and sorted(after) == sorted((k, t) for k, t in before if k not in hit)
    before, after = map(dict, map(pairs, seen["secrets"]))
    assert set(before) == set(after)
    for k, text in after.items():
        spans = [(a, b) for a, _, b in plain(before[k])]
        want, at = "", 0
        for a, b in secret_scan._merged(spans):
            want, at = want + before[k][at:a] + "[SECRET]", b
        assert plain(text) == [] and (text == want + before[k][at:] or text.count("[SECRET]") > len(spans))
    sizes = {r["doc_id"]: (r["n_chars"], len(r["text"])) for r in seen["secrets"][1].collect()}
    assert sizes[100_006][0] == sizes[100_006][1]
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    truth = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in docs.collect()}
    assert set(got) == set(after)
    for k, text in after.items():
        ids = ",".join(map(str, truth.encode_ordinary(text)))
        assert got[k]["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    # run() makes the same rows.
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, got.values()))


def test_awkward_documents_pass_every_stage(spark, folder):
    df = frames.with_clashes(frames.documents(spark, frames.awkward(frames.words(1, 150))))
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.limit(0)):
            out = stage(spark, docs, folder)
            out.collect()
            if name != "tokens":
                assert out.columns == df.columns


def test_numeric_signs_have_no_language(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(200_001, "\u00b2 \u00bd \u2460 \u2167", "en", "x", 7), (200_002, "12 \u00b2 m", "en", "x", 6)]
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(frames.documents(spark, rows)), folder)
    assert [r["doc_id"] for r in kept.filter("doc_id > 200000").collect()] == [200_002]
