import zlib

import frames
import numpy as np
import public_tokenizers
from tallyweave.llm import wavelet
from tallyweave.llm.queries import TOKENIZER, op10_wavelet
from tokenizers import Tokenizer


def test_matrix_answers_like_a_list():
    pick = np.random.default_rng(2)
    for size, top in ((0, 5), (1, 1), (7, 3), (513, 40), (5000, 65536)):
        ids = pick.integers(0, top, size).astype(np.uint16)
        data = wavelet.to_file(ids, [None, 4], [size, 0], 16)
        matrix, keys, counts = wavelet.from_file(data)
        assert keys == [None, 4] and counts.tolist() == [size, 0]
        assert (matrix.ids() == ids).all()
        for i in pick.integers(0, max(size, 1), 20).tolist():
            if i < size:
                token = int(ids[i])
                assert matrix.access(i) == token
                assert matrix.rank(token, i) == int((ids[:i] == token).sum())
                assert matrix.count(token) == int((ids == token).sum())
                places = np.flatnonzero(ids == token)
                k = int(pick.integers(0, len(places)))
                assert matrix.select(token, k) == places[k]
                assert matrix.select(token, len(places)) == -1
        assert matrix.count(65535 if top < 60000 else 70000) == 0


def brute(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return {key_text: [*tokenizer.encode(key_text[1] or "", add_special_tokens=False).ids, 0] for key_text in rows}


def test_shards_in_order(spark):
    rows = [(r[0], r[1]) for r in frames.awkward(frames.words(1, 120))] + [(99, "<|endoftext|> x"), (98, "a  b\n\n c!")]
    df = frames.with_clashes(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    shards = wavelet.write_shards(df, TOKENIZER, public_tokenizers.PATTERN, shard_tokens=400)
    got = sorted(wavelet.read_documents(shards).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys)
    at = 0
    want = brute(rows)
    sums = sorted((repr(k), len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for (k, _), ids in [(kt, want[kt]) for kt in rows])
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sums
    assert shards.filter("n_docs > 1").count() > 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert wavelet.read_documents(wavelet.write_shards(none, TOKENIZER, public_tokenizers.PATTERN)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    want, at = [], 0
    ids_of = brute(rows)
    for key_text in rows:
        ids = ids_of[key_text]
        want.append((key_text[0], at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in op10_wavelet(spark, folder).collect()) == want
