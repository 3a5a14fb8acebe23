"""Texts that defeat polynomial hashes, rows without keys, and long windows."""

import random

import frames
import public_tokenizers
import pyarrow as pa
from test_bpe import encoded, encoder
from test_minhash import check
from test_repeats import brute_bytes, bytes_case, words_case

from tallyweave.llm import hashing, minhash, suffix
from tallyweave.llm.queries import TOKENIZER
from tallyweave.llm.wavelet import read_documents, write_shards


def thue_morse(n, letters="ab"):
    """Two words of ``n`` letters that every polynomial hash modulo a power of two confuses."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


ONE, OTHER = thue_morse(1024)


def test_word_hashes_tell_them_apart():
    for n in (8, 128, 1024, 2048):
        pair = thue_morse(n)
        assert len(set(hashing.Words(pa.array(pair)).hashes().tolist())) == 2
    words = [" ".join(t) for t in thue_morse(1024)]
    sets = [minhash.shingle_sets(pa.array([w]), 1025)[0].tolist() for w in words]
    assert sets[0] != sets[1]


def test_long_words_in_groups(spark):
    check(spark, [(1, ONE), (2, OTHER), (3, f"{ONE} {OTHER}"), (4, f"{OTHER} {ONE}"), (5, ONE)], 3, 85, clash=False)


def test_long_words_in_bpe():
    import base64

    import tiktoken
    from tallyweave.llm.queries import RANKS

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    truth = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [ONE, OTHER, f" {ONE}", f" {OTHER}", ONE[:15], ONE[:16], OTHER[:15], OTHER[:16], "a" * 15 + "\0", "a" * 15]
    assert encoded(encoder(), texts) == [truth.encode_ordinary(t) for t in texts]


def test_long_words_in_shards(spark):
    import zlib

    import numpy as np
    import tokenizers

    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    rows = [(1, ONE), (2, OTHER), (3, f"x {OTHER}"), (4, f"x {ONE}")]
    shards = write_shards(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), TOKENIZER, public_tokenizers.PATTERN)
    want = {k: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 0], dtype="<u4").tobytes()) for k, t in rows}
    assert {r["doc_id"]: r["ids_crc32"] for r in read_documents(shards).collect()} == want


def test_long_words_and_repeats(spark):
    filler = [frames.words(i, 30, 5000).split() for i in range(4)]
    one, other = (" ".join(f"{w}{ONE if k else OTHER}" for w in filler[0]) for k in (0, 1))
    words_case(spark, [(1, one), (2, other), (3, " ".join(thue_morse(64)[0])), (4, " ".join(thue_morse(64)[1]))], 20, 6)
    bytes_case(spark, [(1, ONE), (2, OTHER), (3, ONE + OTHER), (4, OTHER * 2)], 200, 32)


def test_windows_longer_than_a_byte_counts(spark):
    pick = random.Random(3)
    shared = "".join(pick.choice("abcdefgh ") for _ in range(900))
    bytes_case(spark, [(1, shared), (2, "x" * 50 + shared[100:800] + "y" * 40), (3, shared[:399]), (4, shared[:400])], 400, 32)


def test_rows_without_keys_are_told_apart(spark):
    pick = random.Random(4)
    texts = ["".join(pick.choice("abcdefghijklmnop ") for _ in range(90)) for _ in range(40_000)]
    rows = [(None, t) for t in texts] + [(7, texts[0]), (7, texts[1][:60]), (8, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted(((*r[:4], bytes(r[4])) for r in suffix.dedup(df, length=60, seed=16).collect()), key=repr)
    assert got == brute_bytes(rows, 60)
