import random
import re
import zlib

import frames
from pyspark.sql import functions as F
from tallyweave.llm import language
from tallyweave.llm.queries import op7_language

ENGLISH = "the quick brown fox jumps over the lazy dog and then the other one runs away from there "
GERMAN = "der schnelle braune fuchs springt über den faulen hund und dann läuft der andere weg von dort "
GREEK, CYRILLIC = "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώϊϋ", "абвгдежзийклмнопрстуфхцчшщъыьэюяёіїєґ"


def test_automaton_knows_exactly_the_substrings():
    text = "abracadabra banana"
    follow = language.suffix_automaton([ord(c) for c in text])

    def knows(s):
        state = 0
        for c in s:
            if ord(c) not in follow[state]:
                return False
            state = follow[state][ord(c)]
        return True

    inside = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}
    assert all(knows(s) for s in inside)
    assert not any(knows(s + c) for s in inside for c in "abn" if s + c not in inside)


def phrases(text, sample):
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def plain(text):
    """Letters as they are, anything between them as one blank."""
    return re.sub(r"[\W\d_]+", " ", text)


def test_phrase_counts_by_brute_force():
    samples = {"a": ENGLISH * 2, "b": GERMAN}
    model = language.Model(samples)
    texts = ["the brown dog", "x", "", "ççç zzz über", ENGLISH, "fox -- jumps!!! 12 over", frames.words(1, 150), " ".join("abc" for _ in range(300))]
    bits = model.bits(texts)
    for i, text in enumerate(map(plain, texts)):
        blocks = [text[k : k + language.BLOCK] for k in range(0, len(text), language.BLOCK)]
        for j, name in enumerate(model.languages):
            want = sum(phrases(b, plain(samples[name])) for b in blocks)
            assert round(bits[i, j] * max(1, len(text)) / model.weights[j]) == want, (text[:20], name)


def test_edges(spark):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate([(ENGLISH * 3, "en"), (GERMAN * 3, "de")] * 20)]
    rows += [(100, None, "en", None, None), (101, "", None, None, None), (102, "123 !? \n", "de", None, None), (None, GERMAN, "de", None, None),
             (103, ENGLISH * 500, None, None, None), (104, "Über", None, None, None), (104, "Über", None, None, None)]
    df = frames.with_clashes(frames.documents(spark, rows))
    out = language.identify(df, into=("guess", "sure")).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert [by[k]["guess"] for k in (0, 1, 100, 101, 102, 103, None)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert all(0 <= r["sure"] <= 1 for r in out) and by[100]["sure"] == 0
    assert by[0]["score"] == "own score"
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["guess"] for r in language.identify(unlabelled, into=("guess", "sure")).collect()} == {"und"}
    assert language.identify(df.limit(0), into=("guess", "sure")).count() == 0


def test_held_out_labels_teach_nothing(spark):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, ENGLISH if i in out else GERMAN, "en" if i in out else "de", None, None) for i in range(200)]
    got = language.identify(frames.documents(spark, rows)).select("doc_id", "lang_pred", language.held_out(F.col("doc_id")).alias("out")).collect()
    assert {r["lang_pred"] for r in got} == {"de"}
    assert sorted(r["doc_id"] for r in got if r["out"]) == out


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    share = op7_language(spark, folder).join(truth, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98


def test_sample_takes_its_full_bounds(spark):
    rows = [(i, frames.words(i, 900), "en", None, None) for i in range(40)]
    learned = language.samples(frames.documents(spark, rows), "text", "lang")
    assert len(learned["en"]) == 32_000
    assert max(map(len, learned["en"].split("\n"))) == 2_000


def test_copies_count_once_in_the_sample(spark):
    texts = [frames.words(i, 60) for i in range(30)]
    # Copies and, beyond the excerpt, texts with another end.
    rows = [(i, f"{t} {i % 7}", "en", None, None) for i, t in enumerate(texts * 40)]
    bounds = language.Sample(documents=30, excerpt=150, characters=32_000)
    learned = language.samples(frames.documents(spark, rows), "text", "lang", bounds)["en"].split("\n")[1:]
    assert sorted(learned) == sorted(t[:150] for t in texts)


def test_numeric_signs_are_no_letters(spark):
    signs = ["\u00b2", "\u00bd", "\u2460", "\u2167", "12 \u00b2 + \u00bd = \u2460 \u2167"]
    rows = [(0, ENGLISH, "en", None, None), (1, GERMAN, "de", None, None)] * 20
    rows += [(100 + i, t, None, None, None) for i, t in enumerate([*signs, "\u00b2 a"])]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(frames.documents(spark, rows)).collect()}
    assert [got[100 + i] for i in range(len(signs))] == [("und", 0.0)] * len(signs)
    assert got[100 + len(signs)][0] != "und"


def han(seed, n, first):
    """Words of two letters out of 300 words, no letter in two of them."""
    pick = random.Random(seed)
    return "".join(chr(c) + chr(c + 1) for c in (first + 2 * pick.randrange(300) for _ in range(n)))


def test_scripts_of_many_letters(spark):
    # Greek and Cyrillic have more than 62 letters that are commoner than any of Han.
    many = {"aa": 0x4E00, "bb": 0x5E00}
    rows = [(i, han(i, 200, many[lang]), lang, None, None) for i, lang in enumerate(["aa", "bb"] * 60)]
    for i in range(200, 260):
        pick = random.Random(i)
        rows += [(i + at, "".join(pick.choices(letters, k=800)), lang, None, None) for at, letters, lang in ((0, GREEK, "el"), (100, CYRILLIC, "ru"))]
    rows += [(400, han(1001, 40, many["aa"]), None, None, None), (401, han(1002, 40, many["bb"]), None, None, None), (402, GREEK, None, None, None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(frames.documents(spark, rows)).collect()}
    assert [got[k] for k in (400, 401, 402)] == ["aa", "bb", "el"]
    assert all(got[i] == ("aa", "bb")[i % 2] for i in range(120))


def test_phrases_of_many_letters_by_brute_force():
    # The same letters in another order: only phrases tell the labels apart.
    one = han(1, 1500, 0x4E00)
    samples = {"one": one, "back": one[::-1], "mixed": ENGLISH + GREEK + CYRILLIC}
    model = language.Model(samples)
    texts = [han(2, 300, 0x4E00), one[700:900], samples["mixed"][::-1], "the ωψ дом 漢字 fox", ENGLISH + one[:50]]
    bits = model.bits(texts)
    for i, text in enumerate(map(plain, texts)):
        blocks = [text[k : k + language.BLOCK] for k in range(0, len(text), language.BLOCK)]
        for j, name in enumerate(model.languages):
            want = sum(phrases(b, plain(samples[name])) for b in blocks)
            assert round(bits[i, j] * len(text) / model.weights[j]) == want, (i, name)
    assert [x[0] for x in model.predict(texts[:2])] == ["one", "one"]


def test_tables_grow_with_the_sample_only():
    samples = {"han": han(1, 16_000, 0x4E00), "en": " ".join(frames.words(i, 100) for i in range(60)), "de": GERMAN * 300}
    model = language.Model(samples)
    for arrays, name in zip(model.tables, model.languages):
        assert sum(x.nbytes for x in arrays) < 60 * len(samples[name])
