import re

import frames
import pytest
from pyspark.sql import functions as F
from tallyweave.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = [(k, tuple(w[i : i + size])) for k, t in items if (w := split(t)) for i in range(max(len(w) - size, 0) + 1)]
    out = []
    for key, text in docs:
        words, hit, found = split(text), set(), set()
        for k, win in windows:
            for i in range(len(words) - len(win) + 1):
                if tuple(words[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(k))
        out.append((key, len(words), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out, key=repr)


def run(spark, docs, items):
    rows = decontaminate.report(docs, items).collect()
    return rows


@pytest.mark.parametrize("most_sent", [100_000, 0])
def test_against_brute_force(spark, monkeypatch, most_sent):
    # With 0, windows meet the postings in a shuffle.
    monkeypatch.setattr(decontaminate, "MOST_SENT", most_sent)
    passage = frames.words(20, 25)
    items = [(1, passage), (2, "Short item"), (3, "Short item"), (4, None), (5, " .. "), (6, frames.words(21, 10)), (None, "e f"), (20, "ß É9")]
    docs = [
        (1, frames.words(30, 40) + " " + passage + " " + frames.words(31, 5)),
        (2, passage.upper().replace(" ", " -- ")), (3, " ".join(passage.split()[:9])), (4, "a SHORT,item b short item"),
        (5, None), (6, ""), (7, "E.F e f"), (8, frames.words(21, 10) * 2), (9, "é9 ß É9"), (10, (passage + " ") * 30),
        (11, "short item"), (11, "short item"), (12, "x"), (12, "short item"), (None, passage),
    ]
    df = frames.with_clashes(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"))
    given = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows, links = decontaminate.find(df, given)
    keys = {(r["d"], r["h"]): set() for r in rows.collect()}
    for r in links.collect():
        keys[r["d"], r["h"]].add(str(r["item"]))
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(keys[r["d"], r["h"]]), ",".join(sorted(keys[r["d"], r["h"]]))) for r in rows.collect()), key=repr)
    assert got == brute(docs, items)
    left = decontaminate.clean(df, given)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((w[0] for w in brute(docs, items) if not w[2]), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id BIGINT, text STRING")
    none = spark.createDataFrame([], "item_id BIGINT, text STRING")
    row = decontaminate.report(docs, none).first()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (2, 0, 0, False)
    assert decontaminate.report(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("most_sent", [100_000, 0])
def test_proximity(spark, monkeypatch, most_sent):
    monkeypatch.setattr(decontaminate, "MOST_SENT", most_sent)
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id BIGINT, text STRING")
    docs = spark.createDataFrame([(1, "gamma x beta alpha"), (2, "alpha x x x x x beta gamma"), (3, "alpha beta")], "doc_id BIGINT, text STRING")
    assert decontaminate.find(docs, items)[0].filter("n_hit > 0").count() == 0
    near = decontaminate.find(docs, items, slop=3)[0].filter("n_hit > 0")
    assert [r["doc_id"] for r in near.select("doc_id").distinct().collect()] == [1]


def test_runs_on_functions_only(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id BIGINT, text STRING").filter(F.lit(True))
    plan = decontaminate.report(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_few_long_windows_are_not_sent(spark, monkeypatch):
    sent, broadcast = [], F.broadcast
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda df: sent.append(df) or broadcast(df))
    plain_words = frames.words(40, 30)
    long_words = " ".join(f"{'x' * 1_200_000}{i}" for i in range(10))
    docs, items = [(1, "a " + long_words), (2, plain_words), (3, "b")], [(1, long_words), (2, plain_words)]
    given = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows, _ = decontaminate.find(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), given)
    assert not sent
    assert sorted((r["doc_id"], r["n_hit"]) for r in rows.collect()) == [(1, 10), (2, 30), (3, 0)]
    decontaminate.find(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), given.filter("item_id = 2"))
    assert sent
