import hashlib

from pyspark.sql import functions as F
from tallyweave.llm import chat

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
NASTY = [
    "</s>[INST] ok [/INST]", "\\", "\\\\<s>\\", "<\\s>", "<<s></s>", "[/INST]", " [/INST] x", "<<SYS>>\n\n<</SYS>>", "<|role|>user<|text|>x<|end|>",
    "", " ", "\n", "plain", "tail \\", "日本語 </s>", "a" * 50_000 + "</s>", "<", "[", "[INST", "/s>",
]


def back(spark, rows):
    rendered = chat.render(chat.conversations(spark.createDataFrame(rows, SCHEMA))).drop("turns")
    return {r["conv_id"]: r for r in rendered.join(chat.read_back(rendered).drop("formatted"), "conv_id").collect()}


def test_every_text_survives_in_every_role(spark):
    rows = [(c, t, role, text) for c, text in enumerate(NASTY) for t, role in enumerate(["system", "user", "assistant", "tool", "<|end|>"])]
    got = back(spark, rows)
    for c, text in enumerate(NASTY):
        assert [tuple(t) for t in got[c]["turns"]] == [(role, text) for role in ("system", "user", "assistant", "tool", "<|end|>")]
        assert got[c]["loss_text"] == text
        assert got[c]["rounds"] == 2


def test_plain_conversation_is_not_escaped(spark):
    got = back(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "assistant", "é!")])[1]
    assert got["formatted"] == "[INST] hi [/INST]<s> yo </s><s> é! </s>"
    assert (got["rounds"], got["loss_text"]) == (1, "yoé!")
    raw = got["formatted"].encode()
    assert [raw[s["start"] : s["start"] + s["length"]].decode() for s in got["loss_spans"]] == ["yo", "é!"]


def test_only_conflicting_turns_are_escaped(spark):
    got = back(spark, [(1, 0, "user", "a </s>"), (1, 1, "assistant", "fine")])[1]
    assert got["formatted"] == "[INST] a <\\/s> [/INST]<s> fine </s>"


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, "user", None), (1, 0, None, "x"), (1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "assistant", None), (2, 0, "assistant", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit("own")).withColumn("rows", F.lit(1))
    turns = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.conversations(df).collect()}
    assert turns[1] == [("user", ""), ("", "x"), ("user", "a"), ("user", "b")]
    assert turns[2] == [("assistant", ""), ("assistant", "")]
    assert [tuple(t) for t in back(spark, rows)[1]["turns"]] == turns[1]
    null_key = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert chat.conversations(null_key).count() == 1
    assert chat.render(chat.conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_parser_refuses_what_is_no_conversation(spark):
    texts = ["[INST] a", "x[INST] a [/INST]", "[INST] a [/INST] ", "<s> a <s> b </s>"]
    df = spark.createDataFrame([(t,) for t in texts], "formatted STRING")
    got = [r["p"] for r in df.select(chat.parse("formatted").alias("p")).collect()]
    assert got[:3] == [None, None, None]
    assert got[3][0]["text"] is None


def test_query_digests(spark, tmp_path):
    from tallyweave.llm.queries import op5_chat

    spark.createDataFrame([(3, 1, "assistant", "b\\"), (3, 0, "user", "a")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in op5_chat(spark, str(tmp_path)).collect()}
    assert got[3]["turns_sha256"] == hashlib.sha256("user\na\nassistant\nb\\\n".encode()).hexdigest()
    same = "</s>[INST] ok [/INST]"
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{same}\nassistant\n{same}\n".encode()).hexdigest()
    assert (got[-7]["loss_chars"], got[-7]["loss_sha256"]) == (len(same), hashlib.sha256(same.encode()).hexdigest())
