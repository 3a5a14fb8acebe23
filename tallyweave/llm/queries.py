"""The corpus operators on the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweave.llm import (
    ann, bpe, chat, collocations, debruijn, decontaminate, language, minhash, overlap, periodic, secret_scan, suffix, wavelet,
)
from tallyweave.llm.common import read

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents: 3-word shingles, similarity of 0.85 or more."""
    return minhash.groups(read(spark, folder, "documents").select("doc_id", "text"), size=3, percent=85)


OP1_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [list_slice(w, i, i + 2) FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM doc),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS r FROM doc UNION SELECT reach.doc_id, b FROM reach JOIN links ON r = a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = doc_id AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n"""


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and what they decode to."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return bpe_digest(bpe.encode(documents, RANKS, public_tokenizers.PATTERN, decoded="decoded"))


def bpe_digest(coded: DataFrame) -> DataFrame:
    numbers = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets: fixed patterns, and random strings found by the Markov models."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(documents, secret_scan.count_transitions(documents)).drop("text")
    base = F.filter("secrets", lambda s: s["kind"] != "random")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"), count("random"),
    )


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a passage of the benchmark, and the items they are of."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.report(documents, read(spark, folder, "benchmark"))


SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP4_SQL = f"""
WITH doc AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
item AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, unnest([list_slice(w, i, i + 9) FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS win
  FROM item WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos FROM doc, sizes WHERE len(w) >= n),
grams AS (SELECT doc_id, n, pos, list_slice(w, pos, pos + n - 1) AS win FROM places JOIN doc USING (doc_id)),
hits AS (SELECT doc_id, pos, n, item_id FROM grams JOIN windows USING (win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that imitates the marks, rendered and read back."""
    given = read(spark, folder, "conversations")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    imitation = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    rendered = chat.render(chat.conversations(given.unionByName(imitation))).drop("turns")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.read_back(rendered).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _sql_escaped(text: str) -> str:
    out = rf"replace({text}, '\', '\\')"
    for c in chat.CONTROL:
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


OP5_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length({_sql_escaped('text')}) + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    ELSE 23 + length({_sql_escaped('role')}) END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


def op6_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without strings of 200 bytes that occur anywhere else."""
    found = suffix.dedup(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = """
WITH doc AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, unnest(range(1, n - 198)) AS pos FROM doc WHERE n >= 200),
keyed AS (SELECT doc_id, pos, md5(b[pos:pos + 199]) AS k FROM win JOIN doc USING (doc_id)),
hit AS (SELECT doc_id, pos FROM keyed WHERE k IN (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1)),
run AS (SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER w <= 200 THEN 0 ELSE 1 END AS new FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
span AS (SELECT doc_id, min(pos) AS a, max(pos) + 200 AS z FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM run) GROUP BY doc_id, g),
gap AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS s, a AS e FROM span
  UNION ALL SELECT doc_id, max(z), max(n) + 1 FROM span JOIN doc USING (doc_id) GROUP BY doc_id
  UNION ALL SELECT doc_id, 1, n + 1 FROM doc WHERE doc_id NOT IN (SELECT doc_id FROM span)),
kept AS (SELECT doc_id, string_agg(hex(b[s:e - 1]), '' ORDER BY s) AS h FROM gap JOIN doc USING (doc_id) WHERE e > s GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed FROM span GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(h, ''))) AS kept_sha256 FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)"""


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    documents = read(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(documents).drop("text")
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_debruijn(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without passages of 20 words that occur earlier."""
    found = debruijn.dedup(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos FROM doc WHERE len(w) >= 20),
hashed AS (SELECT doc_id, pos, list_slice(w, pos, pos + 19) AS win FROM windows JOIN doc USING (doc_id)),
later AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM hashed) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS p FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    return ann.nearest(read(spark, folder, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op10_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    """Place, count and checksum of every document's ids, read back from the shard files."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return wavelet.read_documents(wavelet.write_shards(documents, TOKENIZER, public_tokenizers.PATTERN))


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """A tenth of the texts, by the checksum of their key, repeat some words to their end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        turns = F.flatten(F.array_repeat(F.slice(words, a.cast("int") + 1, p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(turns, F.lit(1), (n - a).cast("int"))), " ")

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # Bound once by the lambda, so that the text is split once.
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))[0]
    return documents.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), changed).otherwise(F.col("text")))


def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document's words, and the words without the repeats."""
    found = periodic.collapse(with_planted_periods(read(spark, folder, "documents").select("doc_id", "text"))).drop("text")

    def highest(best, r):
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.reduce("runs", none, highest)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "collapsed", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_CRC_STEP = "list_reduce([c] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"

OP11_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
    CASE WHEN text IS NULL OR doc_id IS NULL THEN 1 ELSE xor(4294967295, list_reduce(
      [CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
      lambda y, b: list_transform([xor(y, b)], lambda c: {_CRC_STEP})[1])) END AS h FROM documents),
cut AS (SELECT doc_id, w0, len(w0) AS n, h % 10 = 0 AND len(w0) > 0 AS planted, h // 10 AS g FROM doc),
put AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM cut),
per AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) END AS p FROM put),
text AS (
  SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: w0[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w0 END AS w
  FROM per),
word AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(n)) AS i FROM text),
pair AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM word a JOIN word b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
island AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS m FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pair)
  GROUP BY doc_id, q, k),
run AS (SELECT doc_id, s, m, min(q) AS q FROM island WHERE m >= greatest(24, 3 * q) GROUP BY doc_id, s, m),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
best AS (SELECT DISTINCT ON (doc_id) doc_id, s, m, q FROM run ORDER BY doc_id, m::DOUBLE / q DESC, s, q),
said AS (SELECT doc_id, count(*) AS k, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM run GROUP BY doc_id)
SELECT doc.doc_id, CAST(coalesce(k, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(m AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * m // q AS BIGINT) AS exponent_milli, sha256(coalesce(said.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM doc LEFT JOIN said USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of each language that stand out most."""
    return collocations.mine(read(spark, folder, "documents").select("text", "lang"))


OP12_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
words AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
gram AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, 6) AS s(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS c FROM gram GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (
  SELECT cut.lang, cut.phrase, a, k, x.c AS l, y.c AS r, n, (1000::HUGEINT * a * n) // (x.c::HUGEINT * y.c) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y JOIN total ON total.lang = cut.lang),
best AS (SELECT DISTINCT ON (lang, phrase) * FROM scored ORDER BY lang, phrase, score, k),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM cand)) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""


def op13_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Documents connected by a similarity of 0.85 or more of their 4-word shingles."""
    return overlap.groups(read(spark, folder, "documents").select("doc_id", "text"), size=4, percent=85)


OP13_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [list_slice(w, i, i + 3) FOR i IN range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM doc),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS r FROM doc UNION SELECT reach.doc_id, b FROM reach JOIN links ON r = a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n"""


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash, op2_bpe, op3_secrets, op4_decontaminate, op5_chat, op6_suffix, op7_language, op8_debruijn, op9_neighbours,
        op10_wavelet, op11_periodic, op12_collocations, op13_overlap, pipeline,
    )
}
ORACLES: dict[str, str] = {
    "op1_minhash": OP1_SQL, "op4_decontaminate": OP4_SQL, "op5_chat": OP5_SQL, "op6_suffix": OP6_SQL, "op8_debruijn": OP8_SQL,
    "op11_periodic": OP11_SQL, "op12_collocations": OP12_SQL,
    "op13_overlap": OP13_SQL,
}
