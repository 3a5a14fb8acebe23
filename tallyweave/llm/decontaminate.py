"""Benchmark decontamination with a distributed positional inverted index.

Test items are cut into windows of consecutive words. Each window is looked up by its
rarest term: only the postings (term, row, position) of such terms are taken from the
training texts and shifted by the term's offset in the window. Other terms have no lists to
intersect: a slice of the text's words is compared with the window. A candidate counts only
if every word of the window stands in its place (exact phrase), or within ``slop`` words of
it (proximity).

Everything here is DataFrame functions; no test or training text leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.llm.common import lower_ascii, written

# Fixed value: what separates words; upper-case letters are told apart afterwards.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
# Windows that may be sent to every task, and their bytes in all.
MOST_SENT, MOST_SENT_BYTES = 100_000, 10_000_000


def words_of(text: Column | str) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def lowered(word: Column) -> Column:
        # An all-ASCII word has nothing else that lower() would change.
        plain = F.octet_length(word) == F.char_length(word)
        return F.when(plain, F.lower(word)).when(word.rlike("[A-Z]"), lower_ascii(word)).otherwise(word)

    return F.transform(F.array_remove(F.split(text, SEPARATORS), ""), lowered)


def item_windows(items: DataFrame, key: str, text: str = "text", size: int = WINDOW) -> DataFrame:
    """Rows ``(item, phrase, n)``: every window of ``size`` words, blank-joined; a shorter
    item is one window of its ``n`` words, one without words has none."""
    worded = items.select(F.col(key).alias("item"), words_of(text).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    cut = worded.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("window"))
    return cut.select("item", F.array_join("window", " ").alias("phrase"), F.size("window").alias("n")).distinct()


def may_be_sent(windows: DataFrame) -> bool:
    """Whether the windows are few and short enough for a copy in every task."""
    count, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    return count <= MOST_SENT and size <= MOST_SENT_BYTES


def rarest_terms(windows: DataFrame, rows: DataFrame, sent: bool) -> DataFrame:
    """Rows ``(term, offset, phrase, n)``: each window that can occur, under its rarest term.

    Terms are counted over all ``words`` of ``rows``, with sums per task before the
    shuffle. If the windows may be ``sent`` to all tasks, only their terms are counted. A
    window with a term that no text has is dropped.
    """
    distinct = windows.select("phrase", "n").distinct()
    terms = distinct.select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    needed = terms.select("term").distinct()
    words = rows.select(F.explode("words").alias("term"))
    if sent:
        words = words.join(F.broadcast(needed), "term", "left_semi")
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    known = written(counts.join(needed, "term"))
    least = F.min(F.struct("times", "offset", "term")).alias("least")
    met = terms.join(known, "term").groupBy("phrase", "n").agg(least, F.count(F.lit(1)).alias("seen"))
    return met.filter("seen = n").select("least.term", "least.offset", "phrase", "n")


def row_key(key: str, text: str) -> list[Column]:
    """Two columns that tell rows apart by key and text, nulls included; equal rows share them."""
    return [F.coalesce(F.col(key), F.lit(0)).alias("d"), F.xxhash64(key, text).alias("h")]


def find(
    df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    size: int = WINDOW, slop: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Matches of the items' windows in the texts of ``df``.

    Returns ``(rows, links)``. ``rows`` has one row per row of ``df``: ``key``, ``d``,
    ``h``, ``n_words``, ``n_hit`` (words inside a match) and ``matches``, an array of
    ``(start, n, phrase)`` in words from 0. ``links`` has ``(d, h, item)`` for every item with
    a matching window, once.

    With ``slop`` above 0, a window also matches where all its distinct words stand
    within ``slop`` words of their exact span. Null and empty texts have no words and no
    match; equal items match alike; repeated rows each get their own row.
    """
    windows = written(item_windows(items, item, item_text, size))
    source = df.select(F.col(key).cast("bigint").alias(key), F.col(text).alias("text")).select(key, "text", *row_key(key, "text"))
    source = source.select(key, "d", "h", words_of("text").alias("words"))
    worded = written(source.withColumn("n_words", F.size("words").cast("bigint")))
    sent = may_be_sent(windows)
    rare = written(rarest_terms(windows, worded, sent))

    def exact(words: Column, start: Column, n: Column, phrase: Column) -> Column:
        return (start >= 0) & (F.array_join(F.slice(words, F.greatest(start, F.lit(0)) + 1, n), " ") == phrase)

    def near(words: Column, start: Column, n: Column, phrase: Column) -> Column:
        first = F.greatest(start - slop, F.lit(0))
        around = F.slice(words, first + 1, F.greatest(start + n + slop - first, F.lit(0)))
        return F.size(F.array_except(F.split(phrase, " "), around)) == 0

    found = (near if slop else exact)(*map(F.col, ("words", "start", "n", "phrase")))
    start = (F.col("pos") - F.col("offset")).alias("start")
    if sent:
        # The windows meet the postings where the words are; nothing but matches moves.
        postings = worded.select("d", "h", "words", F.posexplode("words").alias("pos", "term"))
        met = postings.join(F.broadcast(rare), "term").select("d", "h", "words", start, "n", "phrase")
    else:
        postings = worded.select("d", "h", F.posexplode("words").alias("pos", "term"))
        met = postings.join(rare, "term").select("d", "h", start, "n", "phrase")
        met = met.join(worded.select("d", "h", "words"), ["d", "h"])
    # One array per text: as long as its matches. Repeated rows have the same ones.
    matches = met.filter(found).groupBy("d", "h").agg(F.array_sort(F.collect_set(F.struct("start", "n", "phrase"))).alias("matches"))
    matches = written(matches)
    none = F.array().cast(matches.schema["matches"].dataType)
    matched = worded.drop("words").join(matches, ["d", "h"], "left").withColumn("matches", F.coalesce("matches", none))
    covered = F.aggregate(
        "matches",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")),
        lambda so_far, m: F.struct(
            F.greatest(so_far["end"], m["start"] + m["n"]).alias("end"),
            (so_far["words"] + F.greatest(F.least(m["start"] + m["n"], F.col("n_words").cast("int")) - F.greatest(so_far["end"], m["start"], F.lit(0)), F.lit(0))).alias("words"),
        ),
        lambda end: end["words"].cast("bigint"),
    )
    rows = matched.select(key, "d", "h", "n_words", covered.alias("n_hit"), "matches")
    phrases = matches.select("d", "h", F.explode(F.array_distinct(F.transform("matches", lambda m: m["phrase"]))).alias("phrase"))
    links = phrases.join(windows.select("item", "phrase"), "phrase").select("d", "h", "item").distinct()
    return rows, links


def report(df: DataFrame, items: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """Per row of ``df``: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``
    (of the items' keys, sorted as strings, comma-joined) and ``contaminated``."""
    rows, links = find(df, items, key, **names)
    per_row = links.groupBy("d", "h").agg(F.array_sort(F.collect_list(F.col("item").cast("string"))).alias("found"))
    out = rows.drop("matches").join(per_row, ["d", "h"], "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return out.select(
        key, "n_words", "n_hit", F.size(found).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of ``df`` that hold no window of an item, with all their columns."""
    rows, _ = find(df, items, key, text, **names)
    hit = rows.filter("n_hit > 0").select(F.col("d").alias("hit_key"), F.col("h").alias("hit_hash")).distinct()
    return df.join(hit, (F.coalesce(df[key].cast("bigint"), F.lit(0)) == hit["hit_key"]) & (F.xxhash64(df[key].cast("bigint"), df[text]) == hit["hit_hash"]), "left_anti")
