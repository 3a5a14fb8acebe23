"""Small document tables with the awkward cases every operator must handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Names that operators use inside; callers may have them as columns of their own.
CLASHING = ["d", "h", "tag", "anchor", "content", "node", "key", "ids", "lang_pred", "score", "secrets", "changed", "kept", "component"]


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def awkward(shared: str) -> list[tuple]:
    """Null and empty texts, null and repeated keys, copies, near copies, one very long text."""
    near = shared.replace("w1 ", "changed ", 1)
    return [
        (1, shared, "en", "a", 1),
        (2, shared, "en", "a", 1),
        (3, near, "en", None, None),
        (4, None, None, None, None),
        (5, "", "de", "b", 0),
        (6, " \t\n ", "de", "b", 4),
        (7, "one", "de", "b", 3),
        (8, "one two", "de", "b", 7),
        (9, words(5, 60) + " " + shared + " " + words(6, 60), "en", "b", 1),
        (10, (words(7, 300) + " ") * 40, "en", "b", 1),
        (11, "ÀÉß 日本語 Straße " * 30, "fr", "b", 1),
        (12, words(8, 80), "en", "a", 1),
        (12, words(8, 80), "en", "a", 1),
        (13, words(9, 50), "en", "a", 1),
        (13, words(10, 50), "en", "a", 1),
        (None, words(11, 70), "en", "a", 1),
        (None, words(11, 70) + " tail", "en", "a", 1),
    ]


def documents(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
