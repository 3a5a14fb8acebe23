"""Words with page positions to lines, columns and typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions.numbers import parse_digits

_DECIMAL = r"^[0-9]+\.[0-9]+$"


def _word() -> Column:
    return F.struct(F.col("x0").cast("double").alias("x0"), F.col("word_no").cast("bigint").alias("word_no"), "text")


def _joined(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: w["text"]), " ")


def line_words(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per printed line: ``top`` and the words from left to right.

    ``words`` has ``x0``, ``top``, ``text`` and ``word_no`` (reading order, which
    settles equal positions). A line is as long as the paper is wide, so gathering
    its words stays small.
    """
    return (
        words.groupBy(*keys, F.round(F.col("top").cast("double"), 1).alias("top"))
        .agg(F.array_sort(F.collect_list(_word())).alias("words"))
    )


def words_to_lines(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(keys, top, text)``."""
    return line_words(words, keys).select(*keys, "top", _joined(F.col("words")).alias("text"))


def split_layout_columns(
    words: DataFrame, bands: Sequence[tuple[str, float | None, float | None]], min_top: float
) -> DataFrame:
    """Drop words above ``min_top`` and name the column band each word falls in.

    A band is (name, x above, x below), both bounds exclusive; words outside every
    band, such as those in the gutter, are dropped.
    """
    side = None
    x = F.col("x0").cast("double")
    for name, low, high in bands:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (x > low)
        if high is not None:
            inside = inside & (x < high)
        side = F.when(inside, F.lit(name)) if side is None else side.when(inside, F.lit(name))
    placed = words.filter(F.round(F.col("top").cast("double"), 1) >= min_top).withColumn("side", side)
    return placed.filter(F.col("side").isNotNull())


def parse_name_count_line(lines: DataFrame, keys: Sequence[str], headers: Sequence[str] = ()) -> DataFrame:
    """Lines of ``line_words`` whose right-most word is a count: name and count."""
    right = F.array_max(F.transform("words", lambda w: w["x0"]))
    counted = lines.withColumn("_right", right).withColumn(
        "_count", F.get(F.filter("words", lambda w: w["x0"] == F.col("_right")), 0)
    )
    named = counted.withColumn(
        "name", _joined(F.filter("words", lambda w: w["word_no"] != F.col("_count.word_no")))
    )
    keep = F.col("_count.text").rlike("^[0-9]+$") & (F.col("name") != "") & ~F.col("name").isin(list(headers) or [""])
    return named.filter(keep).select(*keys, "top", "name", parse_digits("_count.text").alias("count"))


def parse_name_two_decimals_line(
    lines: DataFrame,
    keys: Sequence[str],
    headers: Sequence[str] = (),
    total_name: str | None = None,
    small_group: str | None = None,
    row_types: tuple[str, str] = ("aggregate", "entity"),
) -> DataFrame:
    """Lines with at least three words, two of them decimals: name and both values.

    Words left of the first decimal form the name. The total row and the small-group
    row are kept and flagged.
    """
    decimals = F.filter("words", lambda w: w["text"].rlike(_DECIMAL))
    found = lines.withColumn("_decimals", decimals).filter((F.size("words") >= 3) & (F.size("_decimals") >= 2))
    named = found.withColumn("_x", F.get("_decimals", 0)["x0"]).withColumn(
        "name", _joined(F.filter("words", lambda w: w["x0"] < F.col("_x")))
    )
    named = named.filter((F.col("name") != "") & ~F.col("name").isin(list(headers) or [""]))
    is_total = F.col("name") == total_name if total_name else F.lit(False)
    is_small = F.col("name") == small_group if small_group else F.lit(False)
    return named.select(
        *keys,
        "top",
        "name",
        F.get("_decimals", 0)["text"].cast("double").alias("first_value"),
        F.get("_decimals", 1)["text"].cast("double").alias("second_value"),
        F.when(is_total, F.lit(row_types[0])).otherwise(F.lit(row_types[1])).alias("row_type"),
        is_small.alias("is_small_group"),
    )
