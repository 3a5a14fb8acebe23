"""Keyed tables: one row per key, key sets and their differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ON_DUPLICATE = ("last", "first", "sum", "error")


def dedup(
    df: DataFrame, keys: Sequence[str], order: Column | str, on_duplicate: str = "last", sums: Sequence[str] = ()
) -> DataFrame:
    """One row per key.

    ``last`` / ``first`` keep the row with the greatest / least ``order``; ``sum`` adds
    the ``sums`` columns and takes the rest from the last row; ``error`` fails on a
    repeated key. Rows with a NULL ``order`` only count where a key has no others, and
    equal orders go by the other columns, except maps. All of them are aggregates with a map-side step, so a
    key that owns a third of the rows reaches its reducer as one row per task.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    picked = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_"))
    ties = [c for c, kind in df.dtypes if c in rest and "map<" not in kind and kind != "variant"]
    ranked = F.struct(order.isNull() if on_duplicate == "first" else order.isNotNull(), order, *ties)
    pick = (F.min_by if on_duplicate == "first" else F.max_by)(picked, ranked).alias("_row")
    extra = [F.sum(c).alias(f"_sum_{c}") for c in sums] if on_duplicate == "sum" else []
    out = df.groupBy(*keys).agg(pick, F.count(F.lit(1)).alias("_n"), *extra)

    def column(c: str) -> Column:
        if on_duplicate == "sum" and c in sums:
            return F.col(f"_sum_{c}").alias(c)
        return F.col(f"_row.{c}").alias(c)

    if on_duplicate == "error":
        # A filter, as it is kept whatever columns are read later.
        named = F.concat(F.lit("duplicate key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
        out = out.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(named).cast("boolean")))
    return out.select(*[column(c) if c in rest else F.col(c) for c in df.columns])


def first_sample(df: DataFrame, keys: Sequence[str], order: Column | str, columns: Sequence[str]) -> DataFrame:
    """The first row's ``columns`` per key."""
    return dedup(df.select(*keys, *columns, F.col(order).alias("_o") if isinstance(order, str) else order.alias("_o")),
                 keys, "_o", "first").drop("_o")


def latest_per_key(df: DataFrame, keys: Sequence[str], year: str, order: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of the greatest ``year`` per key; among equal years the first row."""
    newest = F.struct(F.col(year), -F.col(order))
    return df.groupBy(*keys).agg(F.max_by(F.struct(year, *columns), newest).alias("_row")).select(*keys, "_row.*")


def key_set(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Distinct non-blank keys."""
    c = F.col(key)
    return df.filter(c.isNotNull() & (c.cast("string") != "")).select(c.alias(name or key)).distinct()


def key_union(*sets: DataFrame) -> DataFrame:
    out = sets[0]
    for other in sets[1:]:
        out = out.union(other)
    return out.distinct()


def key_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks; both have the same column names."""
    return left.join(right, left.columns, "left_anti")


def key_set_difference_both_ways(left: DataFrame, right: DataFrame) -> DataFrame:
    """Symmetric difference with ``side``: empty when the sets are equal."""
    both = left.select(*left.columns, F.lit(1).alias("_side")).union(
        right.select(*left.columns, F.lit(2).alias("_side"))
    )
    sides = both.groupBy(*left.columns).agg(F.min("_side").alias("_a"), F.max("_side").alias("_b"))
    one = sides.filter("_a = _b")
    return one.select(*left.columns, F.when(F.col("_a") == 1, "left_only").otherwise("right_only").alias("side"))


def append_sections(*sections: DataFrame) -> DataFrame:
    """Audit sections stacked by column name."""
    out = sections[0]
    for s in sections[1:]:
        out = out.unionByName(s)
    return out


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows; ``order`` must end in a unique key."""
    return df.orderBy(*order).limit(k)
