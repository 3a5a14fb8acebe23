"""Joins that build the analysis tables: full key spine and entity outer join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions.numbers import stable_round
from tallyweave.operators.measures import coverage_share, simple_average, weighted_average, weighting_method


def spine_join(
    key: str,
    spine: Sequence[tuple[DataFrame, dict[str, str]]],
    attributes: Sequence[tuple[DataFrame, dict[str, str]]] = (),
) -> DataFrame:
    """One row per non-blank key found in any spine table, with all their attributes.

    Each table has one row per ``key``; its mapping names the columns to take and their
    output names. ``attributes`` tables add columns but no keys. The spine tables are
    full-outer joined rather than read once for their keys and again for their columns,
    and since every join is on the same key each of them is shuffled once.
    """

    def part(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        present = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
        return present.select(key, *[F.col(c).alias(out) for c, out in columns.items()])

    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), [part(df, c) for df, c in spine])
    for df, columns in attributes:
        joined = joined.join(part(df, columns), key, "left")
    return joined


def entity_outer_join(
    key: str,
    tables: dict[str, tuple[DataFrame, Sequence[str]]],
    lookup: DataFrame | None = None,
    lookup_columns: Sequence[str] = (),
) -> DataFrame:
    """One row per name found in any table, with its columns and a ``has_`` flag per table.

    Every table has one row per ``key`` (aggregate it first where it does not); column
    names are distinct across tables. NULL keys meet as one row. ``lookup`` adds
    attributes of the name.
    """
    parts = [
        df.select(F.col(key).isNull().alias("_none"), key, *columns, F.lit(True).alias(f"has_{label}"))
        for label, (df, columns) in tables.items()
    ]

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        same = a["_none"].eqNullSafe(b["_none"]) & a[key].eqNullSafe(b[key])
        rest = [c for df in (a, b) for c in df.columns if c not in (key, "_none")]
        both = [F.coalesce(a[c], b[c]).alias(c) for c in ("_none", key)]
        return a.join(b, same, "full_outer").select(*both, *rest)

    joined = reduce(meet, parts).drop("_none")
    flags = {f"has_{label}": F.coalesce(F.col(f"has_{label}"), F.lit(False)) for label in tables}
    joined = joined.withColumns(flags)
    if lookup is not None:
        joined = joined.join(lookup.select(key, *lookup_columns), key, "left")
    return joined


def group_summary(
    rows: DataFrame,
    group: str,
    entity: str,
    weight: str,
    values: Sequence[str],
    any_flags: Sequence[str] = (),
) -> DataFrame:
    """One row per group from entity rows, in one aggregate.

    Total and covered weight, coverage share, entities, weighted, plain and preferred
    averages of each value, the weighting method, and flags that hold for any entity.
    A row is covered when it has at least one value.
    """
    covered: Column = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values])
    w = F.coalesce(F.col(weight), F.lit(0))
    aggregates = [
        F.sum(w).alias("total_weight"),
        F.sum(F.when(covered, w).otherwise(F.lit(0))).alias("covered_weight"),
        coverage_share(weight, covered).alias("coverage_share"),
        F.count_distinct(entity).alias("entities"),
        F.count(weight).alias("entities_with_weight"),
        F.count_if(covered).alias("entities_with_value"),
    ]
    for v in values:
        weighted, simple = weighted_average(v, weight), simple_average(v)
        aggregates += [
            stable_round(F.coalesce(weighted, simple)).alias(f"average_{v}"),
            stable_round(weighted).alias(f"weighted_{v}"),
            stable_round(simple).alias(f"unweighted_{v}"),
        ]
    aggregates.append(weighting_method(*[weighted_average(v, weight) for v in values]).alias("weighting_method"))
    aggregates += [F.bool_or(f).alias(f"any_{f}") for f in any_flags]
    return rows.groupBy(group).agg(*aggregates)
