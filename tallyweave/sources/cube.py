"""Statistical data cubes (JSON-stat 2) to long rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

CUBE_SCHEMA = (
    "id ARRAY<STRING>, size ARRAY<BIGINT>, "
    "dimension MAP<STRING, STRUCT<category: STRUCT<index: MAP<STRING, INT>, label: MAP<STRING, STRING>>>>, "
    "value ARRAY<DOUBLE>"
)


def parse_cube(df: DataFrame, json: str, key: str) -> DataFrame:
    """One row per cube: ``key`` and the parsed parts in ``_cube``."""
    return df.select(key, F.from_json(F.col(json), CUBE_SCHEMA).alias("_cube"))


def _members(dimension: str) -> Column:
    """Codes and labels of one dimension in index order."""
    category = F.col("_cube.dimension")[dimension]["category"]
    placed = F.transform(
        F.map_entries(category["index"]),
        lambda m: F.struct(m["value"].alias("place"), m["key"].alias("code"), category["label"][m["key"]].alias("label")),
    )
    return F.array_sort(placed)


def flatten_cube(
    df: DataFrame, json: str, key: str, dimensions: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """One row per cell, null cells kept: code and label of every dimension, value.

    Fails if a cube lists its dimensions in another order, if its values do not fill
    the product of its sizes, or if a dimension's labels do not match its size.
    Each dimension's members are put in order once per cube; cells look theirs up by place
    before they become rows, so one scan and no join does it all.
    """
    names = list(names or dimensions)
    cubes = parse_cube(df, json, key)
    expected = F.array(*[F.lit(d) for d in dimensions])
    cells_expected = F.aggregate("_cube.size", F.lit(1).cast("bigint"), lambda a, x: a * x)
    sizes_match: Column = reduce(
        lambda a, b: a & b,
        [
            (F.size(F.col("_cube.dimension")[d]["category"]["index"]) == F.get("_cube.size", i))
            & (F.array_sort(F.map_values(F.col("_cube.dimension")[d]["category"]["index"]))
               == F.sequence(F.lit(0), F.get("_cube.size", i).cast("int") - 1))
            for i, d in enumerate(dimensions)
        ],
    )
    problem = (
        F.when(F.col("_cube.id").isNull() | (F.col("_cube.id") != expected), F.lit("unexpected dimension order"))
        .when(~F.coalesce(F.size("_cube.value") == cells_expected, F.lit(False)), F.lit("values do not fill the cube"))
        .when((cells_expected > 0) & ~F.coalesce(sizes_match, F.lit(False)), F.lit("labels do not match the dimension size"))
    )
    # The guard sits on the exploded column itself, so it cannot be pruned away.
    guarded = F.when(problem.isNull(), F.col("_cube.value")).otherwise(
        F.raise_error(F.concat(F.lit("cube: "), problem)).cast("array<double>")
    )
    size = F.col("_cube.size")
    strides = [
        F.aggregate(F.slice(size, i + 2, len(names) - i), F.lit(1).cast("bigint"), lambda a, x: a * x).alias(f"_stride{i}")
        for i in range(len(names))
    ]
    sizes = [F.get(size, i).alias(f"_size{i}") for i in range(len(names))]
    members = [_members(d).alias(f"_members{i}") for i, d in enumerate(dimensions)]
    held = cubes.select(key, guarded.alias("_value"), *strides, *sizes, *members)

    def cell(v: Column, at: Column) -> Column:
        parts = [at.alias("cell")]
        for i, name in enumerate(names):
            place = (F.floor(at / F.col(f"_stride{i}")) % F.col(f"_size{i}")).cast("int")
            # Two reads of the sorted members keep them from being sorted again per cell.
            parts += [F.get(f"_members{i}", place)["code"].alias(f"{name}_code"), F.get(f"_members{i}", place)["label"].alias(name)]
        return F.struct(*parts, v.alias("value"))

    return held.select(key, F.inline(F.transform("_value", cell)))


def cube_cells_to_grain(
    cells: DataFrame,
    value: str = "value",
    drop: dict[str, str] | None = None,
    keep: dict[str, Sequence[str]] | None = None,
    count: str | None = None,
) -> DataFrame:
    """Drop total members and empty cells, keep wanted members, fail on fractions."""
    rows = cells.filter(F.col(value).isNotNull())
    for column, member in (drop or {}).items():
        rows = drop_totals(rows, column, member)
    for column, members in (keep or {}).items():
        rows = in_domain(rows, column, members)
    problem = F.concat(F.lit("cell is not a whole number: "), F.col(value).cast("string"))
    # A filter, as it is kept whatever columns are read later.
    rows = rows.filter(F.when(F.col(value) % 1 == 0, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))
    return rows.select(*[c for c in cells.columns if c != value], F.col(value).cast("bigint").alias(count or value))


def drop_totals(df: DataFrame, column: str, total: str) -> DataFrame:
    return df.filter(F.col(column) != total)


def in_domain(df: DataFrame, column: str, members: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(members)))
