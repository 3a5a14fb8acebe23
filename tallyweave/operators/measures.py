"""Roll-ups, averages with their method, shares, ratios and reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.functions.notes import sorted_list
from tallyweave.functions.numbers import as_col, parse_int, parse_number, safe_ratio, stable_round, whole
from tallyweave.operators.keys import dedup


def typed_entity_rows(
    df: DataFrame, year: str, count: str, measures: dict[str, str], keep: Sequence[str] = (), decimal_comma: bool = True
) -> DataFrame:
    """Text record to typed row: whole year and count, measures in whole units, blank to NULL.

    ``measures`` maps an output name to its source column.
    """
    return df.select(
        parse_int(year).alias(year),
        *keep,
        parse_int(count, decimal_comma).alias(count),
        *[whole(parse_number(c, decimal_comma)).alias(name) for name, c in measures.items()],
    )


def rollup_sum(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str | None = None, status: tuple[str, str] | None = None
) -> DataFrame:
    """Measures summed from entity to group; NULLs are skipped and an all-NULL sum is 0.

    ``status`` names a status and a note column to roll up along with them.
    """
    aggregates = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    if count:
        aggregates.append(F.coalesce(F.sum(count), F.lit(0)).alias(count))
    if status:
        aggregates += [status_rollup(status[0]).alias(status[0]), sorted_list(status[1], separator=" | ").alias(status[1])]
    return df.groupBy(*keys).agg(*aggregates)


def status_rollup(status: Column | str, winner: str = K.HARMONIZED) -> Column:
    """Aggregate: ``winner`` if any row has it, else the smallest status."""
    c = as_col(status)
    return F.coalesce(F.max(F.when(c == winner, c)), F.min(c))


def sum_or_null(c: Column | str) -> Column:
    """Aggregate: sum of the values, NULL when there is none."""
    return F.sum(as_col(c))


def weighted_average(value: Column | str, weight: Column | str) -> Column:
    """Aggregate: mean of rows that have a value and a positive weight, else NULL."""
    v, w = as_col(value), as_col(weight)
    usable = v.isNotNull() & (w > 0)
    return F.try_divide(F.sum(F.when(usable, v * w)).cast("double"), F.sum(F.when(usable, w)).cast("double"))


def simple_average(value: Column | str) -> Column:
    return F.avg(as_col(value))


def weighted_or_simple(value: Column | str, weight: Column | str) -> Column:
    return F.coalesce(weighted_average(value, weight), simple_average(value))


def weighting_method(*weighted: Column) -> Column:
    """One label for several averages: weighted if any of them could be."""
    return F.when(F.coalesce(*weighted).isNotNull(), F.lit(K.WEIGHTED)).otherwise(F.lit(K.UNWEIGHTED))


def coverage_share(weight: Column | str, covered: Column) -> Column:
    """Aggregate: weight of covered rows over all weight to 4 digits, NULL when there is none."""
    w = F.coalesce(as_col(weight), F.lit(0))
    return safe_ratio(F.sum(F.when(covered, w).otherwise(F.lit(0))), F.sum(w), 4)


def conditional_totals(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    value: str,
    total_member: str,
    band: Sequence[str],
    order: str,
    total_name: str = "total",
    band_name: str = "band",
) -> DataFrame:
    """The total member's cell and the sum of the band's members; groups without a total drop.

    The last total cell counts when there are several.
    """
    v = F.col(value)
    is_total = (F.col(member) == total_member) & v.isNotNull()
    totals = df.groupBy(*keys).agg(
        F.max_by(v, F.when(is_total, F.col(order))).alias("_total"),
        F.count_if(is_total).alias("_has"),
        F.coalesce(F.sum(F.when(F.col(member).isin(list(band)), v)), F.lit(0)).alias(band_name),
    )
    return totals.filter("_has > 0").select(*keys, F.col("_total").alias(total_name), band_name)


def unpivot_measures(
    df: DataFrame, ids: Sequence[str], measures: Sequence[str], metric: str = "metric", value: str = "amount"
) -> DataFrame:
    """One row per measure; every group gets every metric, NULLs included."""
    return df.unpivot(list(ids), list(measures), metric, value)


def pivot_metrics(
    df: DataFrame, keys: Sequence[str], metric: str, metrics: Sequence[str], values: Sequence[str], order: str | None = None
) -> DataFrame:
    """Listed metrics side by side as ``metric_value`` columns; the last row counts on repeats."""
    aggregates = []
    for m in metrics:
        for v in values:
            is_m = F.col(metric) == m
            by = F.when(is_m, F.col(order)) if order else F.when(is_m, F.lit(1))
            aggregates.append(F.max_by(F.col(v), by).alias(f"{m}_{v}"))
    return df.filter(F.col(metric).isin(list(metrics))).groupBy(*keys).agg(*aggregates)


def align_metrics(df: DataFrame, keys: Sequence[str], metric: str, value: str, columns: dict[str, str]) -> DataFrame:
    """Metrics of one observation side by side, named by ``columns``: metric to column."""
    picked = [F.max(F.when(F.col(metric) == m, F.col(value))).alias(c) for m, c in columns.items()]
    return df.groupBy(*keys).agg(*picked)


def attach_denominators(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    denominators: DataFrame,
    order: str,
    own: dict[str, str] | None = None,
    looked_up: dict[str, str] | None = None,
    on_duplicate: str = "last",
) -> DataFrame:
    """Every input row, its denominators and the amount per unit of each.

    ``own`` maps a denominator column of ``df`` to its ratio column, ``looked_up`` one of
    the ``denominators`` table. That table has one row per key after ``on_duplicate``,
    so the row count is kept.
    """
    own, looked_up = own or {}, looked_up or {}
    one = dedup(denominators.select(*keys, *looked_up, F.col(order).alias("_o")), keys, "_o", on_duplicate, list(looked_up))
    joined = df.join(one.drop("_o"), list(keys), "left")
    ratios = {r: safe_ratio(amount, d) for d, r in {**own, **looked_up}.items()}
    return joined.withColumns(ratios)


def missing_denominators(df: DataFrame, keys: Sequence[str], denominators: DataFrame, name: str) -> DataFrame:
    """Distinct names with at least one row that finds no denominator."""
    return df.join(denominators.select(*keys).distinct(), list(keys), "left_anti").select(name).distinct()


def _cells(df: DataFrame, group: str, period: str, source: str, value: str, order: str | None) -> DataFrame:
    """One row per (group, period, source): count, sum and first value.

    This is where all rows shrink, before any shuffle by group alone.
    """
    v = F.col(value)
    first = F.min_by(v, F.when(v.isNotNull(), F.col(order))) if order else F.min(v)
    return df.groupBy(group, period, source).agg(
        F.count(v).alias("_n"), F.sum(v.cast("double")).alias("_s"), first.cast("double").alias("_first")
    )


def _per_period(cells: DataFrame, group: str, period: str, source: str) -> DataFrame:
    name = F.when(F.col(source) != "", F.col(source))
    named_value = F.when(F.col("_n") > 0, name)
    return cells.groupBy(group, period).agg(
        F.struct(
            F.count(name).alias("components"),
            F.sum("_n").alias("nonmissing"),
            F.sum("_s").alias("total"),
            F.min_by("_first", named_value).alias("first"),
            F.count(named_value).alias("valued"),
            F.min(named_value).alias("least"),
        ).alias("_p")
    )


def _averaged(c: str, group: str, period: Column) -> dict[str, Column]:
    """Value, counts, method and note of one selected period held in struct ``c``."""
    part = F.col(c)
    n = F.coalesce(part["nonmissing"], F.lit(0).cast("bigint"))
    alone = F.col("_every") <= 1
    method = (
        F.when(alone, K.METHOD_DIRECT).when(n == 1, K.METHOD_SINGLE).when(n > 1, K.METHOD_AVERAGE).otherwise(K.METHOD_NONE)
    )
    value = F.when(alone, part["first"]).otherwise(F.try_divide(part["total"], n.cast("double")))
    of = F.concat(F.lit(" of "), F.col("_every").cast("string"), F.lit(" components"))
    only = F.coalesce(F.col("_least"), F.col(group))
    note = (
        F.when(alone & (n > 0), F.concat(F.lit("value of "), only))
        .when(alone, F.concat(only, F.lit(" has no value for "), F.coalesce(period, F.lit("any period"))))
        .when(n == 1, F.concat(F.lit("only "), part["least"], F.lit(" has a value"), of))
        .when(n > 1, F.concat(F.lit("unweighted average of "), part["valued"].cast("string"), of))
        .otherwise(F.concat(F.lit("no value"), of))
    )
    found = F.coalesce(part["components"], F.lit(0).cast("bigint"))
    return {
        "period": period,
        "value": stable_round(value),
        "component_count": F.when(found > 0, found).otherwise(F.col("_every")),
        "nonmissing_component_count": n,
        "method": method,
        "note": note,
    }


def _every_component(cells: DataFrame, group: str, source: str) -> DataFrame:
    """Number of distinct component names over all periods of a group, and the least of them."""
    named = cells.select(group, F.when(F.col(source) != "", F.col(source)).alias("_name")).distinct()
    return named.groupBy(group).agg(F.count("_name").alias("_every"), F.min("_name").alias("_least"))


def component_rows(df: DataFrame, group: str, period: str, source: str, value: str) -> DataFrame:
    """The components behind averages as rows: ``(group, period, source, values)``."""
    return df.filter(F.col(source) != "").groupBy(group, period, source).agg(F.count(value).alias("values"))


def component_average(
    df: DataFrame, group: str, period: str, source: str, value: str, order: str | None = None
) -> DataFrame:
    """Per group and period: value, component counts, method and note.

    Notes tell how many components there are; ``component_rows`` lists them.
    """
    cells = _cells(df, group, period, source, value, order)
    out = _per_period(cells, group, period, source).join(_every_component(cells, group, source), group)
    columns = _averaged("_p", group, F.col(period))
    columns.pop("period")
    return out.select(group, period, *[c.alias(n) for n, c in columns.items()])


def strict_and_latest(
    df: DataFrame, group: str, period: str, source: str, value: str, order: str | None = None
) -> DataFrame:
    """Per group the value of the newest period of all, and of its own newest period with a value.

    Columns come with prefixes ``strict_`` and ``latest_``. The newest period of all is
    a scalar subquery over the same input; everything else is a chain of aggregates
    on (group, period, source), (group, period), group. Notes tell how many components
    there are; ``component_rows`` lists them.
    """
    newest = df.agg(F.max(period).alias("p")).select("p").scalar()
    cells = _cells(df, group, period, source, value, order)
    periods = _per_period(cells, group, period, source)
    has_value = F.when(F.col("_p.nonmissing") > 0, F.col(period))
    groups = periods.withColumn("_newest", newest).groupBy(group).agg(
        F.max("_newest").alias("_newest"),
        F.max_by("_p", F.when(F.col(period) == F.col("_newest"), F.col(period))).alias("_strict"),
        F.max_by("_p", has_value).alias("_latest"),
        F.max(has_value).alias("_latest_period"),
    )
    groups = groups.join(_every_component(cells, group, source), group)
    strict = _averaged("_strict", group, F.col("_newest"))
    latest = _averaged("_latest", group, F.col("_latest_period"))
    latest["note"] = F.when(F.col("_latest").isNull(), F.lit("no value found in any period")).otherwise(latest["note"])
    return groups.select(
        group,
        *[c.alias(f"strict_{n}") for n, c in strict.items()],
        *[c.alias(f"latest_{n}") for n, c in latest.items()],
    )


def fallback_used(df: DataFrame, strict: str = "strict_value", latest: str = "latest_value") -> DataFrame:
    return df.filter(F.col(strict).isNull() & F.col(latest).isNotNull())


def multi_component(df: DataFrame, count: str = "strict_component_count") -> DataFrame:
    return df.filter(F.col(count) > 1)


def weak_coverage(df: DataFrame, share: str, threshold: float = K.WEAK_COVERAGE) -> DataFrame:
    """Groups whose share is under the threshold; no share counts as 0."""
    return df.filter(F.coalesce(F.col(share), F.lit(0.0)) < threshold)


def analysis_rows(df: DataFrame, priority: str, excluded: str, key: str) -> DataFrame:
    """Required rows that are not excluded and have a group."""
    return df.filter((F.col(priority) == K.REQUIRED) & ~F.coalesce(F.col(excluded), F.lit(False)) & (F.col(key) != ""))


def slice_rows(df: DataFrame, **equals: str) -> DataFrame:
    """Rows where each named column equals its value."""
    for column, value in equals.items():
        df = df.filter(F.col(column) == value)
    return df


def leading_tokens(folded: str, tokens: int = 2) -> Column:
    return F.array_join(F.slice(F.split(folded, " "), 1, tokens), " ")


def token_pattern_top_k(df: DataFrame, folded: str, order: str, k: int = 10, tokens: int = 2) -> DataFrame:
    """Most common leading tokens of a folded name; ties go to the first seen."""
    counts = df.groupBy(leading_tokens(folded, tokens).alias("pattern")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    return counts.orderBy(F.desc("n"), "first_seen", "pattern").limit(k)


def by_period_profile(df: DataFrame, period: str, entity: str) -> DataFrame:
    """Distinct entities and rows per period."""
    return df.groupBy(period).agg(F.count_distinct(entity).alias("entities"), F.count(F.lit(1)).alias("n_rows"))


def period_audit(
    df: DataFrame, period: str, entity: str, category: str, cells: DataFrame, value: str, totals: dict[str, Column]
) -> DataFrame:
    """Long profile ``(section, period, category, item, value)`` of rows and their source.

    Distinct entities per period; per period the source's own total cells, named by the
    conditions in ``totals`` (NULL where the source has none); rows per category. The
    totals are read from ``cells`` in one pass.
    """
    blank, text = F.lit(""), F.col(period).cast("string")
    entities = df.groupBy(period).agg(F.count_distinct(entity).alias("n"))
    per_period = cells.groupBy(period).agg(*[F.max(F.when(c, F.col(value))).cast("string").alias(t) for t, c in totals.items()])
    found = entities.join(per_period, period, "left")
    items = [F.struct(F.lit("entities_with_rows").alias("item"), F.col("n").cast("string").alias("value"))]
    items += [F.struct(F.lit(t).alias("item"), F.col(t).alias("value")) for t in totals]
    by_period = found.select(F.lit("by_period").alias("section"), text.alias("period"), blank.alias("category"), F.inline(F.array(*items)))
    by_category = df.groupBy(category).agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit("by_category").alias("section"), blank.alias("period"), F.col(category).cast("string").alias("category"),
        F.lit("rows").alias("item"), "value",
    )
    return by_period.unionByName(by_category)


def self_lookup_total(
    df: DataFrame, cells: DataFrame, keys: Sequence[str], total: Column, value: str, out: str
) -> DataFrame:
    """The source's own total cell next to derived counts."""
    totals = cells.filter(total).groupBy(*keys).agg(F.max(value).alias(out))
    return df.join(totals, list(keys), "left")


def status_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def match_rate(df: DataFrame, flags: Sequence[str], matched: Column, counted: Column | None = None) -> DataFrame:
    """Per presence flag: counted rows, matched rows, the rate and its text."""
    counted = counted if counted is not None else F.lit(True)
    rows = df.filter(counted).withColumn("_matched", F.coalesce(matched, F.lit(False)))
    totals = rows.agg(
        *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags],
        *[F.count_if(F.col(f) & F.col("_matched")).alias(f"m_{f}") for f in flags],
    )
    entries = F.array(
        *[F.struct(F.lit(f).alias("source"), F.col(f"n_{f}").alias("total"), F.col(f"m_{f}").alias("matched")) for f in flags]
    )
    matched, total = F.col("matched"), F.col("total")
    found = totals.select(F.inline(entries))
    return found.select("source", "total", "matched", _rate(matched, total).alias("rate"), rate_text(matched, total).alias("rate_text"))


def _rate(matched: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(matched, total), F.lit(0.0))


def rate_text(matched: Column, total: Column) -> Column:
    return F.format_string("%d/%d (%.1f%%)", matched, total, _rate(matched, total) * 100)
