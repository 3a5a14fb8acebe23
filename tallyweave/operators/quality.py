"""Data-quality rules: each gives rows ``(check, table, row_key, column, observed, message)``.

No row means the rule holds. Rules on single rows are values of ``Rule``; any number
of them run in one pass over the table with ``check_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave import constants as K
from tallyweave.functions.numbers import NUMBER_PATTERN, blank_to_null, strip
from tallyweave.operators.keys import key_set_difference_both_ways

# Keeps a difference of exactly the tolerance on the passing side despite float noise.
_HAIR = 1e-9
FIELDS = ["check", "table", "row_key", "column", "observed", "message"]


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def row_key(*columns: str) -> Column:
    return F.concat_ws(" | ", *[_text(F.col(c)) for c in columns])


def _violations(rows: DataFrame, check: str, table: str, key: Column, column: str, observed: Column, message: Column | str) -> DataFrame:
    message = F.lit(message) if isinstance(message, str) else message
    return rows.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        _text(key).alias("row_key"),
        F.lit(column).alias("column"),
        _text(observed).alias("observed"),
        message.alias("message"),
    )


@dataclass(frozen=True)
class Rule:
    """A rule on one row: it is broken where ``broken`` is true (NULL is not)."""

    check: str
    column: str
    broken: Column
    observed: Column
    message: str


def check_rows(df: DataFrame, table: str, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """All broken rules of all rows, in one scan and without a shuffle.

    A row carries the numbers of the rules it breaks; texts are made for those only.
    """
    numbers = F.array(*[F.when(r.broken, F.lit(i)).otherwise(F.lit(-1)) for i, r in enumerate(rules)])
    broken = df.withColumn("_rule", F.explode(F.array_remove(numbers, -1)))

    def of_rule(values: Sequence[Column]) -> Column:
        chain = F.when(F.col("_rule") == 0, values[0])
        for i, value in enumerate(values[1:], start=1):
            chain = chain.when(F.col("_rule") == i, value)
        return chain

    return broken.select(
        of_rule([F.lit(r.check) for r in rules]).alias("check"),
        F.lit(table).alias("table"),
        row_key(*key).alias("row_key"),
        of_rule([F.lit(r.column) for r in rules]).alias("column"),
        of_rule([_text(r.observed) for r in rules]).alias("observed"),
        of_rule([F.lit(r.message) for r in rules]).alias("message"),
    )


def expect_numeric(column: str, allow_blank: bool = True) -> Rule:
    text = F.coalesce(strip(F.col(column).cast("string")), F.lit(""))
    allowed = NUMBER_PATTERN[1:-1] + "|(?i:nan)" + ("|" if allow_blank else "")
    return Rule("numeric", column, ~text.rlike(f"^({allowed})$"), F.col(column), "not a number")


def expect_range(
    column: str, low: float | None = None, high: float | None = None, above: float | None = None, whole: bool = False
) -> Rule:
    """Values inside bounds (``above`` is exclusive), whole if asked; NULL passes.

    Text that is no number passes too; ``expect_numeric`` reports that.
    """
    v = F.nanvl(F.col(column).try_cast("double"), F.lit(None).cast("double"))
    broken = F.lit(False)
    if low is not None:
        broken = broken | (v < low)
    if high is not None:
        broken = broken | (v > high)
    if above is not None:
        broken = broken | (v <= above)
    if whole:
        broken = broken | (v % 1 != 0)
    return Rule("range", column, broken, F.col(column), "outside the allowed range")


def expect_blank(column: str) -> Rule:
    return Rule("blank", column, blank_to_null(F.col(column).cast("string")).isNotNull(), F.col(column), "must stay blank")


def expect_sum(
    parts: Sequence[str], whole: str | None = None, total: float = 100.0, tolerance: float = 1.1, name: str = "sum"
) -> Rule:
    """Parts add up to a column or a constant; checked only if all of them are present."""
    added = F.lit(0.0)
    for p in parts:
        added = added + F.col(p).cast("double")
    target = F.col(whole).cast("double") if whole else F.lit(total)
    return Rule(name, whole or "+".join(parts), F.abs(added - target) > tolerance + _HAIR, F.round(added - target, 4), "parts do not add up")


def expect_ratio(column: str, numerator: str, denominator: str, tolerance: float = 0.02) -> Rule:
    ratio = F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))
    return Rule("ratio", column, F.abs(F.col(column) - ratio) > tolerance + _HAIR, F.col(column), f"differs from {numerator}/{denominator}")


def expect_bounded_by(part: str, whole: str) -> Rule:
    return Rule("bounded_by", part, F.col(part) > F.col(whole), F.col(part), f"exceeds {whole}")


def expect_implies(name: str, condition: Column, consequence: Column, column: str) -> Rule:
    broken = F.coalesce(condition, F.lit(False)) & ~F.coalesce(consequence, F.lit(False))
    return Rule("implies", column, broken, F.col(column), name)


def expect_status_absent(column: str, status: str = K.NEEDS_REVIEW) -> Rule:
    return Rule("status_absent", column, F.col(column) == status, F.col(column), f"status {status} is left")


def expect_not_blank(column: str) -> Rule:
    return Rule("not_blank", column, blank_to_null(F.col(column).cast("string")).isNull(), F.col(column), "must not be blank")


def require_columns(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    rows = df.sparkSession.createDataFrame([(c,) for c in missing], "c string")
    return rows.select(
        F.lit("columns").alias("check"), F.lit(table).alias("table"), F.lit("").alias("row_key"),
        F.col("c").alias("column"), F.lit("").alias("observed"), F.lit("column is missing").alias("message"),
    )


def require_rows(df: DataFrame, table: str, exactly: int | None = None) -> DataFrame:
    """At least one row, or exactly so many. Without a count one row is enough to look at."""
    counted = (df if exactly is not None else df.limit(1)).agg(F.count(F.lit(1)).alias("n"))
    broken = F.col("n") != exactly if exactly is not None else F.col("n") == 0
    text = f"expected {exactly} rows" if exactly is not None else "table is empty"
    return _violations(counted.filter(broken), "rows", table, F.lit(""), "", F.col("n"), text)


def expect_domain(df: DataFrame, table: str, column: str, members: Sequence[str]) -> DataFrame:
    """Distinct values are exactly ``members``; both unknown and missing ones are listed."""
    text = df.select(F.col(column).cast("string").alias("v")).distinct()
    expected = df.sparkSession.createDataFrame([(m,) for m in members], "v string")
    odd = key_set_difference_both_ways(text, expected)
    message = F.when(F.col("side") == "left_only", "value outside the domain").otherwise("value never occurs")
    return _violations(odd, "domain", table, F.col("v"), column, F.col("v"), message)


def expect_cardinality(df: DataFrame, table: str, column: str, exactly: int | None = None, at_least: int | None = None) -> DataFrame:
    counted = df.agg(F.count_distinct(column).alias("n"))
    broken = F.lit(False)
    if exactly is not None:
        broken = broken | (F.col("n") != exactly)
    if at_least is not None:
        broken = broken | (F.col("n") < at_least)
    return _violations(counted.filter(broken), "cardinality", table, F.lit(""), column, F.col("n"), "unexpected number of distinct values")


def expect_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _violations(repeated, "unique", table, row_key(*keys), "+".join(keys), F.col("n"), "key is repeated")


def expect_complete_grid(df: DataFrame, table: str, keys: Sequence[str], metric: str, metrics: Sequence[str]) -> DataFrame:
    """Every observation has every metric. Sets hold expected metrics only, so they stay small."""
    expected = F.array(*[F.lit(m) for m in metrics])
    known = F.when(F.col(metric).isin(list(metrics)), F.col(metric))
    seen = df.groupBy(*keys).agg(F.collect_set(known).alias("_seen"))
    missing = F.array_join(F.array_except(expected, "_seen"), "; ")
    return _violations(
        seen.filter(F.size("_seen") < len(metrics)), "complete_grid", table, row_key(*keys), metric, missing, "metrics are missing"
    )


def expect_grid_size(df: DataFrame, table: str, entity: str, metrics: int) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(entity).alias("e"))
    return _violations(
        counted.filter(F.col("n") != F.col("e") * metrics), "grid_size", table, F.lit(""), entity, F.col("n"),
        f"row count is not entities x {metrics}",
    )


def expect_preserved(before: DataFrame, after: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Every original row is still there once and its columns are unchanged.

    Rows are matched by a unique key, since a table has no row positions.
    """
    columns = [c for c in before.columns if c not in keys]
    b = before.select(*keys, F.struct(F.lit(1).alias("_"), *columns).alias("_b"))
    a = after.select(*keys, F.struct(F.lit(1).alias("_"), *columns).alias("_a"))
    both = b.join(a, list(keys), "full_outer")
    changed = F.filter(
        F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in columns]), lambda c: c.isNotNull()
    )
    message = (
        F.when(F.col("_a").isNull(), "row was lost").when(F.col("_b").isNull(), "row was added").otherwise("columns changed")
    )
    matched = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    odd = both.filter(~matched | (F.size(changed) > 0))
    return _violations(odd, "preserved", table, row_key(*keys), "", F.when(matched, F.array_join(changed, "; ")), message)


def expect_mapping(df: DataFrame, table: str, source: str, target: str, expected: dict[str, str], required: bool = False) -> DataFrame:
    """Listed sources lead to their listed target; with ``required`` each must occur."""
    pairs = df.sparkSession.createDataFrame(list(expected.items()), "_s string, _t string")
    actual = df.select(F.col(source).alias("_s"), F.col(target).alias("_actual")).distinct()
    joined = pairs.join(actual, "_s", "left" if required else "inner")
    wrong = joined.filter(~F.col("_actual").eqNullSafe(F.col("_t")))
    return _violations(wrong, "mapping", table, F.col("_s"), target, F.col("_actual"), F.concat(F.lit("expected "), F.col("_t")))


def expect_retained(required: DataFrame, downstream: DataFrame, table: str, key: str, group: str) -> DataFrame:
    """Every required entity is downstream and still has its group."""
    kept = downstream.groupBy(key).agg(F.max(blank_to_null(F.col(group).cast("string"))).alias("_g"), F.lit(True).alias("_there"))
    joined = required.select(key).distinct().join(kept, key, "left").filter(F.col("_g").isNull())
    message = F.when(F.col("_there").isNull(), "required entity is missing").otherwise("required entity lost its group")
    return _violations(joined, "retained", table, F.col(key), group, F.col("_g"), message)


def expect_referential(child: DataFrame, parent: DataFrame, table: str, keys: Sequence[str], equal: bool = False) -> DataFrame:
    """Child keys occur in the parent; with ``equal`` also the other way round."""
    c, p = child.select(*keys).distinct(), parent.select(*keys).distinct()
    orphan = _violations(c.join(p, list(keys), "left_anti"), "referential", table, row_key(*keys), "+".join(keys), F.lit(""), "no parent row")
    if not equal:
        return orphan
    childless = _violations(p.join(c, list(keys), "left_anti"), "referential", table, row_key(*keys), "+".join(keys), F.lit(""), "no child row")
    return orphan.unionByName(childless)


def expect_recomputed(
    output: DataFrame, observations: DataFrame, table: str, group: str, period: str, source: str, value: str, tolerance: float = 0.01
) -> DataFrame:
    """Strict and latest values, counts, periods and methods agree with a fresh aggregate.

    The fresh figures come from plain sums and counts per group and period, not from
    the operator under test.
    """
    v = F.col(value)
    newest = observations.agg(F.max(period).alias("p")).select("p").scalar()
    cells = observations.groupBy(group, period).agg(
        F.struct(
            F.col(period).alias("period"),
            F.count_distinct(F.when(F.col(source) != "", F.col(source))).alias("sources"),
            F.count(v).alias("n"),
            F.round(F.avg(v), 2).alias("mean"),
        ).alias("_fact")
    )
    sources = observations.groupBy(group).agg(F.count_distinct(source).alias("_all_sources"))
    fresh = cells.withColumn("_newest", newest).groupBy(group).agg(
        F.max("_newest").alias("_newest"),
        F.max_by("_fact", F.when(F.col(period) == F.col("_newest"), F.col(period))).alias("_s"),
        F.max_by("_fact", F.when(F.col("_fact.n") > 0, F.col(period))).alias("_l"),
    ).join(sources, group)
    joined = fresh.join(output.withColumn("_there", F.lit(True)), group, "left")

    def off(stored: str, expected: Column) -> Column:
        return ~F.col(stored).eqNullSafe(expected) & ~F.coalesce(F.abs(F.col(stored) - expected) <= tolerance + _HAIR, F.lit(False))

    zero = F.lit(0).cast("bigint")
    strict_n, strict_sources = F.coalesce(F.col("_s.n"), zero), F.coalesce(F.col("_s.sources"), F.col("_all_sources"))
    several = F.col("_all_sources") > 1
    allowed = [K.METHOD_SINGLE, K.METHOD_AVERAGE, K.METHOD_NONE]
    found = {
        "group is missing": F.col("_there").isNull(),
        "strict period": ~F.col("strict_period").eqNullSafe(F.col("_newest")),
        "strict value": off("strict_value", F.col("_s.mean")),
        "strict component count": F.col("strict_component_count") != strict_sources,
        "strict nonmissing count": F.col("strict_nonmissing_component_count") != strict_n,
        "latest period": ~F.col("latest_period").eqNullSafe(F.col("_l.period")),
        "latest value": off("latest_value", F.col("_l.mean")),
        "latest component count": F.col("latest_component_count") != F.coalesce(F.col("_l.sources"), F.col("_all_sources")),
        "latest nonmissing count": F.col("latest_nonmissing_component_count") != F.coalesce(F.col("_l.n"), zero),
        "method": several & ~(F.col("strict_method").isin(allowed) & F.col("latest_method").isin(allowed)),
    }
    broken = F.filter(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in found.items()]), lambda m: m.isNotNull()
    )
    rows = joined.select(F.col(group).alias("_g"), F.explode(broken).alias("_m"))
    return _violations(rows, "recomputed", table, F.col("_g"), value, F.lit(""), F.col("_m"))


def expect_queue(queue: DataFrame, unresolved: DataFrame, table: str, key: str, must_be_empty: bool = False) -> DataFrame:
    """The review queue holds exactly the unresolved names; a required queue is empty."""
    odd = key_set_difference_both_ways(queue.select(key).distinct(), unresolved.select(key).distinct())
    message = F.when(F.col("side") == "left_only", "queued but resolved").otherwise("unresolved but not queued")
    out = _violations(odd, "queue", table, F.col(key), key, F.lit(""), message)
    if must_be_empty:
        out = out.unionByName(_violations(queue, "queue", table, F.col(key), key, F.lit(""), "queue must be empty"))
    return out


def expect_items(audit: DataFrame, table: str, item: str, value: str, expected: dict[str, str | None]) -> DataFrame:
    """The audit names every item, with the listed value where one is given."""
    wanted = audit.sparkSession.createDataFrame(list(expected.items()), "_i string, _v string")
    present = audit.filter(F.col(item).isin(list(expected))).select(F.col(item).alias("_i"), F.col(value).cast("string").alias("_a"), F.lit(True).alias("_there"))
    joined = wanted.join(present, "_i", "left")
    broken = joined.filter(F.col("_there").isNull() | (F.col("_v").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_v"))))
    message = F.when(F.col("_there").isNull(), "item is missing").otherwise("item has another value")
    return _violations(broken, "items", table, F.col("_i"), value, F.col("_a"), message)


def quality_report(violations: DataFrame, limit: int = 30) -> DataFrame:
    """One ``result`` row with pass or fail and the total, then the first ``limit`` messages.

    Showing the first messages is what a report does; the violations table stays whole.
    """
    total = violations.agg(F.count(F.lit(1)).alias("n"))
    head = total.select(
        F.lit(0).cast("bigint").alias("line"),
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("result"),
        F.concat(F.col("n").cast("string"), F.lit(" violation(s)")).alias("message"),
    )
    first = violations.orderBy(*FIELDS).limit(limit)
    numbered = first.withColumn("line", F.row_number().over(Window.orderBy(*FIELDS)).cast("bigint"))
    text = F.concat_ws(" ", F.concat("table", F.lit(":")), "check", "column", "row_key", F.concat(F.lit("("), F.col("observed"), F.lit(")")), "message")
    return head.unionByName(numbered.select("line", F.lit("violation").alias("result"), text.alias("message")))
