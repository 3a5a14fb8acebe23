"""Ordered text lines to typed rows: pattern rows under headings, sectioned records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave import constants as K
from tallyweave.functions.names import is_small_group
from tallyweave.functions.numbers import (
    map_codes,
    percent_issue,
    percent_suppressed,
    percent_value,
    school_year_from_label,
    strip,
)
from tallyweave.operators.scan import BLOCK_ROWS, carry_down, in_several_blocks, keys_among, ordered_scan
from tallyweave.session import shared


def parse_regex_line(
    lines: DataFrame,
    keys: Sequence[str],
    order: str,
    text: str,
    pattern: str,
    fields: Sequence[tuple[str, str]],
    heading: str,
    skip_prefixes: Sequence[str] = (),
    skip_numbers: bool = True,
    small_group_labels: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Typed rows of lines that match ``pattern``; other lines are section headings.

    ``fields`` names and types the pattern's groups in order. Page furniture (a bare
    page number, the given prefixes) is skipped. The raw line is kept, and ``issue``
    says so where a row has no heading above it within its ``keys``.
    """
    furniture = F.lit(False)
    if skip_numbers:
        furniture = furniture | F.col(text).rlike("^[0-9]+$")
    for prefix in skip_prefixes:
        furniture = furniture | F.startswith(F.col(text), F.lit(prefix))
    useful = lines.filter(~furniture).withColumn("_row", F.col(text).rlike(pattern))
    headed = carry_down(useful, keys, order, F.when(~F.col("_row"), F.col(text)), heading, block_rows)
    rows = headed.filter("_row")
    typed = [
        F.regexp_extract(F.col(text), pattern, i).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(fields, start=1)
    ]
    out = rows.select(
        *keys,
        order,
        heading,
        *typed,
        F.when(F.col(heading).isNull(), F.lit("row without a heading above it")).alias("issue"),
        F.col(text).alias("raw_text"),
    )
    if small_group_labels:
        entity = fields[0][0]
        out = out.withColumn("is_small_group", is_small_group(small_group_labels, entity, heading))
    return out


@dataclass(frozen=True)
class SectionRules:
    """How to read a sectioned document of entities, periods, years and percents."""

    metrics: Sequence[str]
    periods: dict[str, str]
    year_pattern: str = K.SCHOOL_YEAR_PATTERN
    skip_lines: Sequence[str] = ()
    skip_prefixes: Sequence[str] = ()
    stop: Column | None = None
    early_heading: Column | None = None
    not_heading_prefixes: Sequence[str] = ("1.", "3.", "4.")
    block_rows: int = BLOCK_ROWS
    text: str = field(default="text")


def _classified(lines: DataFrame, doc: str, order: str, rules: SectionRules) -> DataFrame:
    """Lines with their kind: stop, period, year, mark (a percent or dash), other."""
    text = F.col(rules.text)
    skip = text.isin(list(rules.skip_lines) or [""])
    for prefix in rules.skip_prefixes:
        skip = skip | F.startswith(text, F.lit(prefix))
    is_mark = text.rlike(K.PERCENT_PATTERN) | text.isin([m for m in K.SUPPRESSED_MARKS if m])
    kind = (
        F.when(rules.stop if rules.stop is not None else F.lit(False), "stop")
        .when(skip, "skip")
        .when(text.isin(list(rules.periods)), "period")
        .when(text.rlike(rules.year_pattern), "year")
        .when(is_mark, "mark")
        .otherwise("other")
    )
    trailing = F.filter(F.split(F.regexp_extract(text, rules.year_pattern, 3), r"\s+"), lambda v: v != "")
    return (
        lines.select(doc, order, strip(text).alias(rules.text))
        .withColumn("_kind", kind)
        .filter("_kind <> 'skip'")
        .withColumn("_inline", F.when(F.col("_kind") == "year", F.size(trailing)))
        .withColumn("_trailing", F.when(F.col("_kind") == "year", trailing))
    )


def _placed(lines: DataFrame, doc: str, order: str, rules: SectionRules, scan: Callable[..., DataFrame]) -> DataFrame:
    """Lines of the table with their record number, place in the record and headings.

    A record opens at a year line and takes the marks that follow directly, up to one
    per metric; any other line closes it. A mark outside an open record counts as a
    heading, as any unknown text does, and so makes what follows it an issue until
    the next period line.
    """
    n = len(rules.metrics)
    kind = F.col("_kind")
    is_year, is_mark = kind == "year", kind == "mark"
    lines = scan(
        _classified(lines, doc, order, rules),
        [doc],
        order,
        last={"_line_inline": F.col("_inline")},
        sums={
            "record_no": is_year.cast("bigint"),
            "_periods": (kind == "period").cast("bigint"),
            "_stops": (kind == "stop").cast("bigint"),
        },
        since={
            "_marks": (is_mark.cast("bigint"), is_year),
            "_closers": ((~is_year & ~is_mark).cast("bigint"), is_year),
        },
    ).filter("_stops = 0")
    inline = F.col("_line_inline")
    place = inline + F.col("_marks")
    # Values printed on the year line itself that are too many leave the record open.
    in_record = (
        is_mark & (F.col("_closers") == 0) & (inline != n) & ((place <= n) | (inline > n))
    )
    lines = lines.withColumn("_in_record", F.coalesce(in_record, F.lit(False)))

    text, seen = F.col(rules.text), F.col("_periods") > 0
    unclaimed = (kind == "other") | (is_mark & ~F.col("_in_record"))
    early = rules.early_heading if rules.early_heading is not None else F.lit(True)
    numbered = F.lit(False)
    for prefix in rules.not_heading_prefixes:
        numbered = numbered | F.startswith(text, F.lit(prefix))
    is_heading = unclaimed & F.when(seen, ~numbered).otherwise(early)
    return scan(
        lines,
        [doc],
        order,
        last={
            "_heading": F.when(is_heading, F.struct(F.col(order).alias("at"), text.alias("text"), seen.alias("seen"))),
            "_period": F.when(
                kind == "period", F.struct(F.col(order).alias("at"), map_codes(text, rules.periods).alias("code"))
            ),
        },
    )


def parse_sectioned_lines(
    lines: DataFrame, doc: str, order: str, rules: SectionRules
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc, record_no, year, period, entity, metric, value, suppressed)`` and issues.

    A record counts only if it has one value per metric, a period, and an entity whose
    heading stands above that period. Every line of a record that does not, and every
    value that cannot be read, becomes an issue row ``(doc, line, record, issue, text)``,
    one per line, so even an endless broken record never has to be gathered.

    All documents take one plan: lines are scanned in blocks of ``block_rows``, whose states
    are carried across, so a document of any length spreads over many tasks. The lines are
    dealt once by document and block, and once more, read, by record. A record of at most as
    many values as metrics is counted where its lines meet; one that prints too many on its
    year line may go on without end, so its lines are joined with their count, in a pass
    over the documents that have such a line.
    """
    n = len(rules.metrics)
    own = lines.select(doc, order, F.col(rules.text))
    several = in_several_blocks(own, [doc], order, rules.block_rows)
    scan = partial(ordered_scan, block_rows=rules.block_rows, several=several)
    used = (F.col("_kind") == "year") | F.col("_in_record")
    kept = [doc, order, "record_no", rules.text, "_kind", "_in_record", "_inline", "_trailing", "_line_inline", "_marks", "_heading", "_period"]

    # A period line is no part of a record and meets no other line.
    placed = _placed(own, doc, order, rules, scan).filter((F.col("_kind") == "period") | (used & (F.col("_line_inline") <= n)))
    record = Window.partitionBy(doc, "record_no", "_alone")
    alone = F.when(F.col("_kind") == "period", F.col(order))
    counted = placed.select(*kept).withColumn("_alone", alone).withColumns({k: c.over(record) for k, c in _of_record(rules).items()})

    long_docs = keys_among(_classified(own, doc, order, rules).filter(F.col("_inline") > n), [doc])
    endless = _placed(own.filter(long_docs), doc, order, rules, scan).filter(used & (F.col("_line_inline") > n))
    endless = shared(endless.select(*kept), doc, "record_no")
    counts = endless.groupBy(doc, "record_no").agg(*[c.alias(k) for k, c in _of_record(rules).items()])
    return _parsed(counted, endless.join(counts, [doc, "record_no"]), doc, order, rules)


def _of_record(rules: SectionRules) -> dict[str, Column]:
    """What the lines of a record share: the number of its values and its year."""
    year_line = F.col("_kind") == "year"
    return {
        "_found": F.sum(F.when(year_line, F.col("_inline")).otherwise(F.lit(1))),
        "_year_text": F.max(F.when(year_line, F.col(rules.text))),
    }


def _parsed(
    counted: DataFrame, endless: DataFrame, doc: str, order: str, rules: SectionRules
) -> tuple[DataFrame, DataFrame]:
    n = len(rules.metrics)
    heading, period, text = F.col("_heading"), F.col("_period"), F.col(rules.text)
    period_line, year_line = F.col("_kind") == "period", F.col("_kind") == "year"
    # No heading or period line stands between a year line and the marks of its record.
    headed = F.coalesce(
        period.isNotNull() & heading.isNotNull() & (heading["at"] < period["at"]), F.lit(False)
    )
    complete = headed & heading["text"].isNotNull() & period["code"].isNotNull()
    good = ~period_line & complete & (F.col("_found") == n)
    texts = F.when(year_line, F.col("_trailing")).otherwise(F.array(text))
    first = F.when(year_line, F.lit(0)).otherwise(F.col("_line_inline") + F.col("_marks") - 1)
    metric_names = F.array(*[F.lit(m) for m in rules.metrics])
    rows = (
        counted.filter(good)
        .select("*", first.alias("_first"), F.posexplode(texts).alias("_i", "raw_value"))
        .select(
            doc,
            "record_no",
            school_year_from_label("_year_text").alias("year"),
            period["code"].alias("period"),
            heading["text"].alias("entity"),
            F.get(metric_names, F.col("_first") + F.col("_i")).alias("metric"),
            percent_value("raw_value").alias("value"),
            percent_suppressed("raw_value").alias("suppressed"),
        )
    )

    def issue(message: Column, raw: Column) -> Column:
        return F.struct(message.alias("issue"), raw.alias("raw_text"))

    none = F.array().cast("array<struct<issue:string,raw_text:string>>")
    reason = F.when(~complete, F.lit("record without entity or period")).otherwise(
        F.concat(F.lit("unexpected value count: "), F.col("_found").cast("string"))
    )
    unread = F.transform(F.filter(texts, lambda v: percent_issue(v).isNotNull()), lambda v: issue(percent_issue(v), v))
    found = (
        F.when(period_line, F.when(heading.isNull(), F.array(issue(F.lit("period line without entity"), text))).otherwise(none))
        .when(good, unread)
        .otherwise(F.array(issue(reason, text)))
    )
    issues = counted.select(doc, order, "record_no", F.inline(found)).unionByName(
        endless.select(doc, order, "record_no", reason.alias("issue"), text.alias("raw_text"))
    )
    return rows, issues
