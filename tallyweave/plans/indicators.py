"""One published source from page or records to tidy, harmonised and audited rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.functions.numbers import safe_ratio, strip_code_prefix
from tallyweave.operators import coverage, harmonize as H, measures as M
from tallyweave.sources.html import html_to_lines
from tallyweave.sources.lines import SectionRules, parse_sectioned_lines
from tallyweave.sources.tables import choose_source, rows_of_chosen

GROUP_COLUMNS = ["source", "name", "status", "notes"]


@dataclass(frozen=True)
class ReadingTables:
    rows: DataFrame
    issues: DataFrame
    choice: DataFrame
    audit: DataFrame
    harmonization_audit: DataFrame


def build_reading(
    pages: DataFrame,
    rules: SectionRules,
    group_crosswalk: DataFrame,
    variants: dict[str, tuple[str, str, str]] | None = None,
    minimum: int = K.MIN_SOURCE_ENTITIES,
) -> ReadingTables:
    """Pages ``(page, priority, html)`` to harmonised long rows of the chosen page.

    Every page is parsed; the first in line with enough entities is used, else the last.
    """
    lines = html_to_lines(pages, "page", "html")
    rows, issues = parse_sectioned_lines(lines, "page", "line_no", rules)
    parsed = rows.join(pages.select("page", "priority"), "page")
    # Sources without a single row still stand in line as fallback.
    candidates = pages.select("page", "priority").join(rows.select("page", "entity").distinct(), "page", "left")
    choice = choose_source(candidates, "page", "entity", "priority", minimum)
    chosen = rows_of_chosen(parsed, "page", choice).drop("priority")
    out = H.harmonize(chosen, "entity", group_crosswalk, GROUP_COLUMNS, "ordinal", ["group", "status", "note"], variants)
    return ReadingTables(
        out,
        issues,
        choice,
        coverage.extraction_audit(out, "value", ["year", "period", "entity", "metric"], issues=issues),
        coverage.harmonization_audit(out, "entity", "group", "status", "note", "record_no"),
    )


@dataclass(frozen=True)
class SpendingTables:
    entities: DataFrame
    spending: DataFrame
    missing: DataFrame


def build_spending(
    records: DataFrame,
    measures: dict[str, str],
    group_crosswalk: DataFrame,
    population: DataFrame,
    on_duplicate: str = "last",
) -> SpendingTables:
    """Text records ``(year, area, entity, count, measures)`` to money per group and unit.

    ``population``: year, group, total, band, ordinal.
    """
    typed = M.typed_entity_rows(
        records.withColumn("source", strip_code_prefix("area")), "year", "count", measures, keep=["source", "entity"]
    )
    entities = H.harmonize(typed, "source", group_crosswalk, GROUP_COLUMNS, "ordinal", ["group", "status", "note"])
    rolled = M.rollup_sum(entities, ["year", "source", "group"], list(measures), "count", ("status", "note"))
    long = M.unpivot_measures(rolled, ["year", "source", "group", "status", "note", "count"], list(measures))
    keyed = population.withColumn("year", F.col("year").cast("bigint"))
    spending = M.attach_denominators(
        long.withColumn("per_unit", safe_ratio("amount", "count")), ["year", "group"], "amount", keyed, "ordinal",
        looked_up={"total": "per_person", "band": "per_band_person"}, on_duplicate=on_duplicate,
    )
    return SpendingTables(entities, spending, M.missing_denominators(long, ["year", "group"], keyed, "group"))


def build_population(
    cells: DataFrame, group_crosswalk: DataFrame, total_area: str, total_member: str, band: Sequence[str]
) -> DataFrame:
    """Cube cells ``(year, area, member, people, cell)`` to denominators per year and area."""
    totals = M.conditional_totals(
        cells.filter(F.col("area") != total_area), ["year", "area"], "member", "people", total_member, band, "cell"
    )
    return H.harmonize(totals, "area", group_crosswalk, GROUP_COLUMNS, "ordinal", ["group", "status", "note"])
