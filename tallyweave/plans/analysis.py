"""The analysis build: tidy tables in, spine, entity table, group summary and audit out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.functions.notes import first_nonblank, join_notes, presence_flag
from tallyweave.operators import coverage, joins, measures as M
from tallyweave.operators.keys import dedup

READING_COLUMNS = ["period", "value", "component_count", "nonmissing_component_count", "method", "note"]


@dataclass(frozen=True)
class AnalysisSettings:
    """Which slice of each table the analysis uses."""

    term: str
    metric: str
    year: str
    primary: str
    secondary: str
    weak_below: float = K.WEAK_COVERAGE


@dataclass(frozen=True)
class AnalysisTables:
    """Lazy outputs; a caller who reads several of them may persist what they share."""

    spine: DataFrame
    entities: DataFrame
    groups: DataFrame
    audit: DataFrame


def build_spine(observations: DataFrame, spending: DataFrame, population: DataFrame, s: AnalysisSettings) -> DataFrame:
    """One row per harmonised group with reading, spending and population columns.

    ``observations``: group, source, school_year, term, metric, value; ``spending``: year,
    group, metric, amount, per_unit, per_person, per_band_person, units, total, band,
    source_url, ordinal; ``population``: year, group, total, band, ordinal. The last row
    of a repeated key counts, as ``ordinal`` says.
    """
    read = M.slice_rows(observations, term=s.term, metric=s.metric)
    reading = M.strict_and_latest(read, "group", "school_year", "source", "value")
    money = ["amount", "per_unit", "per_person", "per_band_person", "units", "total", "band", "source_url"]
    wide = M.pivot_metrics(
        spending.filter(F.col("year").cast("string") == s.year), ["group"], "metric", [s.primary, s.secondary], money, "ordinal"
    )
    people = dedup(
        population.filter(F.col("year").cast("string") == s.year).select("group", "total", "band", "ordinal"), ["group"], "ordinal"
    ).drop("ordinal")
    reading_columns = {f"{p}_{c}": f"{p}_{c}" for p in ("strict", "latest") for c in READING_COLUMNS}
    joined = joins.spine_join(
        "group",
        [
            (reading.withColumn("_r", F.lit(True)), {**reading_columns, "_r": "_r"}),
            (wide.withColumn("_s", F.lit(True)), {**{c: c for c in wide.columns if c != "group"}, "_s": "_s"}),
        ],
        [(people.withColumn("_p", F.lit(True)), {"total": "_total", "band": "_band", "_p": "_p"})],
    )
    first, second = s.primary, s.secondary

    def metric_columns(m: str) -> list[Column]:
        return [F.col(f"{m}_{c}") for c in ("amount", "per_unit", "per_person", "per_band_person")]

    return joined.select(
        "group",
        F.lit(s.term).alias("measurement_period"),
        F.lit(s.metric).alias("reading_metric"),
        *reading_columns,
        F.lit(s.year).alias("spending_year"),
        *metric_columns(first),
        *metric_columns(second),
        F.col(f"{first}_units").alias("source_units"),
        F.coalesce(f"{first}_total", "_total").alias("population_total"),
        F.coalesce(f"{first}_band", "_band").alias("population_band"),
        presence_flag("strict_value").alias("has_strict_value"),
        presence_flag("latest_value").alias("has_latest_value"),
        presence_flag(f"{first}_amount").alias(f"has_{first}"),
        presence_flag(f"{second}_amount").alias(f"has_{second}"),
        (presence_flag("_p") | presence_flag(f"{first}_total")).alias("has_population"),
        presence_flag("_r").alias("in_reading"),
        presence_flag("_s").alias("in_spending"),
        first_nonblank(f"{first}_source_url", f"{second}_source_url").alias("source_url"),
    )


def build_entities(
    graduates: DataFrame, grades: DataFrame, paired: DataFrame, crosswalk: DataFrame, values: Sequence[str], total_names: Sequence[str]
) -> DataFrame:
    """One row per entity name in any of three tables, with its crosswalk attributes.

    ``graduates``: name, count, review, ordinal; ``grades``: name, row_type, review,
    ordinal and the values; ``paired``: name, count, many rows per name; ``crosswalk``:
    name, canonical, group, priority, match_status, match_confidence, match_source, note.
    """
    grad = dedup(graduates.select("name", F.col("count").alias("graduates"), F.col("review").alias("graduate_review"), "ordinal"), ["name"], "ordinal")
    grade = dedup(grades.select("name", *values, "row_type", F.col("review").alias("grade_review"), "ordinal"), ["name"], "ordinal")
    pairs = paired.groupBy("name").agg(F.count(F.lit(1)).alias("paired_rows"), M.sum_or_null("count").alias("paired_count"))
    joined = joins.entity_outer_join(
        "name",
        {
            "graduates": (grad, ["graduates", "graduate_review"]),
            "grades": (grade, [*values, "row_type", "grade_review"]),
            "paired": (pairs, ["paired_rows", "paired_count"]),
        },
        crosswalk,
        ["canonical", "group", "priority", "match_status", "match_confidence", "match_source", "note"],
    )
    excluded = (
        F.coalesce(F.col("priority") == K.EXCLUDED, F.lit(False))
        | F.coalesce(F.col("row_type") == "aggregate", F.lit(False))
        | F.col("name").isin(list(total_names))
    )
    return joined.select(
        "name", "canonical", "group", "priority", "match_status", "match_confidence", "match_source", "graduates", *values,
        F.coalesce("paired_rows", F.lit(0)).alias("paired_rows"), "paired_count",
        "has_graduates", "has_grades", "has_paired", excluded.alias("is_excluded"),
        join_notes("note", "grade_review", "graduate_review").alias("notes"),
    )


def build_groups(entities: DataFrame, values: Sequence[str]) -> DataFrame:
    """One summary row per group of the required entities."""
    rows = M.analysis_rows(entities, "priority", "is_excluded", "group")
    return joins.group_summary(rows, "group", "name", "graduates", values, ["has_graduates", "has_grades", "has_paired"])


def build_analysis(
    observations: DataFrame,
    spending: DataFrame,
    population: DataFrame,
    graduates: DataFrame,
    grades: DataFrame,
    paired: DataFrame,
    crosswalk: DataFrame,
    values: Sequence[str],
    settings: AnalysisSettings,
    total_names: Sequence[str] = (),
    caveats: Sequence[tuple[str, str, str]] = (),
) -> AnalysisTables:
    """All analysis tables and their coverage audit."""
    spine = build_spine(observations, spending, population, settings)
    entities = build_entities(graduates, grades, paired, crosswalk, values, total_names)
    groups = build_groups(entities, values)
    audit = coverage.coverage_audit(
        spine, entities, groups, "group",
        {"reading": F.col("in_reading"), "spending": F.col("in_spending"), "outcomes": F.col("_in_groups")},
        weak_below=settings.weak_below, caveats=caveats,
    )
    return AnalysisTables(spine, entities, groups, audit)
