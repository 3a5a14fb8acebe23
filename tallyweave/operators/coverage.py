"""Coverage and extraction audits as long tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.operators.keys import append_sections
from tallyweave.session import shared


Item = tuple[str, Column, Column]


def _sections(rows: DataFrame, sections: dict[str, Sequence[Item]]) -> DataFrame:
    """Turn one row of aggregates into ``(section, item, value, details)`` rows."""
    structs = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(item).alias("item"),
            value.cast("string").alias("value"),
            F.coalesce(details.cast("string"), F.lit("")).alias("details"),
        )
        for section, items in sections.items()
        for item, value, details in items
    ]
    return rows.select(F.inline(F.array(*structs)))


def _entries(rows: DataFrame, section: str, items: Sequence[Item]) -> DataFrame:
    return _sections(rows, {section: items})


def _line(section: Column, item: Column, value: Column, details: Column | None = None) -> list[Column]:
    return [section.alias("section"), item.alias("item"), value.cast("string").alias("value"), (F.lit("") if details is None else details).alias("details")]


def distinct_lists(df: DataFrame, section: str, items: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Number of distinct non-blank values per item, and one row per value.

    ``items`` maps an item to a column and an optional condition. Counts are rows of
    ``section``, values rows of ``<section>_member``; distinct values meet by item and
    value, so no task holds an item's whole list.
    """
    entries = []
    for item, (column, condition) in items.items():
        text = F.col(column).cast("string")
        value = text if condition is None else F.when(condition, text)
        entries.append(F.struct(F.lit(item).alias("item"), value.alias("value")))
    members = df.select(F.inline(F.array(*entries))).filter("value <> ''").distinct()
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(i) for i in items])).alias("item"))
    counts = every.join(members.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "item", "left")
    return append_sections(
        counts.select(*_line(F.lit(section), F.col("item"), F.coalesce("n", F.lit(0)))),
        members.select(*_line(F.lit(f"{section}_member"), F.col("item"), F.col("value"))),
    )


def extraction_audit(
    df: DataFrame, value: str, domains: Sequence[str], suppressed: str | None = None, issues: DataFrame | None = None
) -> DataFrame:
    """Rows, rows with a value, rows without, distinct domain values, issues and their kinds."""
    no_value = F.col(value).isNull() if suppressed is None else F.col(suppressed)
    # Rows are counted per members first, so the input is worked out once for all sections.
    members = df.groupBy(*domains).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_with"), F.count_if(no_value).alias("_without")
    )
    members = shared(members, *domains)
    counts = members.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("_rows", "n_rows"), ("_with", "with_value"), ("_without", "without_value"))]
    )
    blank = F.lit("")
    out = _entries(
        counts,
        "summary",
        [
            ("rows_extracted", F.col("n_rows"), blank),
            ("non_null_value_rows", F.col("with_value"), blank),
            ("suppressed_or_missing_value_rows", F.col("without_value"), blank),
        ],
    )
    out = append_sections(out, distinct_lists(members, "domain", {d: (d, None) for d in domains}))
    if issues is not None:
        found = issues.agg(F.count(F.lit(1)).alias("n"))
        kinds = issues.groupBy("issue").agg(F.count(F.lit(1)).alias("n"))
        out = append_sections(
            out,
            _entries(found, "issues", [("parsing_issues", F.col("n"), blank)]),
            kinds.select(*_line(F.lit("issue_kind"), F.col("issue"), F.col("n"))),
        )
    return out


def harmonization_audit(df: DataFrame, source: str, name: str, status: str, note: str, order: str) -> DataFrame:
    """Rows and names per status, one line per name to review, and one per source name.

    A name's line shows its first row; one grouped pass finds all of them.
    """
    per_name = df.groupBy(source).agg(
        F.min_by(F.struct(name, status, note), order).alias("_first"), F.count(F.lit(1)).alias("_rows")
    ).select(source, "_first.*", "_rows")
    row_counts = df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    by_row = row_counts.select(
        F.lit("rows_by_status").alias("section"), F.col(status).alias("item"), F.col("n").cast("string").alias("value"),
        F.lit("").alias("details"),
    )
    totals = per_name.agg(
        F.sum("_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_source"),
        F.count_distinct(name).alias("n_names"),
        *[F.count_if(F.col(status) == s).alias(s) for s in (K.UNCHANGED, K.HARMONIZED, K.NEEDS_REVIEW)],
    )
    blank = F.lit("")
    summary = _entries(
        totals,
        "summary",
        [
            ("rows", F.coalesce("n_rows", F.lit(0)), blank),
            ("source_names", F.col("n_source"), blank),
            ("harmonized_names", F.col("n_names"), blank),
            ("names_unchanged", F.col(K.UNCHANGED), blank),
            ("names_harmonized", F.col(K.HARMONIZED), blank),
            ("names_needing_review", F.col(K.NEEDS_REVIEW), blank),
        ],
    )
    lines = per_name.select(
        F.lit("name").alias("section"),
        F.col(source).alias("item"),
        F.concat_ws(" | ", name, status).alias("value"),
        F.coalesce(F.col(note), F.lit("")).alias("details"),
    )
    review = per_name.filter(F.col(status) == K.NEEDS_REVIEW).select(*_line(F.lit("to_review"), F.col(source), F.col(name)))
    return append_sections(summary, by_row, review, lines)


def gap_rows(presence: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """``(comparison, key, flags)`` for every ordered pair of sources with a key only in the first.

    Reads the presence matrix once; a key yields at most one row per pair.
    """
    pairs = [
        F.when(F.col(a) & ~F.col(b), F.lit(f"{a}_not_{b}"))
        for a, b in permutations(flags, 2)
    ]
    missing = F.filter(F.array(*pairs), lambda c: c.isNotNull())
    return presence.select(F.explode(missing).alias("comparison"), key, *flags)


def classify_gaps(
    gaps: DataFrame,
    key: str,
    target: str,
    outcome_sources: Sequence[str],
    known_gaps: Sequence[str] = (),
    true_gap_comparisons: dict[str, str] | None = None,
) -> DataFrame:
    """Gap type, assessment and note by ordered rules.

    A known gap first; then comparisons that are gaps by nature; then a key that has
    outcomes but is missing from ``target``; what is left may be a naming problem.
    """
    comparison = F.col("comparison")
    outcome = F.lit(False)
    for s in outcome_sources:
        outcome = outcome | F.col(s)
    rules: list[tuple[Column, str]] = [
        (F.col(key).isin(list(known_gaps) or [""]), f"known gap: absent from {target} after harmonisation")
    ]
    rules += [(comparison == c, note) for c, note in (true_gap_comparisons or {}).items()]
    rules.append((~F.col(target) & outcome, f"has outcomes but is absent from {target}"))
    kind = note = None
    for condition, text in rules:
        kind = F.when(condition, K.TRUE_GAP) if kind is None else kind.when(condition, K.TRUE_GAP)
        note = F.when(condition, text) if note is None else note.when(condition, text)
    out = gaps.withColumn("gap_type", kind.otherwise(K.HARMONIZATION_GAP)).withColumn(
        "note", note.otherwise("unexpected difference; inspect source and harmonised names")
    )
    assessment = F.when(F.col("gap_type") == K.TRUE_GAP, K.ASSESS_TRUE).otherwise(K.ASSESS_REVIEW)
    return out.withColumn("assessment", assessment)


def source_spellings(sources: dict[str, tuple[DataFrame, str, str]], key: str) -> DataFrame:
    """Distinct rows ``(key, source, spelling)`` of all sources, blank keys left out."""
    parts = [
        df.select(F.col(k).cast("string").alias(key), F.lit(label).alias("source"), F.col(s).cast("string").alias("spelling"))
        for label, (df, k, s) in sources.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows.filter(F.col(key) != "").distinct()


def source_values(spellings: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Per key one flag per source, and ``label: a`` with the first of each source's spellings
    and how many more there are."""
    aggregates = []
    for label in labels:
        mine = F.when(F.col("source") == label, F.col("spelling"))
        aggregates.append(F.bool_or(F.col("source") == label).alias(label))
        aggregates += [F.min(mine).alias(f"_s_{label}"), F.count(mine).alias(f"_n_{label}")]
    grouped = spellings.groupBy(key).agg(*aggregates)
    texts = []
    for label in labels:
        more = F.when(F.col(f"_n_{label}") > 1, F.concat(F.lit(" and "), (F.col(f"_n_{label}") - 1).cast("string"), F.lit(" more"))).otherwise("")
        texts.append(F.when(F.col(label), F.concat(F.lit(f"{label}: "), F.coalesce(f"_s_{label}", F.lit("")), more)))
    return grouped.select(key, *labels, F.concat_ws(" | ", *texts).alias("source_values"))


def classified_gap_audit(
    sources: dict[str, tuple[DataFrame, str, str]],
    key: str,
    comparisons: Sequence[str],
    target: str,
    outcome_sources: Sequence[str],
    known_gaps: Sequence[str] = (),
    true_gap_comparisons: dict[str, str] | None = None,
) -> DataFrame:
    """Counts per source, counts per comparison, every gap with its class, and the
    spellings of the keys with gaps, one per row.

    ``sources`` maps a label to (table, key column, spelling column).
    """
    flags = list(sources)
    spellings = source_spellings(sources, key)
    matrix = source_values(spellings, key, flags)
    gaps = gap_rows(matrix.drop("source_values"), key, flags).filter(F.col("comparison").isin(list(comparisons)))
    classed = classify_gaps(gaps, key, target, outcome_sources, known_gaps, true_gap_comparisons)
    rows = classed.join(matrix.select(key, "source_values"), key).select(
        F.lit("gap").alias("section"), "comparison", key, *flags, "gap_type", "assessment", "source_values", "note"
    )
    pairs = dict((f"{a}_not_{b}", (a, b)) for a, b in permutations(flags, 2))
    counts = matrix.agg(
        *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags],
        *[F.count_if(F.col(pairs[c][0]) & ~F.col(pairs[c][1])).alias(f"g_{c}") for c in comparisons],
    )
    every = F.concat_ws("; ", *[F.concat(F.lit(f"{f}="), F.col(f"n_{f}").cast("string")) for f in flags])
    summary = [("all_sources", "coverage_count", every)]
    summary += [(c, "gap_count", F.col(f"g_{c}").cast("string")) for c in comparisons]
    structs = [F.struct(F.lit(c).alias("comparison"), F.lit(t).alias("gap_type"), v.alias("note")) for c, t, v in summary]
    no_flag = F.lit(None).cast("boolean")
    heads = counts.select(F.inline(F.array(*structs))).select(
        F.lit("summary").alias("section"),
        "comparison",
        F.lit("").alias(key),
        *[no_flag.alias(f) for f in flags],
        "gap_type",
        F.lit("summary").alias("assessment"),
        F.lit("").alias("source_values"),
        "note",
    )
    blank = F.lit("")
    spelled = spellings.join(rows.select(key).distinct(), key, "left_semi").select(
        F.lit("spelling").alias("section"), F.col("source").alias("comparison"), key, *[no_flag.alias(f) for f in flags],
        blank.alias("gap_type"), blank.alias("assessment"), F.col("spelling").alias("source_values"), blank.alias("note"),
    )
    return append_sections(heads, rows, spelled)


def coverage_audit(
    spine: DataFrame,
    entities: DataFrame,
    groups: DataFrame,
    key: str,
    sources: dict[str, Column],
    newest_period: str = "strict_period",
    strict: str = "strict_value",
    latest: str = "latest_value",
    components: str = "strict_component_count",
    share: str = "coverage_share",
    weak_below: float = K.WEAK_COVERAGE,
    caveats: Sequence[tuple[str, str, str]] = (),
) -> DataFrame:
    """The long audit of the three analysis tables: ``(section, item, value, details)``.

    Row counts, fallback, multi-component and weak-coverage groups, coverage per source,
    and counts and rows of the gaps between every ordered pair of sources. The keys behind
    each count are rows of section ``member``. ``spine`` and
    ``groups`` together hold all keys; ``sources`` says by which condition on the joined
    row a source covers the key. Each input is read once.
    """
    flags = list(sources)
    joined = spine.withColumn("_in_spine", F.lit(True)).join(
        groups.select(key, share, F.lit(True).alias("_in_groups")), key, "full_outer"
    )
    presence = joined.withColumns({f: F.coalesce(c, F.lit(False)) for f, c in sources.items()})
    # The counts, the keys behind them and the gaps all read this exchange.
    presence = shared(presence.select(key, *flags, newest_period, strict, latest, components, share, "_in_spine", "_in_groups"), key)
    name = F.col(key)
    pairs = list(permutations(flags, 2))
    conditions = {
        "fallback": F.col(strict).isNull() & F.col(latest).isNotNull(),
        "several": F.col(components) > 1,
        "weak": F.col("_in_groups") & (F.coalesce(F.col(share), F.lit(0.0)) < weak_below),
        **{f: F.col(f) for f in flags},
        **{f"{a}_not_{b}": F.col(a) & ~F.col(b) for a, b in pairs},
    }
    aggregates = [
        F.max(newest_period).alias("newest"),
        F.count("_in_spine").alias("spine_rows"),
        F.count("_in_groups").alias("group_rows"),
    ]
    for label, condition in conditions.items():
        aggregates.append(F.count_if(F.coalesce(condition, F.lit(False))).alias(f"n_{label}"))
    blank = F.lit("")
    members: list[Column] = []

    def listed(item: str, label: str) -> Item:
        members.append(F.when(conditions[label], F.lit(item)))
        return item, F.col(f"n_{label}"), blank

    sections: dict[str, Sequence[Item]] = {
        "summary": [
            ("spine_rows", F.col("spine_rows"), blank),
            ("group_summary_rows", F.col("group_rows"), blank),
            ("strict_latest_period", F.col("newest"), blank),
            listed("latest_available_fallback_groups", "fallback"),
            listed("multi_component_groups", "several"),
            listed("weak_coverage_groups", "weak"),
        ],
        "coverage": [listed(f, f) for f in flags],
        "join_gap_summary": [listed(f"{a}_not_{b}", f"{a}_not_{b}") for a, b in pairs],
        "caveat": [(i, F.lit(v), F.lit(d)) for i, v, d in caveats],
    }
    entity_count = entities.agg(F.count(F.lit(1)).alias("n"))
    gaps = gap_rows(presence, key, flags).select(
        F.lit("join_gap").alias("section"),
        F.col("comparison").alias("item"),
        name.alias("value"),
        F.concat_ws("; ", *[F.concat(F.lit(f"in_{f}="), F.col(f).cast("string")) for f in flags]).alias("details"),
    )
    keys_behind = F.explode(F.filter(F.array(*members), lambda m: m.isNotNull()))
    behind = presence.select(keys_behind.alias("item"), name.alias("value")).select(*_line(F.lit("member"), F.col("item"), F.col("value")))
    return append_sections(
        _sections(presence.agg(*aggregates), sections),
        behind,
        _entries(entity_count, "summary", [("entity_rows", F.col("n"), blank)]),
        gaps,
    )
