"""The entity crosswalk: names of several tables resolved, grouped, queued and audited."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.operators import harmonize as H, resolve as R


@dataclass(frozen=True)
class CrosswalkTables:
    crosswalk: DataFrame
    required_review: DataFrame
    reference_review: DataFrame
    manual_template: DataFrame
    audit: DataFrame


def build_crosswalk(
    sources: dict[str, tuple[DataFrame, str]],
    required: Sequence[str],
    register: DataFrame,
    manual: DataFrame,
    group_crosswalk: DataFrame,
    rules: R.NameRules,
    weights: tuple[DataFrame, str, str, str] | None = None,
    counts: tuple[DataFrame, str, str, str, str] | None = None,
) -> CrosswalkTables:
    """Resolve every name found in ``sources`` and carry its group to the common spelling.

    ``sources`` maps a flag to (table, name column), ``required`` lists the flags that
    make a name required. ``register``: canonical, group. ``manual``: name, folded,
    canonical, group, status, note. ``group_crosswalk``: source, name, status, notes,
    ordinal. ``weights`` is (table, name, weight, order), ``counts`` (table, name, year,
    count, order). Inputs are only read; merged manual rows come back as a table.
    """
    flags = list(sources)
    universe = R.presence_matrix(sources)
    weight_rows = R.attach_weight(universe.select("name"), "name", *weights) if weights else None
    count_rows = R.latest_counts(*counts, rules) if counts else None
    accepted = H.accepted_overrides(manual, "status", "group").select("name", "canonical", "group", "note")
    resolution = R.resolve_entities(universe, flags, required, register, accepted, rules, weight_rows, count_rows)
    grouped = H.lookup_exact(
        resolution.rows.withColumnRenamed("group", "group_source"), "group_source", group_crosswalk,
        ["source", "name", "status", "notes"], "ordinal", ["group", "group_status", "group_note"],
    )
    resolved = R.Resolution(grouped)
    unresolved = resolved.names.filter((F.col("priority") == K.REQUIRED) & (F.col("match_status") == K.NEEDS_MANUAL_REVIEW))
    template = H.review_template(manual, unresolved, "name", "folded", ["group", "canonical", "status", "note"])
    return CrosswalkTables(
        resolved.names,
        R.review_queue(resolved, K.REQUIRED, flags),
        R.review_queue(resolved, K.REFERENCE_ONLY, flags),
        template,
        R.resolution_audit(resolved, flags, required_flags=required, group_status="group_status"),
    )
