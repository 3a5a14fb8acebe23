"""Carry names over to a common spelling by crosswalk tables and overrides.

No join here forces a broadcast. Spark broadcasts a side when its measured size is
under the session threshold and shuffles otherwise, and a name that owns much of the
fact table is split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.functions.names import fold_key
from tallyweave.functions.numbers import blank_to_null, strip
from tallyweave.operators.keys import dedup

CARRIED_NOTE = "no mapping listed; source name carried forward"
FOLDED_NOTE = "matched without regard to punctuation or accents."


def _crosswalk(crosswalk: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Columns _source, _name, _status, _note, _order; blank sources dropped."""
    source, name, status, note = columns
    rows = crosswalk.select(
        blank_to_null(source).alias("_source"),
        F.col(name).alias("_name"),
        F.col(status).alias("_status"),
        F.coalesce(F.col(note), F.lit("")).alias("_note"),
        F.col(order).alias("_order"),
    )
    return rows.filter(F.col("_source").isNotNull())


def lookup_exact(
    df: DataFrame,
    key: str,
    crosswalk: DataFrame,
    columns: Sequence[str],
    order: str,
    out: Sequence[str],
    carried_note: str = CARRIED_NOTE,
) -> DataFrame:
    """Name, status and note by trimmed key; an unlisted name keeps its spelling.

    ``columns`` are the crosswalk's source, name, status and note; the last row of a
    repeated source counts. A blank key gets NULL in all three outputs.
    """
    listed = dedup(_crosswalk(crosswalk, columns, order), ["_source"], "_order", "last").drop("_order")
    source = blank_to_null(key)
    joined = df.withColumn("_key", source).join(listed, F.col("_key") == F.col("_source"), "left")
    hit, blank = F.col("_source").isNotNull(), F.col("_key").isNull()
    name, status, note = out
    return joined.withColumns(
        {
            name: F.when(hit, F.coalesce(blank_to_null("_name"), F.col("_key"))).otherwise(F.col("_key")),
            status: F.when(blank, F.lit(None)).when(hit, F.coalesce("_status", F.lit(K.UNCHANGED))).otherwise(K.UNCHANGED),
            note: F.when(blank, F.lit(None)).when(hit, F.col("_note")).otherwise(carried_note),
        }
    ).drop("_key", "_source", "_name", "_status", "_note")


def harmonize(
    df: DataFrame,
    key: str,
    crosswalk: DataFrame,
    columns: Sequence[str],
    order: str,
    out: Sequence[str],
    variants: dict[str, tuple[str, str, str]] | None = None,
    folded_note: str = FOLDED_NOTE,
    carried_note: str = CARRIED_NOTE,
    exact_fold: bool = False,
) -> DataFrame:
    """Name, status and note by tiers: exact, listed variant, folded key, unchanged.

    The last row of a repeated exact source counts, the first row of a repeated folded
    key. ``variants`` maps a spelling to (name, status, note).
    """
    rows = _crosswalk(crosswalk, columns, order)
    exact = dedup(rows, ["_source"], "_order", "last").drop("_order")
    folded = dedup(rows.withColumn("_fold", fold_key("_source", exact_fold)), ["_fold"], "_order", "first")
    folded = folded.select(
        "_fold",
        F.col("_source").alias("_f_source"),
        F.col("_name").alias("_f_name"),
        F.col("_status").alias("_f_status"),
        F.col("_note").alias("_f_note"),
    )
    prepared = df.withColumn("_key", strip(key)).withColumn("_key_fold", fold_key("_key", exact_fold))
    joined = prepared.join(exact, F.col("_key") == F.col("_source"), "left").join(
        folded, F.col("_key_fold") == F.col("_fold"), "left"
    )
    by_exact, by_fold = F.col("_source").isNotNull(), F.col("_fold").isNotNull()
    by_variant = F.col("_key").isin(list(variants)) if variants else F.lit(False)

    def from_variant(i: int) -> Column:
        if not variants:
            return F.lit(None).cast("string")
        pairs = [F.lit(x) for k, v in variants.items() for x in (k, v[i])]
        return F.try_element_at(F.create_map(*pairs), F.col("_key"))

    fold_note = F.when(
        F.col("_f_source") != F.col("_key"), F.btrim(F.concat(F.lit(folded_note + " "), F.col("_f_note")))
    ).otherwise(F.col("_f_note"))

    def tier(exact_value: Column, i: int, fold_value: Column, rest: Column) -> Column:
        return (
            F.when(by_exact, exact_value).when(by_variant, from_variant(i)).when(by_fold, fold_value).otherwise(rest)
        )

    name, status, note = out
    return joined.withColumns(
        {
            name: tier(F.col("_name"), 0, F.col("_f_name"), F.col("_key")),
            status: tier(F.col("_status"), 1, F.col("_f_status"), F.lit(K.UNCHANGED)),
            note: tier(F.col("_note"), 2, fold_note, F.lit(carried_note)),
        }
    ).drop(
        "_key", "_key_fold", "_source", "_name", "_status", "_note", "_fold", "_f_source", "_f_name", "_f_status", "_f_note"
    )


def override_rows(defaults: DataFrame, edited: DataFrame, key: str, order: str) -> DataFrame:
    """Whole-row override: an edited row replaces the default row of its key."""
    edited = dedup(edited.filter(blank_to_null(key).isNotNull()).withColumn(key, blank_to_null(key)), [key], order)
    fields = [c for c in defaults.columns if c not in (key, order)]
    d = defaults.select(key, F.struct(*fields).alias("_d"))
    e = edited.select(key, F.struct(*fields).alias("_e"))
    merged = d.join(e, key, "full_outer").withColumn("_r", F.coalesce("_e", "_d"))
    return merged.select(key, *[F.col(f"_r.{c}").alias(c) for c in fields])


def override_fields(defaults: DataFrame, edited: DataFrame, key: str, order: str) -> DataFrame:
    """Field-by-field override: a non-blank edited field replaces the default."""
    edited = dedup(edited.filter(blank_to_null(key).isNotNull()).withColumn(key, blank_to_null(key)), [key], order)
    fields = [c for c in defaults.columns if c not in (key, order)]
    d = defaults.select(key, *[F.col(c).alias(f"_d_{c}") for c in fields])
    e = edited.select(key, *[F.col(c).alias(f"_e_{c}") for c in fields])
    merged = d.join(e, key, "full_outer")
    return merged.select(key, *[F.coalesce(blank_to_null(f"_e_{c}"), F.col(f"_d_{c}")).alias(c) for c in fields])


def accepted_overrides(rows: DataFrame, status: str, group: str, accepted: Sequence[str] = ("matched", "matched_manual", "ok")) -> DataFrame:
    """Hand-made rows that are in force: an accepted status and a group."""
    return rows.filter(F.lower(strip(status)).isin(list(accepted)) & blank_to_null(group).isNotNull())


def review_template(
    manual: DataFrame, unresolved: DataFrame, key: str, folded: str, edits: Sequence[str]
) -> DataFrame:
    """Hand-edited rows that hold any edit, plus a blank row per unresolved name.

    An unresolved name that already has a row keeps its edits.
    """
    any_edit = F.lit(False)
    for c in edits:
        any_edit = any_edit | blank_to_null(c).isNotNull()
    kept = manual.filter(any_edit & blank_to_null(key).isNotNull()).select(key, folded, *edits)
    fresh = unresolved.select(key, folded).join(kept, key, "left_anti")
    return kept.unionByName(fresh.select(key, folded, *[F.lit(None).cast("string").alias(c) for c in edits]))
