"""Resolve entity names against a register: exact, alias, size, similarity, place."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave import constants as K
from tallyweave.functions.names import (
    alias_name,
    contains_hint,
    fold_name,
    is_group_or_total,
    name_variants,
    priority_class,
)
from tallyweave.functions.numbers import blank_to_null, parse_digits
from tallyweave.operators.keys import dedup, latest_per_key
from tallyweave.operators.measures import leading_tokens, rate_text
from tallyweave.operators.similarity import best_entries
from tallyweave.session import shared


# Leading words of open names that an audit shows.
PATTERNS = 10


@dataclass(frozen=True)
class NameRules:
    """Rule data of a name system; every list may be replaced."""

    stop_tokens: Sequence[str] = field(default_factory=lambda: K.STOP_TOKENS)
    prefixes: Sequence[tuple[str, str]] = field(default_factory=lambda: K.ALIAS_PREFIXES)
    place_pattern: str = K.PLACE_PATTERN
    place_heads: Sequence[str] = field(default_factory=lambda: K.PLACE_HEADS)
    place_prefix: str = K.PLACE_PREFIX
    totals: Sequence[str] = field(default_factory=lambda: K.TOTAL_NAMES)
    total_literals: Sequence[str] = ()
    hints: Sequence[tuple[str, str]] = field(default_factory=lambda: K.LOCATION_HINTS)
    # Folded name to the group that nearest-size evidence may confirm.
    magnitude: dict[str, str] = field(default_factory=dict)
    # (folded name, group) to the variant whose count tells namesakes apart.
    count_keys: dict[tuple[str, str], str] = field(default_factory=dict)

    def fold(self, c: Column | str) -> Column:
        return fold_name(c, self.stop_tokens)

    def variants(self, c: Column | str) -> Column:
        return name_variants(
            c, self.prefixes, self.stop_tokens, self.place_pattern, self.place_heads, self.place_prefix
        )


def presence_matrix(sources: dict[str, tuple[DataFrame, str]], name: str = "name") -> DataFrame:
    """One row per distinct non-blank name with one flag per source table."""
    parts = [
        df.select(blank_to_null(column).alias(name), F.lit(label).alias("_source"))
        for label, (df, column) in sources.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    flags = [F.bool_or(F.col("_source") == label).alias(label) for label in sources]
    return rows.filter(F.col(name).isNotNull()).groupBy(name).agg(*flags)


def register_variants(register: DataFrame, rules: NameRules) -> DataFrame:
    """Rows ``(variant, canonical, group)`` of a register with those two columns."""
    entries = register.select(
        blank_to_null("canonical").alias("canonical"), blank_to_null("group").alias("group")
    ).filter("canonical IS NOT NULL AND `group` IS NOT NULL")
    return entries.distinct().withColumn("variant", F.explode(rules.variants("canonical")))


def unique_index(variants: DataFrame) -> DataFrame:
    """Least and greatest (canonical, group) per variant; they agree where it is unique."""
    pair = F.struct("canonical", "group")
    return variants.groupBy("variant").agg(F.min(pair).alias("_lo"), F.max(pair).alias("_hi"))


def unique_candidate_join(names: DataFrame, name: str, variants: Column, index: DataFrame) -> DataFrame:
    """Names whose variants lead to exactly one (canonical, group).

    Least and greatest pair stand in for a count of distinct pairs, so a variant that
    very many names share costs two values per task and never a list.
    """
    exploded = names.select(name, F.explode(variants).alias("variant"))
    hits = exploded.join(index, "variant").groupBy(name).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    return hits.filter("_lo = _hi").select(name, "_lo.*")


def unique_matches(names: DataFrame, name: str, folded: str, variants: Column, index: DataFrame) -> DataFrame:
    """Unique match by the folded name itself and by any variant, as two structs.

    One join serves both: the folded name is one of the variants.
    """
    exploded = names.select(name, folded, F.explode(variants).alias("variant"))
    same = F.col("variant") == F.col(folded)
    hits = exploded.join(index, "variant").groupBy(name).agg(
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
        F.min(F.when(same, F.col("_lo"))).alias("_d_lo"),
        F.max(F.when(same, F.col("_hi"))).alias("_d_hi"),
    )
    return hits.select(
        name,
        F.when(F.col("_d_lo") == F.col("_d_hi"), F.col("_d_lo")).alias("_direct"),
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("_alias"),
    )


def latest_counts(counts: DataFrame, name: str, year: str, count: str, order: str, rules: NameRules) -> DataFrame:
    """Rows ``(variant, count)``: the newest count per variant, the first row on ties."""
    usable = counts.select(
        F.explode(rules.variants(name)).alias("variant"),
        parse_digits(year).alias("year"),
        parse_digits(count).alias("count"),
        F.col(order).alias("_o"),
    ).filter("year IS NOT NULL AND count IS NOT NULL")
    return latest_per_key(usable, ["variant"], "year", "_o", ["count"]).select("variant", "count")


def latest_reference_count(entries: DataFrame, counts: DataFrame, rules: NameRules) -> DataFrame:
    """``(canonical, group, count)``: the count of the first variant that has one.

    A disambiguation key listed for the entry goes first, then variants in code point
    order.
    """
    listed = rules.variants("canonical")
    special = F.lit(None).cast("string")
    for (folded, group), key in rules.count_keys.items():
        special = F.when((rules.fold("canonical") == folded) & (F.col("group") == group), F.lit(key)).otherwise(special)
    tried = F.filter(F.concat(F.array(special), listed), lambda v: v.isNotNull())
    rows = entries.select("canonical", "group", F.posexplode(tried).alias("_at", "variant"))
    found = rows.join(counts, "variant")
    return found.groupBy("canonical", "group").agg(F.min_by("count", "_at").alias("count"))


def attach_weight(df: DataFrame, name: str, weights: DataFrame, weight_name: str, weight: str, order: str) -> DataFrame:
    """Observed count per name as ``weight``; text that is not digits counts as absent."""
    usable = weights.select(
        F.col(weight_name).alias(name), parse_digits(weight).alias("weight"), F.col(order).alias("_o")
    ).filter("weight IS NOT NULL")
    return df.join(dedup(usable, [name], "_o", "last").drop("_o"), name, "left")


def rank_candidates(df: DataFrame, key: str, k: int = K.CANDIDATES_KEPT) -> DataFrame:
    """Top ``k`` per key by score, then names. Spark trims each task to ``k`` rows per key
    before the shuffle, so a key with very many candidates stays cheap."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "canonical", "group")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def similarity_join(
    names: DataFrame,
    name: str,
    folded: str,
    targets: DataFrame,
    rules: NameRules,
    threshold: float = K.SIMILARITY_REVIEW,
    k: int = K.CANDIDATES_KEPT,
) -> DataFrame:
    """``(name, rank, canonical, group, score)``: the best ``k`` register entries per name.

    ``targets`` are the ``register_variants`` of the register.

    The score is the best over the spellings of both sides; it is compared with the
    threshold before it is rounded to 3 digits, ties to the even digit.

    Spellings are scored once, however many names share them. An entry among a name's
    best ``k`` is among the best ``k`` of the spelling that gives its score, and among
    the first ``k`` entries of the register spelling that does; so cutting to ``k`` at
    each of these steps loses nothing and bounds the fan-out of a shared spelling.
    """
    spelled = names.select(
        name, F.explode(F.array_distinct(F.array(F.col(folded), alias_name(folded, rules.prefixes)))).alias("a")
    )
    first_entries = Window.partitionBy("variant").orderBy("canonical", "group")
    entries = targets.withColumn("_n", F.row_number().over(first_entries)).filter(F.col("_n") <= k)
    register = entries.groupBy(F.col("variant").alias("text")).agg(F.collect_list(F.struct("canonical", "group")).alias("entries"))
    found = best_entries(spelled.select(F.col("a").alias("text")), register, threshold, k).withColumn("score", F.bround("score", 3))
    scored = found.groupBy("a", "canonical", "group").agg(F.max("score").alias("score"))
    best = rank_candidates(scored, "a", k).drop("rank")
    per_name = spelled.join(best, "a").groupBy(name, "canonical", "group").agg(F.max("score").alias("score"))
    return rank_candidates(per_name, name, k).select(name, "rank", "canonical", "group", "score")


def best_and_second(candidates: Column, columns: Sequence[str]) -> list[Column]:
    """Columns of rank 1 and 2 of an array of candidates, as ``first_`` and ``second_``."""
    return [F.get(candidates, i)[c].alias(f"{label}_{c}") for i, label in ((0, "first"), (1, "second")) for c in columns]


def similarity_accepted(
    hint: Column, accept: float = K.SIMILARITY_ACCEPT, gap: float = K.SIMILARITY_GAP
) -> Column:
    """The top candidate is near enough, clearly ahead, and not against the place hint."""
    first, second = F.col("first_score"), F.col("second_score")
    ahead = second.isNull() | (first - second >= gap)
    agrees = hint.isNull() | (F.col("first_group") == hint)
    return F.coalesce((first >= accept) & ahead & agrees, F.lit(False))


def magnitude_choice(candidates: Column, folded: Column, weight: Column, rules: NameRules, min_gap: int = K.MAGNITUDE_GAP) -> Column:
    """Pick among namesakes by size: a struct ``(canonical, group, note)``, or NULL.

    Applies to names with a ``magnitude`` rule, among candidates whose folded name is
    the same and that have a count. The nearest count wins if the next one is at least
    ``min_gap`` further away and the winner is in the expected group. ``candidates`` is a
    name's array of ``(rank, canonical, group, count)``.
    """
    none = F.lit(None).cast("struct<canonical:string,group:string,note:string>")
    if not rules.magnitude:
        return none
    expected = F.try_element_at(F.create_map(*[F.lit(x) for item in rules.magnitude.items() for x in item]), folded)
    same = F.filter(candidates, lambda c: (rules.fold(c["canonical"]) == folded) & c["count"].isNotNull())
    near = F.array_sort(
        F.transform(
            same,
            lambda c: F.struct(
                F.abs(c["count"] - weight).alias("gap"), c["rank"].alias("rank"), c["canonical"].alias("canonical"),
                c["group"].alias("group"), c["count"].alias("count"),
            ),
        )
    )

    def choice(ranked: Column) -> Column:
        first, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
        note = F.format_string(
            "observed count %d is nearer to %d than to %d, the next namesake", weight, first["count"], second["count"]
        )
        clear = (second["gap"] - first["gap"] >= min_gap) & (first["group"] == expected)
        return F.when(clear, F.struct(first["canonical"].alias("canonical"), first["group"].alias("group"), note.alias("note")))

    # Bound once by the lambda; names without a rule or a weight are not looked into.
    return F.when(expected.isNotNull() & weight.isNotNull(), F.transform(F.array(near), choice)[0]).otherwise(none)


def listed_candidates(candidates: DataFrame, name: str) -> DataFrame:
    """``(name, candidates)``: the at most ``k`` kept candidates of each name, by rank."""
    kept = F.struct("rank", "canonical", "group", "score", "count")
    return candidates.groupBy(name).agg(F.array_sort(F.collect_list(kept)).alias("candidates"))


def nearest_magnitude(
    candidates: DataFrame, names: DataFrame, name: str, rules: NameRules, min_gap: int = K.MAGNITUDE_GAP
) -> DataFrame:
    """``magnitude_choice`` of ranked candidates: rows ``(name, canonical, group, size_note)``."""
    scored = candidates if "score" in candidates.columns else candidates.withColumn("score", F.lit(None).cast("double"))
    listed = listed_candidates(scored, name).join(names.select(name, "folded", "weight"), name)
    chosen = listed.select(name, magnitude_choice(F.col("candidates"), F.col("folded"), F.col("weight"), rules, min_gap).alias("_c"))
    return chosen.filter(F.col("_c").isNotNull()).select(name, "_c.canonical", "_c.group", F.col("_c.note").alias("size_note"))


@dataclass(frozen=True)
class Resolution:
    """One row per name, with the array of its ranked candidates where it was open."""

    rows: DataFrame

    @property
    def names(self) -> DataFrame:
        return self.rows.drop("candidates")

    @property
    def candidates(self) -> DataFrame:
        return self.rows.select("name", F.inline("candidates"))


def resolve_entities(
    universe: DataFrame,
    flags: Sequence[str],
    required_flags: Sequence[str],
    register: DataFrame,
    manual: DataFrame,
    rules: NameRules,
    weights: DataFrame | None = None,
    counts: DataFrame | None = None,
    threshold: float = K.SIMILARITY_REVIEW,
) -> Resolution:
    """Resolve every name of ``universe`` by the first rule that applies.

    Excluded total or group row; hand-made mapping; unique exact key; unique alias;
    nearest size among namesakes; high-confidence similarity; place hint, which gives
    the group only; else review. Candidates are scored only for names that the first
    four leave open. The plan is lazy: building it starts no job. The names with their exact
    matches are dealt by name once, and all later steps reuse that exchange.

    ``universe`` has ``name`` and the flags; ``register`` canonical, group; ``manual``
    name, canonical, group, note; ``weights`` name, weight; ``counts`` variant, count.
    """
    named = universe.withColumn("folded", rules.fold("name"))
    named = named.withColumn(
        "excluded", is_group_or_total("folded", rules.totals, F.col("name"), rules.total_literals)
    )
    named = named.join(weights, "name", "left") if weights is not None else named.withColumn(
        "weight", F.lit(None).cast("bigint")
    )
    targets = shared(register_variants(register, rules), "variant")
    matches = unique_matches(named, "name", "folded", rules.variants("name"), unique_index(targets))

    def pair(df: DataFrame, label: str, *extra: str) -> DataFrame:
        return df.select("name", F.struct("canonical", "group", *extra).alias(label))

    base = shared(named.join(pair(manual, "_manual", "note"), "name", "left").join(matches, "name", "left"), "name")
    is_open = ~F.col("excluded") & F.col("_manual").isNull() & F.col("_direct").isNull() & F.col("_alias").isNull()
    open_names = base.filter(is_open).select("name", "folded", "weight")
    candidates = similarity_join(open_names, "name", "folded", targets, rules, threshold)
    if counts is not None:
        entries = targets.select("canonical", "group").distinct()
        candidates = candidates.join(latest_reference_count(entries, counts, rules), ["canonical", "group"], "left")
    else:
        candidates = candidates.withColumn("count", F.lit(None).cast("bigint"))
    joined = base.join(listed_candidates(candidates, "name"), "name", "left")
    listed = F.col("candidates")
    chosen = magnitude_choice(listed, F.col("folded"), F.col("weight"), rules)
    joined = joined.select("*", chosen.alias("_sized"), *best_and_second(listed, ["canonical", "group", "score"]))

    hint = contains_hint("folded", rules.hints)
    joined = joined.withColumn("_hint", hint)
    branch = (
        F.when(F.col("excluded"), K.EXCLUDED)
        .when(F.col("_manual").isNotNull(), K.MATCHED_MANUAL)
        .when(F.col("_direct").isNotNull(), K.MATCHED_EXACT)
        .when(F.col("_alias").isNotNull(), "alias")
        .when(F.col("_sized").isNotNull(), "size")
        .when(similarity_accepted(F.col("_hint")), K.MATCHED_FUZZY)
        .when(F.col("_hint").isNotNull(), K.MATCHED_GROUP_ONLY)
        .otherwise(K.NEEDS_MANUAL_REVIEW)
    )
    joined = joined.withColumn("_branch", branch)
    score_text = F.format_number("first_score", 3)

    def by_branch(**values: Column) -> Column:
        chain = F.lit(None).cast("string")
        for label, value in values.items():
            chain = F.when(F.col("_branch") == _BRANCH[label], value).otherwise(chain)
        return chain

    full = F.lit("1.000")
    out = joined.select(
        "name",
        "folded",
        *flags,
        "weight",
        F.when(F.col("_branch").isin("alias", "size"), F.lit(K.MATCHED_RULE)).otherwise(F.col("_branch")).alias("match_status"),
        by_branch(
            manual=F.col("_manual.canonical"), exact=F.col("_direct.canonical"), alias=F.col("_alias.canonical"),
            size=F.col("_sized.canonical"), fuzzy=F.col("first_canonical"),
        ).alias("canonical"),
        by_branch(
            manual=F.col("_manual.group"), exact=F.col("_direct.group"), alias=F.col("_alias.group"),
            size=F.col("_sized.group"), fuzzy=F.col("first_group"), hint=F.col("_hint"),
        ).alias("group"),
        by_branch(
            excluded=full, manual=full, exact=full, alias=full, size=F.lit("0.950"),
            fuzzy=score_text, hint=score_text, review=score_text,
        ).alias("match_confidence"),
        by_branch(
            excluded=F.lit("rule"), manual=F.lit("manual"), exact=F.lit("register"), alias=F.lit("register_alias"),
            size=F.lit("name_plus_size_rule"), fuzzy=F.lit("register"), hint=F.lit("municipality_location_hint"),
        ).alias("match_source"),
        F.col("_sized.note").alias("size_note"),
        by_branch(
            excluded=F.lit("total or grouped row; no group assigned"),
            manual=F.col("_manual.note"),
            exact=F.lit("exact folded name"),
            alias=F.lit("alias rule: slash, parenthesis or prefix form"),
            size=F.col("_sized.note"),
            fuzzy=F.lit("high-confidence similar name; review optional"),
            hint=F.lit("group from a place named in the source; entity uncertain"),
            review=F.lit("no exact, rule, place or high-confidence match"),
        ).alias("note"),
        "candidates",
    )
    required = F.lit(False)
    for flag in required_flags:
        required = required | F.coalesce(F.col(flag), F.lit(False))
    return Resolution(out.withColumn("priority", priority_class("match_status", required)))


_BRANCH = {
    "excluded": K.EXCLUDED,
    "manual": K.MATCHED_MANUAL,
    "exact": K.MATCHED_EXACT,
    "alias": "alias",
    "size": "size",
    "fuzzy": K.MATCHED_FUZZY,
    "hint": K.MATCHED_GROUP_ONLY,
    "review": K.NEEDS_MANUAL_REVIEW,
}


def review_queue(resolution: Resolution, priority: str, flags: Sequence[str]) -> DataFrame:
    """Unresolved names of one priority with their two best candidates side by side."""
    rows = resolution.rows.filter((F.col("match_status") == K.NEEDS_MANUAL_REVIEW) & (F.col("priority") == priority))
    rows = rows.select("*", *best_and_second(F.col("candidates"), ["canonical", "group", "score", "count"]))
    evidence = F.coalesce(
        "size_note",
        F.when(
            F.col("weight").isNotNull() & F.col("first_count").isNotNull() & F.col("second_count").isNotNull(),
            F.lit("counts are shown for context; size alone did not decide"),
        ),
    )
    note = F.col("note")
    if priority == K.REFERENCE_ONLY:
        note = F.concat(note, F.lit("; reference only, not needed downstream"))
    columns = [
        F.col(f"{label}_{c}").alias(f"possible_match_{i}" if c == "canonical" else f"possible_match_{i}_{c}")
        for i, label in ((1, "first"), (2, "second"))
        for c in ("canonical", "group", "score", "count")
    ]
    return rows.select("name", "folded", *columns, "weight", evidence.alias("size_note"), *flags, note.alias("note"))


def resolution_audit(
    resolution: Resolution, flags: Sequence[str], group: str = "group", order: str = "name",
    required_flags: Sequence[str] | None = None, group_status: str | None = None,
) -> DataFrame:
    """Long audit ``(section, dataset, item, value)``: classes, rates, open names, patterns.

    ``required_flags`` (all ``flags`` by default) make an excluded name count towards the
    relevant total; ``group_status`` is the column that says how a group was carried over.
    """
    wanted = F.lit(False)
    for flag in flags if required_flags is None else required_flags:
        wanted = wanted | F.coalesce(F.col(flag), F.lit(False))
    carried = F.col(group_status) if group_status else F.lit(None).cast("string")
    review = F.col("match_status") == K.NEEDS_MANUAL_REVIEW
    text, none = F.lit(""), F.lit(None).cast("string")

    def line(section: str, dataset: Column, item: Column, counts: Column, of: Column | None = None, value: Column = none) -> Column:
        """What one name adds to a line of the audit: to its count, and to how many there could be."""
        return F.struct(
            F.lit(section).alias("section"), dataset.alias("dataset"), item.alias("item"),
            F.coalesce(counts, F.lit(False)).cast("bigint").alias("n"), F.coalesce(counts if of is None else of, F.lit(False)).cast("bigint").alias("of"),
            value.alias("value"), F.col(order).alias("first"),
        )

    totals = {
        "total_names": F.lit(True),
        "names_with_group": F.col(group).isNotNull(),
        "required_total": F.col("priority") == K.REQUIRED,
        "reference_only_total": F.col("priority") == K.REFERENCE_ONLY,
        "relevant_total_with_excluded": (F.col("priority") == K.REQUIRED) | ((F.col("priority") == K.EXCLUDED) & wanted),
        "groups_harmonized": carried == K.HARMONIZED,
        "groups_needing_review": carried == K.NEEDS_REVIEW,
    }
    asked = F.col("priority") != K.EXCLUDED
    best = F.get("candidates", F.lit(0))
    described = F.concat_ws(
        "; ",
        F.concat(F.lit("weight="), F.coalesce(F.col("weight").cast("string"), text)),
        F.concat(F.lit("possible_match_1="), F.coalesce(best["canonical"], text)),
        F.concat(F.lit("group="), F.coalesce(best["group"], text)),
        F.concat(F.lit("score="), F.coalesce(best["score"].cast("string"), text)),
    )
    pattern = leading_tokens("folded")
    lines = [line("summary", text, F.lit(item), counts) for item, counts in totals.items()]
    lines += [line("summary", F.col("priority"), F.col("match_status"), F.lit(True))]
    lines += [
        line("match_rate_by_source", F.lit(f), F.lit("matched_non_excluded"), F.col(f) & asked & F.col(group).isNotNull(), F.col(f) & asked)
        for f in flags
    ]
    lines += [F.when(review & (F.col("priority") == K.REQUIRED), line("unresolved_required", text, F.col("name"), F.lit(True), value=described))]
    lines += [F.when(review & (F.col("priority") == K.REFERENCE_ONLY), line("common_unmatched_patterns", text, pattern, F.lit(True)))]
    # All lines of all names in one pass, added up with a map-side step.
    told = resolution.rows.select(F.explode(F.array(*lines)).alias("l")).filter("l IS NOT NULL").select("l.*")
    added = told.groupBy("section", "dataset", "item").agg(
        F.sum("n").alias("n"), F.sum("of").alias("of"), F.max("value").alias("value"), F.min("first").alias("first")
    )
    # A table without names still has its totals and rates.
    always = [("summary", "", item) for item in totals] + [("match_rate_by_source", f, "matched_non_excluded") for f in flags]
    empty = resolution.rows.sparkSession.createDataFrame(always, "section string, dataset string, item string")
    added = added.join(empty.withColumn("_always", F.lit(True)), ["section", "dataset", "item"], "full")
    n, of = F.coalesce("n", F.lit(0)), F.coalesce("of", F.lit(0))
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("n"), "first", "item"))
    top = F.when(F.col("section") == "common_unmatched_patterns", place).otherwise(0)
    value = F.when(F.col("section") == "match_rate_by_source", rate_text(n, of)).otherwise(F.coalesce("value", n.cast("string")))
    ranked = added.withColumn("_place", top).filter(F.col("_place") <= PATTERNS)
    return ranked.select("section", "dataset", "item", value.alias("value"))
