"""Queries on name keys, crosswalks, overrides and entity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.functions import names as N
from tallyweave.operators import harmonize as H, measures as M, resolve as R
from tallyweave.operators.coverage import harmonization_audit
from tallyweave.operators.keys import dedup, first_sample, latest_per_key
from tallyweave.queries import common as C
from tallyweave.queries.similarity_sql import ratio_ctes

_CROSSWALK = ["source", "name", "status", "notes"]
_OUT = ["name", "status", "note"]
_VARIANTS = {f"NATION–{n}": (f"LISTED_{n}", K.HARMONIZED, "dash form") for n in (1, 5, 9)}


def crosswalk(spark, folder) -> DataFrame:
    """Nation names to region names; two rows per fold so that order matters."""
    rows = C.nations(spark, folder)
    main = rows.select(
        F.col("source_name").alias("source"),
        F.col("group_name").alias("name"),
        F.when(F.col("n_nationkey") % 6 == 0, K.NEEDS_REVIEW).otherwise(K.HARMONIZED).alias("status"),
        F.concat(F.lit("region of "), "source_name").alias("notes"),
        (F.col("n_nationkey") * 2).alias("seq"),
    )
    again = rows.filter("n_nationkey % 3 = 0").select(
        F.concat(F.lit(" Nation-"), F.col("n_nationkey").cast("string")).alias("source"),
        F.lower("group_name").alias("name"),
        F.lit(K.UNCHANGED).alias("status"),
        F.lit(None).cast("string").alias("notes"),
        (F.col("n_nationkey") * 2 + 1).alias("seq"),
    )
    return main.union(again)


_CROSSWALK_SQL = f"""{C.NATIONS_SQL},
crosswalk AS (
  SELECT source_name AS source, group_name AS name,
    CASE WHEN n_nationkey % 6 = 0 THEN 'needs_review' ELSE 'harmonized' END AS status,
    'region of ' || source_name AS notes, n_nationkey * 2 AS seq FROM nations
  UNION ALL SELECT ' Nation-' || n_nationkey, lower(group_name), 'unchanged', NULL, n_nationkey * 2 + 1
  FROM nations WHERE n_nationkey % 3 = 0)"""


def spelled(spark, folder) -> DataFrame:
    """Every customer with its nation in one of several spellings."""
    customer = C.table(spark, folder, "customer")
    n, k = F.col("c_nationkey").cast("string"), F.col("c_custkey") % 6
    spelling = (
        F.when(k == 0, F.concat(F.lit("NATION_"), n))
        .when(k == 1, F.concat(F.lit("NATION–"), n))
        .when(k == 2, F.concat(F.lit(" nátion   "), n, F.lit(".")))
        .when(k == 3, F.concat(F.lit("Nation-"), n))
        .when(k == 4, F.concat(F.lit("Elsewhere "), n))
        .otherwise(F.lit("  "))
    )
    return customer.select("c_custkey", spelling.alias("spelling"))


_SPELLED_SQL = """spelled AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'NATION_' || c_nationkey
    WHEN 1 THEN 'NATION–' || c_nationkey WHEN 2 THEN ' nátion   ' || c_nationkey || '.'
    WHEN 3 THEN 'Nation-' || c_nationkey WHEN 4 THEN 'Elsewhere ' || c_nationkey ELSE '  ' END AS spelling FROM customer)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_plain(expression: str) -> str:
    """SQL twin of ``remove_accents``."""
    letters, plain, longer = N.accent_rule()
    text = f"lower({expression})"
    for source, target in longer:
        text = f"replace({text}, {_quoted(source)}, {_quoted(target)})"
    return f"translate({text}, {_quoted(letters)}, {_quoted(plain)})"


def sql_fold_key(expression: str) -> str:
    return f"trim(regexp_replace({sql_plain(expression)}, '[^a-z0-9]+', ' ', 'g'), ' ')"


def sql_fold_name(expression: str, stop_tokens: list[str]) -> str:
    """SQL twin of ``fold_name``; stop tokens are dropped from the folded words."""
    text = f"lower({expression})"
    for source, target in K.TRANSLITERATION:
        text = f"replace({text}, '{source}', '{target}')"
    folded = f"trim(regexp_replace({sql_plain(text)}, '[^a-z0-9]+', ' ', 'g'), ' ')"
    listed = ", ".join(_quoted(t) for t in stop_tokens)
    return f"array_to_string(list_filter(string_split({folded}, ' '), lambda w: w NOT IN ({listed})), ' ')"


def harmonized(spark, folder) -> DataFrame:
    return H.harmonize(
        spelled(spark, folder), "spelling", crosswalk(spark, folder), _CROSSWALK, "seq", _OUT, variants=_VARIANTS
    )


def q_harmonize(spark, folder):
    return harmonized(spark, folder)


def q_lookup_exact(spark, folder):
    return H.lookup_exact(spelled(spark, folder), "spelling", crosswalk(spark, folder), _CROSSWALK, "seq", _OUT)


def q_harmonization_audit(spark, folder):
    return harmonization_audit(harmonized(spark, folder), "spelling", *_OUT, "c_custkey")


def q_first_sample(spark, folder):
    return first_sample(harmonized(spark, folder), ["name"], "c_custkey", ["spelling", "status"])


def q_dedup_last(spark, folder):
    """One order per customer: the last by key."""
    orders = C.table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return dedup(orders, ["o_custkey"], "o_orderkey", "last")


def q_dedup_sum(spark, folder):
    events = C.table(spark, folder, "events").select(
        "user_id", "event_type", "event_id", F.col("value").cast("decimal(18,2)").alias("value")
    )
    out = dedup(events, ["user_id", "event_type"], "event_id", "sum", ["value"])
    return out.withColumn("value", F.col("value").cast("double"))


def q_fold_key(spark, folder):
    """Group-name rule over whole document texts."""
    return C.table(spark, folder, "documents").select("doc_id", N.fold_key("text").alias("folded"))


_STOPS = ["the", "und", "les", "los"]


def q_fold_name(spark, folder):
    """Entity-name rule with its own stop tokens over whole document texts."""
    return C.table(spark, folder, "documents").select("doc_id", N.fold_name("text", _STOPS).alias("folded"))


_PART_PREFIXES = [("smallenn i ", "small "), ("smallenn ", "small ")]


def _slashed(p: str = "p_name") -> F:
    k = F.col("p_partkey") % 4
    return (
        F.when(k == 0, F.col(p))
        .when(k == 1, F.concat(F.lit("Smallenn i "), p))
        .when(k == 2, F.concat(p, F.lit(" (Old Ring) / Rod ib "), "p_brand"))
        .otherwise(F.concat(F.lit("Grunnskólinn "), "p_brand", F.lit(" / Barnaskóli")))
    )


def q_name_variants(spark, folder):
    part = C.table(spark, folder, "part").select("p_partkey", _slashed().alias("label"))
    variants = N.name_variants("label", K.ALIAS_PREFIXES + _PART_PREFIXES)
    return part.select("p_partkey", F.array_join(variants, "|").alias("variants"))


def q_alias_and_hint(spark, folder):
    part = C.table(spark, folder, "part").select("p_partkey", _slashed().alias("label"))
    folded = N.fold_name("label")
    hints = [("old", "first"), ("ring", "second"), ("brand 1", "third")]
    return part.select(
        "p_partkey",
        N.alias_name(folded, _PART_PREFIXES).alias("alias"),
        N.contains_hint(folded, hints).alias("hint"),
        N.is_group_or_total(folded, ["red ring", "hot rod"]).alias("is_total"),
    )


def _manual(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Default rows from documents, hand-edited rows from their labels."""
    documents = C.table(spark, folder, "documents")
    defaults = documents.select(
        F.col("doc_id").cast("string").alias("key"),
        F.col("lang").alias("canonical"),
        F.col("source").alias("group"),
        F.lit("default").alias("note"),
    )
    edited = C.table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("key"),
        F.when(F.col("quality") == 1, "edited").otherwise(" ").alias("canonical"),
        F.when(F.col("toxic") == 1, F.lit("moved")).alias("group"),
        F.lit("").alias("note"),
        F.col("doc_id").alias("seq"),
    )
    extra = edited.withColumns({"key": F.concat(F.lit("x"), "key"), "note": F.lit("only edited")}).filter("seq % 7 = 0")
    return defaults, edited.union(extra.select(edited.columns))


def q_override_rows(spark, folder):
    defaults, edited = _manual(spark, folder)
    return H.override_rows(defaults, edited, "key", "seq")


def q_override_fields(spark, folder):
    defaults, edited = _manual(spark, folder)
    return H.override_fields(defaults, edited, "key", "seq")


def q_review_template(spark, folder):
    """Edited label rows that hold an edit, and all other documents as blank rows."""
    _, edited = _manual(spark, folder)
    manual = edited.select("key", F.col("key").alias("folded"), "canonical", "group")
    documents = C.table(spark, folder, "documents")
    unresolved = documents.select(F.col("doc_id").cast("string").alias("key"), F.col("lang").alias("folded"))
    return H.review_template(manual, unresolved, "key", "folded", ["canonical", "group"])


_RULES = R.NameRules(
    stop_tokens=["ib"], prefixes=_PART_PREFIXES, totals=["red ring", "hot rod"],
    hints=[("anvil", "Brand#3"), ("gizmo", "Brand#4")],
    magnitude={"old ring": "Brand#2", "old bolt": "Brand#2", "new plate": "Brand#2"},
)


def register(spark, folder) -> DataFrame:
    """Part names in brands: most names are in many brands, so they are ambiguous."""
    part = C.table(spark, folder, "part")
    return part.select(
        F.when(~F.startswith("p_name", F.lit("cold")), F.initcap("p_name")).alias("canonical"),
        F.when(F.col("p_name").like("large%") | F.col("p_name").like("red%"), F.lit("Brand#1"))
        .otherwise(F.concat(F.lit("Brand#"), (F.length("p_type") % 3 + 1).cast("string"))).alias("group"),
    )


_REGISTER_SQL = """register AS (SELECT DISTINCT array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS canonical,
  CASE WHEN p_name LIKE 'large%' OR p_name LIKE 'red%' THEN 'Brand#1' ELSE 'Brand#' || (length(p_type) % 3 + 1) END AS "group"
  FROM part WHERE p_name NOT LIKE 'cold%')"""


def source_names(spark, folder) -> DataFrame:
    """Part names as other tables might spell them, with two presence flags."""
    part = C.table(spark, folder, "part")
    k = F.col("p_partkey") % 5
    spelling = (
        F.when(k == 0, F.upper("p_name"))
        .when(k == 1, F.concat(F.lit("Smallenn i "), F.element_at(F.split("p_name", " "), -1)))
        .when(k == 2, F.concat("p_name", F.lit(" ib")))
        .when(k == 3, F.concat(F.substring("p_name", 1, 5), F.lit(" "), F.substring("p_name", 6, 20)))
        .otherwise(F.concat(F.lit("Very "), "p_name", F.lit(" kit")))
    )
    names = part.select(
        F.when(F.col("p_retailprice") >= 950, spelling).alias("sold"), F.when(F.col("p_size") <= 35, spelling).alias("stocked")
    )
    return R.presence_matrix({"in_sales": (names, "sold"), "in_stock": (names, "stocked")})


_NAMES_SQL = """spellings AS (SELECT p_retailprice, p_size, CASE p_partkey % 5 WHEN 0 THEN upper(p_name)
    WHEN 1 THEN 'Smallenn i ' || string_split(p_name, ' ')[-1] WHEN 2 THEN p_name || ' ib'
    WHEN 3 THEN substr(p_name, 1, 5) || ' ' || substr(p_name, 6, 20) ELSE 'Very ' || p_name || ' kit' END AS spelling FROM part),
names AS (SELECT spelling AS name, bool_or(p_retailprice >= 950) AS in_sales, bool_or(p_size <= 35) AS in_stock
  FROM spellings WHERE p_retailprice >= 950 OR p_size <= 35 GROUP BY 1)"""


def q_presence_names(spark, folder):
    return source_names(spark, folder)


def q_unique_candidate(spark, folder):
    """Names whose variants lead to exactly one register entry."""
    index = R.unique_index(R.register_variants(register(spark, folder), _RULES))
    return R.unique_candidate_join(source_names(spark, folder), "name", _RULES.variants("name"), index)


def q_similarity_top5(spark, folder):
    names = source_names(spark, folder).withColumn("folded", _RULES.fold("name"))
    return R.similarity_join(names, "name", "folded", R.register_variants(register(spark, folder), _RULES), _RULES)


def _weights(spark, folder) -> DataFrame:
    part = C.table(spark, folder, "part")
    rows = part.select(F.upper("p_name").alias("label"), F.col("p_size").cast("string").alias("size"), "p_partkey")
    names = source_names(spark, folder).select("name")
    return R.attach_weight(names, "name", rows, "label", "size", "p_partkey")


def q_attach_weight(spark, folder):
    return _weights(spark, folder)


def _counts(spark, folder) -> DataFrame:
    part = C.table(spark, folder, "part")
    rows = part.select(
        "p_name", (F.col("p_partkey") % 9 + 2000).cast("string").alias("year"),
        F.when(F.col("p_size") % 4 != 0, (F.col("p_size") * 7).cast("string")).otherwise("n/a").alias("count"), "p_partkey",
    )
    return R.latest_counts(rows, "p_name", "year", "count", "p_partkey", _RULES)


def q_latest_counts(spark, folder):
    return _counts(spark, folder)


def q_latest_reference_count(spark, folder):
    entries = register(spark, folder).distinct()
    return R.latest_reference_count(entries, _counts(spark, folder), _RULES)


def resolution(spark, folder) -> R.Resolution:
    manual = spark.createDataFrame(
        [("SMALL ROD", "Small Rod", "Brand#9", "agreed by hand")], "name string, canonical string, `group` string, note string"
    )
    return R.resolve_entities(
        source_names(spark, folder), ["in_sales", "in_stock"], ["in_sales"], register(spark, folder), manual,
        _RULES, _weights(spark, folder), _counts(spark, folder),
    )


def q_resolve(spark, folder):
    return resolution(spark, folder).names


def q_review_queue(spark, folder):
    return R.review_queue(resolution(spark, folder), K.REQUIRED, ["in_sales", "in_stock"])


def q_resolution_audit(spark, folder):
    return R.resolution_audit(resolution(spark, folder), ["in_sales", "in_stock"])


# Without similarity: a threshold that no pair reaches leaves the other rules to decide.
_NO_SIMILARITY = 1.5


def settled(spark, folder) -> R.Resolution:
    """Names resolved by total rows, a hand-made row, exact and alias keys and places alone."""
    manual = spark.range(1).select(
        F.lit("SMALL ROD").alias("name"), F.lit("Small Rod").alias("canonical"), F.lit("Brand#9").alias("group"), F.lit("agreed by hand").alias("note")
    )
    return R.resolve_entities(
        source_names(spark, folder), ["in_sales", "in_stock"], ["in_sales"], register(spark, folder), manual,
        _RULES, _weights(spark, folder), None, _NO_SIMILARITY,
    )


def q_resolve_settled(spark, folder):
    return settled(spark, folder).names


def q_review_queue_settled(spark, folder):
    return R.review_queue(settled(spark, folder), K.REFERENCE_ONLY, ["in_sales", "in_stock"])


def q_resolution_audit_settled(spark, folder):
    return R.resolution_audit(settled(spark, folder), ["in_sales", "in_stock"], required_flags=["in_sales"])


def _group_names(spark, folder) -> DataFrame:
    """A crosswalk of the resolved groups: some carried over, one to review."""
    part = C.table(spark, folder, "part").select((F.length("p_type") % 3 + 1).alias("n")).distinct()
    name = F.concat(F.lit("Brand#"), F.col("n").cast("string"))
    return part.filter("n <> 2").select(
        name.alias("source"), F.concat(F.lit("House "), F.col("n").cast("string")).alias("name"),
        F.when(F.col("n") == 3, K.NEEDS_REVIEW).otherwise(K.HARMONIZED).alias("status"), F.lit("by list").alias("notes"), F.col("n").alias("seq"),
    )


def q_assign_group(spark, folder):
    """The resolved names' groups carried over to the common spelling."""
    names = settled(spark, folder).names.select("name", F.col("group").alias("group_source"))
    return H.lookup_exact(names, "group_source", _group_names(spark, folder), _CROSSWALK, "seq", ["group", "group_status", "group_note"])


_KEYED_RULES = R.NameRules(
    stop_tokens=["ib"], prefixes=_PART_PREFIXES, count_keys={("red ring", "Brand#1"): "old bolt", ("old ring", "Brand#2"): "no such name"}
)


def q_latest_reference_keyed(spark, folder):
    """Counts of register entries, two of them looked up by a listed key first."""
    return R.latest_reference_count(register(spark, folder).distinct(), _counts(spark, folder), _KEYED_RULES)


def q_dedup_first(spark, folder):
    """The first event of each user by type, of equal ones the one that sorts first."""
    events = C.table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return dedup(events, ["user_id"], "event_type", "first")


def q_dedup_error(spark, folder):
    """All orders, as no key is repeated."""
    return dedup(C.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], "o_custkey", "error")


def q_nearest_magnitude(spark, folder):
    """Per user, the event type whose count is nearest to the user's mean value."""
    events = C.table(spark, folder, "events")
    users = events.groupBy("user_id").agg(F.floor(F.avg(F.col("value").cast("decimal(18,2)"))).cast("bigint").alias("weight"))
    counted = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("count"))
    names = users.select(F.col("user_id").cast("string").alias("name"), F.lit("thing").alias("folded"), "weight")
    candidates = counted.select(
        F.col("user_id").cast("string").alias("name"),
        F.lit("Thing").alias("canonical"),
        F.col("event_type").alias("group"),
        F.dense_rank().over(_by_type()).alias("rank"),
        "count",
    )
    rules = R.NameRules(magnitude={"thing": "view"})
    return R.nearest_magnitude(candidates, names, "name", rules, min_gap=1)


def _by_type():
    from pyspark.sql import Window

    return Window.partitionBy("user_id").orderBy("event_type")


def q_latest_per_key(spark, folder):
    """Newest event of a day per user and type, the first one on equal days."""
    events = C.table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    return latest_per_key(events, ["user_id", "event_type"], "day", "event_id", ["event_id", "value"])


def q_token_patterns(spark, folder):
    """Ten most common leading word pairs of all documents."""
    folded = C.table(spark, folder, "documents").select("doc_id", N.fold_name("text", []).alias("folded"))
    return M.token_pattern_top_k(folded, "folded", "doc_id")


_ALIAS_SQL = "regexp_replace(regexp_replace({0}, '^smallenn i ', 'small '), '^smallenn ', 'small ')"
_LABEL_SQL = """labels_of AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'Smallenn i ' || p_name
  WHEN 2 THEN p_name || ' (Old Ring) / Rod ib ' || p_brand ELSE 'Grunnskólinn ' || p_brand || ' / Barnaskóli' END AS label FROM part)"""
_FOLD_LABEL = sql_fold_name("label", K.STOP_TOKENS)


def _sql_alias(e: str) -> str:
    for source, target in K.ALIAS_PREFIXES + _PART_PREFIXES:
        e = f"regexp_replace({e}, '^{source}', '{target}')"
    return e


_VARIANT_SQL = f"""WITH {_LABEL_SQL},
parts AS (SELECT p_partkey, label, regexp_replace(label, '\\([^)]*\\)', ' ', 'g') AS cleaned FROM labels_of),
pieces AS (SELECT p_partkey, label AS piece FROM parts UNION ALL SELECT p_partkey, cleaned FROM parts
  UNION ALL SELECT p_partkey, unnest(string_split(cleaned, '/')) FROM parts WHERE contains(cleaned, '/')),
folded AS (SELECT p_partkey, {sql_fold_name('piece', K.STOP_TOKENS)} AS v FROM pieces),
carried AS (SELECT p_partkey, 'barnaskoli ' || regexp_extract({sql_fold_name("string_split(cleaned, '/')[1]", K.STOP_TOKENS)}, '^grunnskoli(?:nn)? (.+)', 1) AS v
  FROM parts WHERE p_partkey % 4 = 3),
every AS (SELECT * FROM folded UNION SELECT p_partkey, {_sql_alias('v')} FROM folded UNION SELECT * FROM carried)
SELECT p_partkey, string_agg(v, '|' ORDER BY v) AS variants FROM every WHERE v <> '' GROUP BY p_partkey"""

_MANUAL_SQL = """edited0 AS (SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN quality = 1 THEN 'edited' END AS canonical,
    CASE WHEN toxic = 1 THEN 'moved' END AS "group", CAST(NULL AS VARCHAR) AS note, doc_id AS seq FROM labels),
edited AS (SELECT * FROM edited0 UNION ALL SELECT 'x' || key, canonical, "group", 'only edited', seq FROM edited0 WHERE seq % 7 = 0),
defaults AS (SELECT CAST(doc_id AS VARCHAR) AS key, lang AS canonical, source AS "group", 'default' AS note FROM documents)"""

_HARMONIZED_SQL = f"""{_CROSSWALK_SQL}, {_SPELLED_SQL},
listed AS (SELECT trim(source) AS source, name, status, coalesce(notes, '') AS notes, seq FROM crosswalk),
exact AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY source ORDER BY seq DESC) = 1),
folded AS (SELECT *, {sql_fold_key('source')} AS fold FROM listed QUALIFY row_number() OVER (PARTITION BY {sql_fold_key('source')} ORDER BY seq) = 1),
keyed AS (SELECT *, trim(spelling) AS k, {sql_fold_key('trim(spelling)')} AS f FROM spelled),
variants AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v[0]}', '{v[1]}', '{v[2]}')" for k, v in _VARIANTS.items())}) t(source, name, status, note)),
harmonized AS (SELECT c_custkey, spelling,
    CASE WHEN e.source IS NOT NULL THEN e.name WHEN v.source IS NOT NULL THEN v.name WHEN o.fold IS NOT NULL THEN o.name ELSE k END AS name,
    CASE WHEN e.source IS NOT NULL THEN e.status WHEN v.source IS NOT NULL THEN v.status WHEN o.fold IS NOT NULL THEN o.status ELSE 'unchanged' END AS status,
    CASE WHEN e.source IS NOT NULL THEN e.notes WHEN v.source IS NOT NULL THEN v.note
      WHEN o.fold IS NOT NULL THEN CASE WHEN o.source <> k THEN trim('{H.FOLDED_NOTE} ' || o.notes) ELSE o.notes END
      ELSE '{H.CARRIED_NOTE}' END AS note
  FROM keyed LEFT JOIN exact e ON k = e.source LEFT JOIN variants v ON k = v.source LEFT JOIN folded o ON f = o.fold)"""

_TRIED_SQL = f"""{_REGISTER_SQL}, {_NAMES_SQL},
folded AS (SELECT *, {sql_fold_name('name', ['ib'])} AS folded FROM names),
entries AS (SELECT lower(canonical) AS v, min((canonical, "group")) AS lo, max((canonical, "group")) AS hi FROM register GROUP BY 1),
tried AS (SELECT DISTINCT name, folded, unnest([folded, {_ALIAS_SQL.format('folded')}]) AS v FROM folded)"""

_JUDGED_SQL = f"""{_TRIED_SQL},
hits AS (SELECT name, min(lo) AS lo, max(hi) AS hi, min(lo) FILTER (WHERE v = folded) AS dlo, max(hi) FILTER (WHERE v = folded) AS dhi
  FROM tried JOIN entries USING (v) GROUP BY name),
weighed AS (SELECT upper(p_name) AS name, CAST(arg_max(p_size, p_partkey) AS BIGINT) AS weight FROM part GROUP BY 1),
judged AS (SELECT f.*, w.weight, lo, hi, dlo, dhi,
    CASE WHEN contains(folded, 'anvil') THEN 'Brand#3' WHEN contains(folded, 'gizmo') THEN 'Brand#4' END AS hint
  FROM folded f LEFT JOIN weighed w USING (name) LEFT JOIN hits USING (name)),
settled_first AS (SELECT *, CASE WHEN folded IN ('red ring', 'hot rod') THEN 'excluded' WHEN name = 'SMALL ROD' THEN 'manual' WHEN dlo = dhi THEN 'exact'
    WHEN lo = hi THEN 'alias' END AS first_b FROM judged)"""


def _outcome_sql(source: str) -> str:
    """The resolution's columns from rows with a branch ``b``, the best candidate and the size evidence."""
    return f"""SELECT name, folded, in_sales, in_stock, weight,
    CASE b WHEN 'excluded' THEN '{K.EXCLUDED}' WHEN 'manual' THEN '{K.MATCHED_MANUAL}' WHEN 'exact' THEN '{K.MATCHED_EXACT}'
      WHEN 'alias' THEN '{K.MATCHED_RULE}' WHEN 'size' THEN '{K.MATCHED_RULE}' WHEN 'fuzzy' THEN '{K.MATCHED_FUZZY}'
      WHEN 'hint' THEN '{K.MATCHED_GROUP_ONLY}' ELSE '{K.NEEDS_MANUAL_REVIEW}' END AS match_status,
    CASE b WHEN 'manual' THEN 'Small Rod' WHEN 'exact' THEN dlo[1] WHEN 'alias' THEN lo[1] WHEN 'size' THEN size_canonical WHEN 'fuzzy' THEN c1 END AS canonical,
    CASE b WHEN 'manual' THEN 'Brand#9' WHEN 'exact' THEN dlo[2] WHEN 'alias' THEN lo[2] WHEN 'size' THEN size_group WHEN 'fuzzy' THEN g1
      WHEN 'hint' THEN hint END AS "group",
    CASE WHEN b IN ('excluded', 'manual', 'exact', 'alias') THEN '1.000' WHEN b = 'size' THEN '0.950' ELSE printf('%.3f', s1) END AS match_confidence,
    CASE b WHEN 'excluded' THEN 'rule' WHEN 'manual' THEN 'manual' WHEN 'exact' THEN 'register' WHEN 'alias' THEN 'register_alias'
      WHEN 'size' THEN 'name_plus_size_rule' WHEN 'fuzzy' THEN 'register' WHEN 'hint' THEN 'municipality_location_hint' END AS match_source,
    size_note,
    CASE b WHEN 'excluded' THEN 'total or grouped row; no group assigned' WHEN 'manual' THEN 'agreed by hand' WHEN 'exact' THEN 'exact folded name'
      WHEN 'alias' THEN 'alias rule: slash, parenthesis or prefix form' WHEN 'size' THEN size_note
      WHEN 'fuzzy' THEN 'high-confidence similar name; review optional' WHEN 'hint' THEN 'group from a place named in the source; entity uncertain'
      ELSE 'no exact, rule, place or high-confidence match' END AS note,
    CASE WHEN b = 'excluded' THEN '{K.EXCLUDED}' WHEN in_sales THEN '{K.REQUIRED}' ELSE '{K.REFERENCE_ONLY}' END AS priority
  FROM {source}"""


_SETTLED_SQL = f"""{_JUDGED_SQL},
branched AS (SELECT *, coalesce(first_b, CASE WHEN hint IS NOT NULL THEN 'hint' ELSE 'review' END) AS b, CAST(NULL AS VARCHAR) AS c1, CAST(NULL AS VARCHAR) AS g1,
    CAST(NULL AS DOUBLE) AS s1, CAST(NULL AS VARCHAR) AS size_canonical, CAST(NULL AS VARCHAR) AS size_group, CAST(NULL AS VARCHAR) AS size_note FROM settled_first),
settled AS ({_outcome_sql('branched')})"""


def _candidates_sql(names: str) -> str:
    """CTEs up to ``candidates(name, rank, canonical, group, score)`` of a query of names."""
    return f"""spelled AS (SELECT name, v AS a FROM tried WHERE name IN ({names}) AND v <> ''),
{ratio_ctes('SELECT a FROM spelled', 'SELECT v FROM entries', K.SIMILARITY_REVIEW)},
scored AS (SELECT s.name, r.canonical, r."group", max(round_even(x.score, 3)) AS score FROM spelled s JOIN ratio x USING (a) JOIN register r ON lower(r.canonical) = x.b GROUP BY ALL),
candidates AS (SELECT * FROM (SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY score DESC, canonical, "group") AS INTEGER) AS rank, canonical, "group", score FROM scored)
  WHERE rank <= {K.CANDIDATES_KEPT})"""


_SIMILAR_SQL = f"{_TRIED_SQL}, {_candidates_sql('SELECT name FROM names')}"

_RESOLVED_SQL = f"""{_JUDGED_SQL},
{_candidates_sql('SELECT name FROM settled_first WHERE first_b IS NULL')},
latest AS (SELECT p_name AS variant, CAST(p_size * 7 AS BIGINT) AS count FROM part WHERE p_size % 4 <> 0
  QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey % 9 DESC, p_partkey) = 1),
counted AS (SELECT c.*, l.count FROM candidates c LEFT JOIN latest l ON lower(c.canonical) = l.variant),
namesakes AS (SELECT c.*, j.weight, abs(c.count - j.weight) AS gap FROM counted c JOIN settled_first j USING (name)
  WHERE j.first_b IS NULL AND j.weight IS NOT NULL AND c.count IS NOT NULL AND folded IN ('old ring', 'old bolt', 'new plate') AND lower(c.canonical) = folded),
nearest AS (SELECT *, row_number() OVER w AS place, lead(gap) OVER w AS next_gap, lead(count) OVER w AS next_count FROM namesakes
  WINDOW w AS (PARTITION BY name ORDER BY gap, rank)),
sized AS (SELECT name, canonical AS size_canonical, "group" AS size_group,
    'observed count ' || weight || ' is nearer to ' || count || ' than to ' || next_count || ', the next namesake' AS size_note
  FROM nearest WHERE place = 1 AND next_gap - gap >= {K.MAGNITUDE_GAP} AND "group" = 'Brand#2'),
top AS (SELECT name, {', '.join(f'max({c}) FILTER (WHERE rank = {r}) AS {a}{r}' for r in (1, 2) for c, a in (('canonical', 'c'), ('"group"', 'g'), ('score', 's'), ('count', 'n')))}
  FROM counted GROUP BY name),
branched AS (SELECT *, coalesce(first_b, CASE WHEN size_note IS NOT NULL THEN 'size'
    WHEN s1 >= {K.SIMILARITY_ACCEPT} AND (s2 IS NULL OR s1 - s2 >= {K.SIMILARITY_GAP}) AND (hint IS NULL OR g1 = hint) THEN 'fuzzy'
    WHEN hint IS NOT NULL THEN 'hint' ELSE 'review' END) AS b FROM settled_first LEFT JOIN sized USING (name) LEFT JOIN top USING (name)),
settled AS ({_outcome_sql('branched')}),
queue AS (SELECT s.name, s.folded, {', '.join(f'{a}{r} AS possible_match_{r}{c}' for r in (1, 2) for a, c in (('c', ''), ('g', '_group'), ('s', '_score'), ('n', '_count')))}, s.weight,
    coalesce(s.size_note, CASE WHEN s.weight IS NOT NULL AND n1 IS NOT NULL AND n2 IS NOT NULL THEN 'counts are shown for context; size alone did not decide' END) AS size_note,
    s.in_sales, s.in_stock, s.note, s.priority
  FROM settled s LEFT JOIN top USING (name) WHERE match_status = '{K.NEEDS_MANUAL_REVIEW}')"""


def _audit_sql(ctes: str, required: str, unresolved: str) -> str:
    return f"""WITH RECURSIVE {ctes},
        totals AS (SELECT count(*) AS total_names, count("group") AS names_with_group, count(*) FILTER (WHERE priority = '{K.REQUIRED}') AS required_total,
          count(*) FILTER (WHERE priority = '{K.REFERENCE_ONLY}') AS reference_only_total,
          count(*) FILTER (WHERE priority = '{K.REQUIRED}' OR (priority = '{K.EXCLUDED}' AND {required})) AS relevant_total_with_excluded,
          0 AS groups_harmonized, 0 AS groups_needing_review FROM settled),
        rates AS ({' UNION ALL '.join(f"""SELECT '{f}' AS f, count(*) FILTER (WHERE {f}) AS n, count(*) FILTER (WHERE {f} AND "group" IS NOT NULL) AS m
          FROM settled WHERE priority <> '{K.EXCLUDED}'""" for f in ('in_sales', 'in_stock'))}),
        open_words AS (SELECT array_to_string(string_split(folded, ' ')[1:2], ' ') AS pattern, name FROM settled
          WHERE match_status = '{K.NEEDS_MANUAL_REVIEW}' AND priority = '{K.REFERENCE_ONLY}'),
        patterns AS (SELECT pattern, count(*) AS n, min(name) AS first_seen FROM open_words GROUP BY 1 ORDER BY n DESC, first_seen, pattern LIMIT 10)
        {' UNION ALL '.join(f"SELECT 'summary' AS section, '' AS dataset, '{t}' AS item, CAST({t} AS VARCHAR) AS value FROM totals" for t in (
            'total_names', 'names_with_group', 'required_total', 'reference_only_total', 'relevant_total_with_excluded', 'groups_harmonized', 'groups_needing_review'))}
        UNION ALL SELECT 'summary', priority, match_status, CAST(count(*) AS VARCHAR) FROM settled GROUP BY ALL
        UNION ALL SELECT 'match_rate_by_source', f, 'matched_non_excluded', printf('%d/%d (%.1f%%)', m, n, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE m * 100.0::DOUBLE / n END) FROM rates
        UNION ALL {unresolved}
        UNION ALL SELECT 'common_unmatched_patterns', '', pattern, CAST(n AS VARCHAR) FROM patterns"""


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

ORACLES = {
    "q_resolve_settled": f"WITH {_SETTLED_SQL} SELECT * FROM settled",
    "q_review_queue_settled": f"""WITH {_SETTLED_SQL} SELECT name, folded,
        {', '.join(f'CAST(NULL AS {kind}) AS possible_match_{i}{c}' for i in (1, 2) for c, kind in (('', 'VARCHAR'), ('_group', 'VARCHAR'), ('_score', 'DOUBLE'), ('_count', 'BIGINT')))},
        weight, CAST(NULL AS VARCHAR) AS size_note, in_sales, in_stock, note || '; reference only, not needed downstream' AS note
        FROM settled WHERE match_status = '{K.NEEDS_MANUAL_REVIEW}' AND priority = '{K.REFERENCE_ONLY}'""",
    "q_resolution_audit_settled": _audit_sql(_SETTLED_SQL, "in_sales", f"""SELECT 'unresolved_required', '', name,
          'weight=' || coalesce(CAST(weight AS VARCHAR), '') || '; possible_match_1=; group=; score='
          FROM settled WHERE match_status = '{K.NEEDS_MANUAL_REVIEW}' AND priority = '{K.REQUIRED}'"""),
    "q_similarity_top5": f"""WITH RECURSIVE {_SIMILAR_SQL} SELECT * FROM candidates""",
    "q_resolve": f"""WITH RECURSIVE {_RESOLVED_SQL} SELECT * FROM settled""",
    "q_review_queue": f"""WITH RECURSIVE {_RESOLVED_SQL} SELECT * EXCLUDE (priority) FROM queue WHERE priority = '{K.REQUIRED}'""",
    "q_resolution_audit": _audit_sql(_RESOLVED_SQL, "(in_sales OR in_stock)", f"""SELECT 'unresolved_required', '', name,
          'weight=' || coalesce(CAST(weight AS VARCHAR), '') || '; possible_match_1=' || coalesce(possible_match_1, '') || '; group=' || coalesce(possible_match_1_group, '')
          || '; score=' || coalesce(CAST(possible_match_1_score AS VARCHAR), '') FROM queue WHERE priority = '{K.REQUIRED}'"""),
    "q_dq_queue": f"""WITH RECURSIVE {_RESOLVED_SQL}, both_of AS (SELECT name, name || CASE WHEN name LIKE 'Very hot%' THEN '!' ELSE '' END AS other FROM queue WHERE priority = '{K.REQUIRED}')
        SELECT 'queue' AS "check", 'review' AS "table", name AS row_key, 'name' AS "column", '' AS observed, 'queued but resolved' AS message
        FROM both_of WHERE name NOT IN (SELECT other FROM both_of)
        UNION ALL SELECT 'queue', 'review', other, 'name', '', 'unresolved but not queued' FROM both_of WHERE other NOT IN (SELECT name FROM both_of)""",
    "q_assign_group": f"""WITH {_SETTLED_SQL}, listed AS (SELECT DISTINCT 'Brand#' || n AS source, 'House ' || n AS name,
          CASE WHEN n = 3 THEN 'needs_review' ELSE 'harmonized' END AS status FROM (SELECT length(p_type) % 3 + 1 AS n FROM part) WHERE n <> 2)
        SELECT s.name, s."group" AS group_source, coalesce(l.name, s."group") AS "group",
          CASE WHEN s."group" IS NULL THEN NULL ELSE coalesce(l.status, 'unchanged') END AS group_status,
          CASE WHEN s."group" IS NULL THEN NULL WHEN l.name IS NOT NULL THEN 'by list' ELSE '{H.CARRIED_NOTE}' END AS group_note
        FROM settled s LEFT JOIN listed l ON s."group" = l.source""",
    "q_latest_reference_keyed": f"""WITH {_REGISTER_SQL}, latest AS (SELECT p_name AS variant, CAST(p_size * 7 AS BIGINT) AS count
          FROM part WHERE p_size % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey % 9 DESC, p_partkey) = 1),
        both_of AS (SELECT r.canonical, r."group", coalesce(CASE WHEN lower(r.canonical) = 'red ring' AND r."group" = 'Brand#1' THEN b.count END, l.count) AS count
          FROM register r LEFT JOIN latest l ON lower(r.canonical) = l.variant LEFT JOIN latest b ON b.variant = 'old bolt')
        SELECT * FROM both_of WHERE count IS NOT NULL""",
    "q_dedup_first": """SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id, value) = 1""",
    "q_dedup_error": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "q_harmonize": f"WITH {_HARMONIZED_SQL} SELECT * FROM harmonized",
    "q_lookup_exact": f"""WITH {_HARMONIZED_SQL} SELECT c_custkey, spelling,
        CASE WHEN e.source IS NOT NULL THEN e.name ELSE nullif(k, '') END AS name,
        CASE WHEN k = '' THEN NULL WHEN e.source IS NOT NULL THEN e.status ELSE 'unchanged' END AS status,
        CASE WHEN k = '' THEN NULL WHEN e.source IS NOT NULL THEN e.notes ELSE '{H.CARRIED_NOTE}' END AS note
        FROM keyed LEFT JOIN exact e ON k = e.source""",
    "q_harmonization_audit": f"""WITH {_HARMONIZED_SQL},
        first AS (SELECT *, count(*) OVER (PARTITION BY spelling) AS n FROM harmonized
          QUALIFY row_number() OVER (PARTITION BY spelling ORDER BY c_custkey) = 1)
        SELECT 'summary' AS section, 'rows' AS item, CAST(sum(n) AS VARCHAR) AS value, '' AS details FROM first
        UNION ALL SELECT 'summary', 'source_names', CAST(count(*) AS VARCHAR), '' FROM first
        UNION ALL SELECT 'summary', 'harmonized_names', CAST(count(DISTINCT name) AS VARCHAR), '' FROM first
        UNION ALL SELECT 'summary', 'names_unchanged', CAST(count(*) FILTER (WHERE status = 'unchanged') AS VARCHAR), '' FROM first
        UNION ALL SELECT 'summary', 'names_harmonized', CAST(count(*) FILTER (WHERE status = 'harmonized') AS VARCHAR), '' FROM first
        UNION ALL SELECT 'summary', 'names_needing_review', CAST(count(*) FILTER (WHERE status = 'needs_review') AS VARCHAR), '' FROM first
        UNION ALL SELECT 'to_review', spelling, name, '' FROM first WHERE status = 'needs_review'
        UNION ALL SELECT 'rows_by_status', status, CAST(count(*) AS VARCHAR), '' FROM harmonized GROUP BY status
        UNION ALL SELECT 'name', spelling, name || ' | ' || status, note FROM first""",
    "q_first_sample": f"""WITH {_HARMONIZED_SQL} SELECT name, spelling, status FROM harmonized
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY c_custkey) = 1""",
    "q_dedup_last": """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "q_dedup_sum": """SELECT user_id, event_type, max(event_id) AS event_id,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY user_id, event_type""",
    "q_fold_key": f"SELECT doc_id, {sql_fold_key('text')} AS folded FROM documents",
    "q_fold_name": f"SELECT doc_id, {sql_fold_name('text', _STOPS)} AS folded FROM documents",
    "q_name_variants": _VARIANT_SQL,
    "q_alias_and_hint": f"""WITH {_LABEL_SQL}, f AS (SELECT p_partkey, {_FOLD_LABEL} AS folded FROM labels_of)
        SELECT p_partkey, {_ALIAS_SQL.format('folded')} AS alias, CASE WHEN contains(folded, 'old') THEN 'first'
          WHEN contains(folded, 'ring') THEN 'second' WHEN contains(folded, 'brand 1') THEN 'third' END AS hint,
          folded IN ('red ring', 'hot rod') AS is_total FROM f""",
    "q_override_rows": f"""WITH {_MANUAL_SQL} SELECT coalesce(e.key, d.key) AS key,
        CASE WHEN e.key IS NOT NULL THEN coalesce(e.canonical, ' ') ELSE d.canonical END AS canonical,
        CASE WHEN e.key IS NOT NULL THEN e."group" ELSE d."group" END AS "group",
        CASE WHEN e.key IS NOT NULL THEN coalesce(e.note, '') ELSE d.note END AS note
        FROM defaults d FULL JOIN edited e ON d.key = e.key""",
    "q_override_fields": f"""WITH {_MANUAL_SQL} SELECT coalesce(e.key, d.key) AS key, coalesce(e.canonical, d.canonical) AS canonical,
        coalesce(e."group", d."group") AS "group", coalesce(e.note, d.note) AS note
        FROM defaults d FULL JOIN edited e ON d.key = e.key""",
    "q_review_template": f"""WITH {_MANUAL_SQL}, kept AS (SELECT key, key AS folded, coalesce(canonical, ' ') AS canonical, "group"
          FROM edited WHERE canonical IS NOT NULL OR "group" IS NOT NULL)
        SELECT * FROM kept UNION ALL SELECT CAST(doc_id AS VARCHAR), lang, NULL, NULL FROM documents
        WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT key FROM kept)""",
    "q_presence_names": f"WITH {_NAMES_SQL} SELECT * FROM names",
    "q_attach_weight": f"""WITH {_NAMES_SQL} SELECT name, weight FROM names LEFT JOIN
        (SELECT upper(p_name) AS name, CAST(arg_max(p_size, p_partkey) AS BIGINT) AS weight FROM part GROUP BY 1) USING (name)""",
    "q_latest_counts": """SELECT p_name AS variant, CAST(p_size * 7 AS BIGINT) AS count FROM part WHERE p_size % 4 <> 0
        QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey % 9 DESC, p_partkey) = 1""",
    "q_latest_reference_count": f"""WITH {_REGISTER_SQL}, latest AS (SELECT p_name AS variant, CAST(p_size * 7 AS BIGINT) AS count
          FROM part WHERE p_size % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey % 9 DESC, p_partkey) = 1)
        SELECT canonical, "group", count FROM register JOIN latest ON lower(canonical) = variant""",
    "q_unique_candidate": f"""WITH {_REGISTER_SQL}, {_NAMES_SQL}, once AS (SELECT lower(canonical) AS v, min(canonical) AS canonical,
          min("group") AS "group" FROM register GROUP BY 1 HAVING count(*) = 1),
        variants AS (SELECT DISTINCT name, unnest([{sql_fold_name('name', ['ib'])},
          {_ALIAS_SQL.format(sql_fold_name('name', ['ib']))}]) AS v FROM names),
        hits AS (SELECT name, r.canonical, r."group" FROM variants JOIN register r ON lower(r.canonical) = v)
        SELECT name, min(canonical) AS canonical, min("group") AS "group" FROM hits
        GROUP BY name HAVING count(DISTINCT (canonical, "group")) = 1""",
    "q_nearest_magnitude": """WITH u AS (SELECT user_id, CAST(floor(sum(CAST(value AS DECIMAL(18,2))) / count(*)) AS BIGINT) AS weight FROM events GROUP BY 1),
        c AS (SELECT user_id, event_type, count(*) AS n, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS rank
          FROM events GROUP BY 1, 2),
        r AS (SELECT *, abs(n - weight) AS gap, row_number() OVER w AS place, lead(abs(n - weight)) OVER w AS next_gap, lead(n) OVER w AS next_n
          FROM c JOIN u USING (user_id) WINDOW w AS (PARTITION BY user_id ORDER BY abs(n - weight), rank))
        SELECT CAST(user_id AS VARCHAR) AS name, 'Thing' AS canonical, event_type AS "group",
          'observed count ' || weight || ' is nearer to ' || n || ' than to ' || next_n || ', the next namesake' AS size_note
        FROM r WHERE place = 1 AND next_gap - gap >= 1 AND event_type = 'view'""",
    "q_latest_per_key": """SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id) = 1""",
    "q_token_patterns": f"""WITH f AS (SELECT doc_id, string_split({sql_fold_name('text', [''])}, ' ') AS words FROM documents)
        SELECT array_to_string(words[1:2], ' ') AS pattern, count(*) AS n, min(doc_id) AS first_seen FROM f
        GROUP BY 1 ORDER BY n DESC, first_seen, pattern LIMIT 10""",
}
