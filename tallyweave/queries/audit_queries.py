"""Queries on presence, gaps, audits and data-quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyweave import constants as K
from tallyweave.operators import coverage as V, keys, measures as M, quality as Q
from tallyweave.operators.resolve import presence_matrix, review_queue
from tallyweave.queries import common as C, measure_queries as MQ, name_queries as NQ
from tallyweave.session import shared


def _nation_sources(spark, folder) -> dict[str, DataFrame]:
    """All customers, suppliers and orders with their nation's name, which some nations leave blank.

    Which ones, nation keys say, so there are gaps between the sources at every size.
    """
    nation = C.table(spark, folder, "nation")
    customer = C.table(spark, folder, "customer")
    buyers = C.table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))

    def named(df: DataFrame, key: str, every: int, left_out: int) -> DataFrame:
        name = F.when(F.col(key) % every != left_out, F.col("n_name"))
        spelling = F.when(F.col(key) % 4 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
        return df.join(nation, F.col(key) == F.col("n_nationkey")).select(name.alias("n_name"), spelling.alias("spelling"))

    return {
        "reading": named(customer, "c_nationkey", *_GAPS["reading"]),
        "spending": named(C.table(spark, folder, "supplier"), "s_nationkey", *_GAPS["spending"]),
        "outcomes": named(buyers, "c_nationkey", *_GAPS["outcomes"]),
    }


# Nation keys whose remainder is left blank, by source.
_GAPS = {"reading": (7, 2), "spending": (5, 3), "outcomes": (6, 2)}


_FLAGS = ["reading", "spending", "outcomes"]
_PRESENCE_SQL = """sources AS (
  SELECT 'reading' AS src, c_nationkey AS k FROM customer WHERE c_nationkey % 7 <> 2
  UNION ALL SELECT 'spending', s_nationkey FROM supplier WHERE s_nationkey % 5 <> 3
  UNION ALL SELECT 'outcomes', c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 6 <> 2),
presence AS (SELECT n_name AS name, n_nationkey AS k, bool_or(src = 'reading') AS reading, bool_or(src = 'spending') AS spending,
    bool_or(src = 'outcomes') AS outcomes FROM sources JOIN nation ON k = n_nationkey GROUP BY ALL)"""
_PAIRS = [(a, b) for a in _FLAGS for b in _FLAGS if a != b]
_GAPS_SQL = f"""gaps AS ({' UNION ALL '.join(f"SELECT '{a}_not_{b}' AS comparison, * FROM presence WHERE {a} AND NOT {b}" for a, b in _PAIRS)})"""


def q_presence_matrix(spark, folder):
    return presence_matrix({k: (df, "n_name") for k, df in _nation_sources(spark, folder).items()})


def q_gap_audit(spark, folder):
    return V.gap_rows(q_presence_matrix(spark, folder), "name", _FLAGS)


def q_gap_classified(spark, folder):
    sources = {k: (df, "n_name", "spelling") for k, df in _nation_sources(spark, folder).items()}
    return V.classified_gap_audit(
        sources, "name", ["reading_not_spending", "outcomes_not_spending", "spending_not_reading", "spending_not_outcomes"],
        target="spending", outcome_sources=["reading", "outcomes"], known_gaps=["NATION_3", "NATION_8"],
        true_gap_comparisons={"spending_not_reading": "no reading source"},
    )


def _key_sets(spark, folder) -> tuple[DataFrame, DataFrame]:
    buyers = keys.key_set(C.table(spark, folder, "orders"), "o_custkey", "entity")
    # Some customers' keys are blank; the key set leaves them out.
    customer = C.table(spark, folder, "customer")
    known = customer.select(F.when(F.col("c_custkey") % 5 != 2, F.col("c_custkey")).alias("c_custkey"))
    return buyers, keys.key_set(known, "c_custkey", "entity")


def q_key_union(spark, folder):
    return keys.key_union(*_key_sets(spark, folder))


def q_key_difference(spark, folder):
    return keys.key_difference(*_key_sets(spark, folder))


def q_key_set_equality(spark, folder):
    return keys.key_set_difference_both_ways(*_key_sets(spark, folder))


def q_distinct_list(spark, folder):
    documents = C.table(spark, folder, "documents")
    return V.distinct_lists(
        documents, "domain", {"languages": ("lang", None), "foreign_sources": ("source", F.col("lang") != "en")}
    )


def q_status_counts(spark, folder):
    orders = C.table(spark, folder, "orders")
    return M.status_counts(orders, "o_orderpriority", "o_orderstatus")


def q_match_rate(spark, folder):
    rows = MQ.entity_outcomes(spark, folder)
    return M.match_rate(
        rows, ["has_done", "has_graded", "has_paired"], F.col("second_grade").isNotNull(), ~F.col("is_excluded")
    )


def q_top_k(spark, folder):
    orders = C.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return keys.top_k(orders, 30, F.desc("o_totalprice"), F.asc("o_orderkey"))


def q_coverage_audit(spark, folder):
    """The long audit of spine, entity table and group summary."""
    spine = MQ.spine(spark, folder)
    entities = shared(MQ.entity_outcomes(spark, folder), "entity")
    groups = MQ.summary(spark, folder, entities).withColumnRenamed("source_name", "name")
    sources = {
        "reading": F.col("strict_period").isNotNull(),
        "spending": F.col("net_amount").isNotNull(),
        "outcomes": F.col("_in_groups"),
    }
    return V.coverage_audit(
        spine, entities, groups, "name", sources, weak_below=0.9, caveats=[("values", "suppressed cells", "small cells are NULL")]
    )


# --- data quality -------------------------------------------------------------------

def _line_table(spark, folder) -> DataFrame:
    """Lines with seeded defects in a few of them, by key arithmetic over all rows."""
    lines = C.table(spark, folder, "lineitem").withColumn("k", (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1000)
    k = F.col("k")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(k == 1, "12a").when(k == 2, "").otherwise(F.col("l_quantity").cast("string")).alias("quantity_text"),
        F.when(k == 3, -1.0).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(k == 4, "x").otherwise("").alias("must_stay_blank"),
        "l_extendedprice",
        F.when(k == 5, F.col("l_extendedprice") / F.col("l_quantity") + 1)
        .otherwise(M.safe_ratio(price, "l_quantity")).alias("unit_price"),
        F.when(k == 6, F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice") * F.col("l_discount")).alias("rebate"),
        F.when(k == 7, K.NEEDS_REVIEW).otherwise(K.UNCHANGED).alias("status"),
        "l_returnflag", "l_linestatus",
        F.when(k == 8, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
    )


def q_dq_row_rules(spark, folder):
    """Numeric, range, blank, ratio, bound, status, implication: all rules in one pass.

    The text of computed floating point numbers is left out, as engines print it differently.
    """
    found = Q.check_rows(
        _line_table(spark, folder), "lines", ["l_orderkey", "l_linenumber", "l_partkey"],
        [
            Q.expect_numeric("quantity_text", allow_blank=False),
            Q.expect_range("quantity", low=0, high=1000, whole=True),
            Q.expect_blank("must_stay_blank"),
            Q.expect_ratio("unit_price", "l_extendedprice", "quantity"),
            Q.expect_bounded_by("rebate", "l_extendedprice"),
            Q.expect_status_absent("status"),
            Q.expect_not_blank("flag"),
            Q.expect_implies("returned lines are final", F.col("l_returnflag") == "R", F.col("l_linestatus") == "F", "l_linestatus"),
        ],
    )
    computed = F.col("column").isin("rebate", "unit_price")
    return found.withColumn("observed", F.when(computed, "").otherwise(F.col("observed")))


_LINE_SQL = """k AS (SELECT *, (l_orderkey * 7 + l_linenumber) % 1000 AS k, l_orderkey || ' | ' || l_linenumber || ' | ' || l_partkey AS row_key,
  CASE WHEN (l_orderkey * 7 + l_linenumber) % 1000 = 3 THEN -1.0 ELSE l_quantity END AS quantity FROM lineitem)"""


def _violation_sql(check: str, table: str, key: str, column: str, observed: str, message: str, rest: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", {key} AS row_key, '{column}' AS \"column\", "
        f"coalesce(CAST({observed} AS VARCHAR), '') AS observed, {message} AS message {rest}"
    )


def q_dq_required(spark, folder):
    """Columns that must exist, tables that must have rows, an exact row count."""
    customer, orders = C.table(spark, folder, "customer"), C.table(spark, folder, "orders")
    columns = Q.require_columns(orders, "orders", ["o_orderkey", "o_clerk", "o_comment", "o_orderdate"])
    empty = Q.require_rows(customer.filter("c_acctbal > 1e9"), "rich customers")
    exact = Q.require_rows(customer, "customer", exactly=7)
    return keys.append_sections(columns, empty, exact, Q.require_rows(customer, "customer"))


def q_dq_domain(spark, folder):
    orders = C.table(spark, folder, "orders")
    return Q.expect_domain(orders, "orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "6-NONE"])


def q_dq_cardinality(spark, folder):
    orders = C.table(spark, folder, "orders")
    exact = Q.expect_cardinality(orders, "orders", "o_orderstatus", exactly=2)
    return exact.unionByName(Q.expect_cardinality(orders, "orders", "o_custkey", at_least=10**9))


def q_dq_unique(spark, folder):
    return Q.expect_unique(C.table(spark, folder, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


def q_dq_complete_grid(spark, folder):
    events = C.table(spark, folder, "events").withColumn("day", F.to_date("ts").cast("string"))
    return Q.expect_complete_grid(events, "events", ["user_id", "day"], "event_type", ["click", "view", "error"])


def q_dq_grid_size(spark, folder):
    return Q.expect_grid_size(C.table(spark, folder, "events"), "events", "user_id", 5)


def q_dq_sum(spark, folder):
    wide = MQ.q_align_metrics(spark, folder)
    tight = [
        Q.expect_sum(["urgent", "high", "rest"], tolerance=0.05, name="sum_to_100"),
        Q.expect_sum(["urgent", "high"], whole="urgent_high", tolerance=0.05, name="composite"),
    ]
    return Q.check_rows(wide, "observations", ["source_name", "school_year", "term"], tight).drop("observed")


def q_dq_preserved(spark, folder):
    """Money rows after denominators are attached, with some rows lost, added or changed."""
    before = C.table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    after = before.filter("s_suppkey % 9 <> 4").withColumn(
        "s_name", F.when(F.col("s_suppkey") % 7 == 3, F.upper("s_name")).otherwise(F.col("s_name"))
    ).withColumn("extra", F.lit(1))
    added = after.filter("s_suppkey % 11 = 5").withColumn("s_suppkey", F.col("s_suppkey") + 1000000)
    return Q.expect_preserved(before, after.union(added), "supplier", ["s_suppkey"])


def q_dq_mapping(spark, folder):
    rows = NQ.harmonized(spark, folder)
    expected = {"NATION_0": "AFRICA", "NATION_1": "AFRICA", "Elsewhere 3": "Elsewhere 3", "NATION_99": "EUROPE"}
    return Q.expect_mapping(rows, "harmonized", "spelling", "name", expected, required=True)


def q_dq_retained(spark, folder):
    customer = C.table(spark, folder, "customer").select(F.col("c_custkey").alias("entity"))
    rows = MQ.entity_outcomes(spark, folder)
    downstream = rows.withColumn("kept_group", F.when(F.col("graduates") > 1, F.col("group_name")))
    return Q.expect_retained(customer, downstream, "outcomes", "entity", "kept_group")


def q_dq_referential(spark, folder):
    def wrong_at(key: str, place: int):
        return F.when(F.col(key) % 100 == place, -F.col(key) - 1).otherwise(F.col(key)).alias("key")

    orders = C.table(spark, folder, "orders").select(wrong_at("o_orderkey", 3))
    lines = C.table(spark, folder, "lineitem").select(wrong_at("l_orderkey", 4))
    return Q.expect_referential(lines, orders, "lines", ["key"], equal=True)


def q_dq_recomputed(spark, folder):
    """Agrees on real output; a copy with one value moved in some groups does not."""
    obs = C.reading_slice(spark, folder)
    output = M.strict_and_latest(obs, "group_name", "school_year", "source_name", "value_pct")
    moved = output.withColumn(
        "latest_value", F.when(F.col("group_name") < "B", F.col("latest_value") + 0.5).otherwise(F.col("latest_value"))
    )
    args = ("group_name", "school_year", "source_name", "value_pct")
    good = Q.expect_recomputed(output, obs, "as built", *args)
    return good.unionByName(Q.expect_recomputed(moved, obs, "moved", *args))


def q_dq_queue(spark, folder):
    resolution = NQ.resolution(spark, folder)
    queue = review_queue(resolution, K.REQUIRED, [])
    unresolved = resolution.names.filter(
        (F.col("match_status") == K.NEEDS_MANUAL_REVIEW) & (F.col("priority") == K.REQUIRED)
    )
    renamed = F.when(F.startswith("name", F.lit("Very hot")), F.concat("name", F.lit("!"))).otherwise(F.col("name"))
    return Q.expect_queue(queue, unresolved.withColumn("name", renamed), "review", "name")


def q_dq_items(spark, folder):
    audit = q_distinct_list(spark, folder).filter("section = 'domain'")
    return Q.expect_items(audit, "audit", "item", "value", {"languages": "4", "foreign_sources": "3", "rows": None})


def q_dq_report(spark, folder):
    """Outcome of the unique rule: total and the first 30 messages."""
    violations = q_dq_unique(spark, folder).unionByName(q_dq_domain(spark, folder))
    return Q.quality_report(violations)


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

_MEMBERS = [
    ("latest_available_fallback_groups", "strict_value IS NULL AND latest_value IS NOT NULL"),
    ("multi_component_groups", "strict_component_count > 1"),
    ("weak_coverage_groups", "in_groups AND coalesce(coverage_share, 0) < 0.9"),
    *[(f, f) for f in _FLAGS],
    *[(f"{a}_not_{b}", f"{a} AND NOT {b}") for a, b in _PAIRS],
]
_SOURCE_TEXT = "concat_ws(' | ', " + ", ".join(
    f"CASE WHEN {f} THEN '{f}: ' || CASE WHEN k % 4 = 0 THEN lower(name) ELSE name END END" for f in _FLAGS
) + ")"
_COMPARISONS = ["reading_not_spending", "outcomes_not_spending", "spending_not_reading", "spending_not_outcomes"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_AUDIT_FACTS = f"""joined AS (SELECT coalesce(s.name, g.source_name) AS name, strict_value, latest_value, strict_component_count,
    strict_period IS NOT NULL AS reading, net_amount IS NOT NULL AS spending, g.source_name IS NOT NULL AS outcomes,
    g.source_name IS NOT NULL AS in_groups, coverage_share, strict_period FROM spine s FULL JOIN summary g ON s.name = g.source_name)"""


def _listed(section: str, item: str, condition: str) -> str:
    return f"""SELECT '{section}', '{item}', CAST(count(*) FILTER (WHERE {condition}) AS VARCHAR),
      '' FROM joined"""


_COVERAGE_SQL = "WITH " + ", ".join([*MQ.SPINE_CTES, MQ._OUTCOMES, MQ._SUMMARY, _AUDIT_FACTS]) + _union([
    " SELECT 'summary' AS section, 'spine_rows' AS item, CAST(count(*) AS VARCHAR) AS value, '' AS details FROM spine",
    "SELECT 'summary', 'entity_rows', CAST(count(*) AS VARCHAR), '' FROM outcomes",
    "SELECT 'summary', 'group_summary_rows', CAST(count(*) AS VARCHAR), '' FROM summary",
    "SELECT 'summary', 'strict_latest_period', max(strict_period), '' FROM joined",
    _listed("summary", "latest_available_fallback_groups", "strict_value IS NULL AND latest_value IS NOT NULL"),
    _listed("summary", "multi_component_groups", "strict_component_count > 1"),
    _listed("summary", "weak_coverage_groups", "in_groups AND coalesce(coverage_share, 0) < 0.9"),
    *[_listed("coverage", f, f) for f in _FLAGS],
    *[_listed("join_gap_summary", f"{a}_not_{b}", f"{a} AND NOT {b}") for a, b in _PAIRS],
    *[
        f"SELECT 'join_gap', '{a}_not_{b}', name, 'in_reading=' || reading || '; in_spending=' || spending || '; in_outcomes=' || outcomes FROM joined WHERE {a} AND NOT {b}"
        for a, b in _PAIRS
    ],
    "SELECT 'caveat', 'values', 'suppressed cells', 'small cells are NULL'",
    *[f"SELECT 'member', '{item}', name, '' FROM joined WHERE {condition}" for item, condition in _MEMBERS],
])

_LINE_VIOLATIONS = [
    ("numeric", "quantity_text", "k IN (1, 2)", "CASE WHEN k = 1 THEN '12a' ELSE '' END", "not a number"),
    ("range", "quantity", "k = 3", "'-1.0'", "outside the allowed range"),
    ("blank", "must_stay_blank", "k = 4", "'x'", "must stay blank"),
    ("ratio", "unit_price", "k IN (3, 5)", "NULL", "differs from l_extendedprice/quantity"),
    ("bounded_by", "rebate", "k = 6", "NULL", "exceeds l_extendedprice"),
    ("status_absent", "status", "k = 7", "'needs_review'", "status needs_review is left"),
    ("not_blank", "flag", "k = 8", "''", "must not be blank"),
    ("implies", "l_linestatus", "l_returnflag = 'R' AND l_linestatus <> 'F'", "l_linestatus", "returned lines are final"),
]

ORACLES = {
    "q_presence_matrix": f"WITH {_PRESENCE_SQL} SELECT name, reading, spending, outcomes FROM presence",
    "q_gap_audit": f"WITH {_PRESENCE_SQL}, {_GAPS_SQL} SELECT comparison, name, reading, spending, outcomes FROM gaps",
    "q_gap_classified": f"""WITH {_PRESENCE_SQL}, {_GAPS_SQL},
        classed AS (SELECT *, CASE WHEN name IN ('NATION_3', 'NATION_8') THEN 'known gap: absent from spending after harmonisation'
            WHEN comparison = 'spending_not_reading' THEN 'no reading source'
            WHEN NOT spending AND (reading OR outcomes) THEN 'has outcomes but is absent from spending' END AS why
          FROM gaps WHERE comparison IN ({', '.join(f"'{c}'" for c in _COMPARISONS)}))
        SELECT 'gap' AS section, comparison, name, reading, spending, outcomes,
          CASE WHEN why IS NULL THEN 'possible_harmonization_issue' ELSE 'likely_true_source_coverage_gap' END AS gap_type,
          CASE WHEN why IS NULL THEN 'needs_review' ELSE 'true_source_gap' END AS assessment, {_SOURCE_TEXT} AS source_values,
          coalesce(why, 'unexpected difference; inspect source and harmonised names') AS note FROM classed
        UNION ALL SELECT 'summary', 'all_sources', '', NULL, NULL, NULL, 'coverage_count', 'summary', '',
          'reading=' || count(*) FILTER (WHERE reading) || '; spending=' || count(*) FILTER (WHERE spending) || '; outcomes=' || count(*) FILTER (WHERE outcomes) FROM presence
        UNION ALL {_union([f"SELECT 'spelling', '{f}', name, NULL, NULL, NULL, '', '', CASE WHEN k % 4 = 0 THEN lower(name) ELSE name END, '' FROM (SELECT DISTINCT name, k, {f} FROM classed) WHERE {f}" for f in _FLAGS])}
        UNION ALL {_union([f"SELECT 'summary', '{c}', '', NULL, NULL, NULL, 'gap_count', 'summary', '', CAST(count(*) FILTER (WHERE comparison = '{c}') AS VARCHAR) FROM gaps" for c in _COMPARISONS])}""",
    "q_key_union": "SELECT o_custkey AS entity FROM orders UNION SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 2",
    "q_key_difference": "SELECT o_custkey AS entity FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 2",
    "q_key_set_equality": """SELECT entity, 'left_only' AS side FROM (SELECT o_custkey AS entity FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 2)
        UNION ALL SELECT entity, 'right_only' FROM (SELECT c_custkey AS entity FROM customer WHERE c_custkey % 5 <> 2 EXCEPT SELECT o_custkey FROM orders)""",
    "q_distinct_list": """SELECT 'domain' AS section, 'languages' AS item, CAST(count(DISTINCT lang) AS VARCHAR) AS value, '' AS details FROM documents
        UNION ALL SELECT 'domain', 'foreign_sources', CAST(count(DISTINCT source) AS VARCHAR), '' FROM documents WHERE lang <> 'en'
        UNION ALL SELECT DISTINCT 'domain_member', 'languages', lang, '' FROM documents
        UNION ALL SELECT DISTINCT 'domain_member', 'foreign_sources', source, '' FROM documents WHERE lang <> 'en'""",
    "q_status_counts": "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL",
    "q_match_rate": f"""WITH {C.NATIONS_SQL}, {MQ._OUTCOMES}, flags AS ({_union([f"SELECT '{f}' AS source, second_grade IS NOT NULL AS ok FROM outcomes WHERE NOT is_excluded AND {f}" for f in ('has_done', 'has_graded', 'has_paired')])}),
        n AS (SELECT source, count(*) AS total, count(*) FILTER (WHERE ok) AS matched FROM flags GROUP BY source)
        SELECT source, total, matched, matched / total AS rate, printf('%d/%d (%.1f%%)', matched, total, matched * 100.0::DOUBLE / total) AS rate_text FROM n""",
    "q_top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30",
    "q_coverage_audit": _COVERAGE_SQL,
    "q_dq_row_rules": f"WITH {_LINE_SQL} " + _union([
        _violation_sql(c, "lines", "row_key", col, seen, f"'{m}'", f"FROM k WHERE {cond}")
        for c, col, cond, seen, m in _LINE_VIOLATIONS
    ]),
    "q_dq_required": """SELECT 'columns' AS "check", 'orders' AS "table", '' AS row_key, c AS "column", '' AS observed, 'column is missing' AS message
        FROM (VALUES ('o_clerk'), ('o_comment')) t(c) UNION ALL """
    + _violation_sql("rows", "rich customers", "''", "", "count(*)", "'table is empty'", "FROM customer WHERE c_acctbal > 1e9 HAVING count(*) = 0")
    + " UNION ALL " + _violation_sql("rows", "customer", "''", "", "count(*)", "'expected 7 rows'", "FROM customer HAVING count(*) <> 7"),
    "q_dq_domain": _violation_sql("domain", "orders", "v", "o_orderpriority", "v", "'value outside the domain'",
        "FROM (SELECT DISTINCT o_orderpriority AS v FROM orders) WHERE v NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '6-NONE')")
    + " UNION ALL " + _violation_sql("domain", "orders", "v", "o_orderpriority", "v", "'value never occurs'",
        "FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('6-NONE')) t(v) WHERE v NOT IN (SELECT o_orderpriority FROM orders)"),
    "q_dq_cardinality": _violation_sql("cardinality", "orders", "''", "o_orderstatus", "count(DISTINCT o_orderstatus)", "'unexpected number of distinct values'",
        "FROM orders HAVING count(DISTINCT o_orderstatus) <> 2")
    + " UNION ALL " + _violation_sql("cardinality", "orders", "''", "o_custkey", "count(DISTINCT o_custkey)", "'unexpected number of distinct values'",
        "FROM orders HAVING count(DISTINCT o_custkey) < 1000000000"),
    "q_dq_unique": _violation_sql("unique", "lineitem", "l_orderkey || ' | ' || l_linenumber", "l_orderkey+l_linenumber", "count(*)", "'key is repeated'",
        "FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    "q_dq_complete_grid": """WITH seen AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, bool_or(event_type = 'click') AS c,
          bool_or(event_type = 'view') AS v, bool_or(event_type = 'error') AS e FROM events GROUP BY ALL) """
    + _violation_sql("complete_grid", "events", "user_id || ' | ' || day", "event_type",
        "concat_ws('; ', CASE WHEN NOT c THEN 'click' END, CASE WHEN NOT v THEN 'view' END, CASE WHEN NOT e THEN 'error' END)",
        "'metrics are missing'", "FROM seen WHERE NOT (c AND v AND e)"),
    "q_dq_grid_size": _violation_sql("grid_size", "events", "''", "user_id", "count(*)", "'row count is not entities x 5'",
        "FROM events HAVING count(*) <> count(DISTINCT user_id) * 5"),
    "q_dq_sum": f"""WITH {C.OBSERVATIONS_SQL}, keyed AS (SELECT *, source_name || ' | ' || school_year || ' | ' || term AS row_key FROM wide)
        SELECT 'sum_to_100' AS "check", 'observations' AS "table", row_key, 'urgent+high+rest' AS "column", 'parts do not add up' AS message
          FROM keyed WHERE abs(pct_urgent + pct_high + pct_rest - 100) > 0.05 + 1e-9
        UNION ALL SELECT 'composite', 'observations', row_key, 'urgent_high', 'parts do not add up' FROM keyed
          WHERE abs(pct_urgent + pct_high - pct_urgent_high) > 0.05 + 1e-9""",
    "q_dq_preserved": _violation_sql("preserved", "supplier", "CAST(s_suppkey AS VARCHAR)", "", "''", "'row was lost'", "FROM supplier WHERE s_suppkey % 9 = 4")
    + " UNION ALL " + _violation_sql("preserved", "supplier", "CAST(s_suppkey + 1000000 AS VARCHAR)", "", "''", "'row was added'",
        "FROM supplier WHERE s_suppkey % 9 <> 4 AND s_suppkey % 11 = 5")
    + " UNION ALL " + _violation_sql("preserved", "supplier", "CAST(s_suppkey AS VARCHAR)", "", "'s_name'", "'columns changed'",
        "FROM supplier WHERE s_suppkey % 9 <> 4 AND s_suppkey % 7 = 3"),
    "q_dq_mapping": f"""WITH {NQ._HARMONIZED_SQL}, x AS (SELECT * FROM (VALUES ('NATION_0', 'AFRICA'), ('NATION_1', 'AFRICA'),
          ('Elsewhere 3', 'Elsewhere 3'), ('NATION_99', 'EUROPE')) t(s, e)),
        j AS (SELECT s, e, name FROM x LEFT JOIN (SELECT DISTINCT spelling, name FROM harmonized) ON s = spelling) """
    + _violation_sql("mapping", "harmonized", "s", "name", "name", "'expected ' || e", "FROM j WHERE name IS DISTINCT FROM e"),
    "q_dq_retained": f"""WITH {C.NATIONS_SQL}, {MQ._OUTCOMES} """ + _violation_sql("retained", "outcomes", "CAST(c_custkey AS VARCHAR)", "kept_group", "NULL",
        "CASE WHEN entity IS NULL THEN 'required entity is missing' ELSE 'required entity lost its group' END",
        "FROM customer LEFT JOIN outcomes ON entity = c_custkey WHERE entity IS NULL OR graduates IS NULL OR graduates <= 1"),
    "q_dq_referential": """WITH c AS (SELECT DISTINCT CASE WHEN l_orderkey % 100 = 4 THEN -l_orderkey - 1 ELSE l_orderkey END AS key FROM lineitem),
        p AS (SELECT CASE WHEN o_orderkey % 100 = 3 THEN -o_orderkey - 1 ELSE o_orderkey END AS key FROM orders) """
    + _violation_sql("referential", "lines", "CAST(key AS VARCHAR)", "key", "''", "'no parent row'", "FROM c WHERE key NOT IN (SELECT key FROM p)")
    + " UNION ALL " + _violation_sql("referential", "lines", "CAST(key AS VARCHAR)", "key", "''", "'no child row'", "FROM p WHERE key NOT IN (SELECT key FROM c)"),
    "q_dq_recomputed": "WITH " + ", ".join(MQ._REGION) + " " + _violation_sql("recomputed", "moved", "g", "value_pct", "''", "'latest value'",
        "FROM latest WHERE g < 'B' AND latest_value IS NOT NULL"),
    "q_dq_items": """SELECT 'items' AS "check", 'audit' AS "table", 'foreign_sources' AS row_key, 'value' AS "column", CAST(count(DISTINCT source) AS VARCHAR) AS observed,
        'item has another value' AS message FROM documents WHERE lang <> 'en' HAVING count(DISTINCT source) <> 3
        UNION ALL SELECT 'items', 'audit', 'rows', 'value', '', 'item is missing'
        UNION ALL SELECT 'items', 'audit', 'languages', 'value', CAST(count(DISTINCT lang) AS VARCHAR), 'item has another value' FROM documents HAVING count(DISTINCT lang) <> 4""",
}
ORACLES["q_dq_report"] = f"""WITH v AS ({ORACLES['q_dq_unique']} UNION ALL {ORACLES['q_dq_domain']}),
  n AS (SELECT *, row_number() OVER (ORDER BY "check", "table", row_key, "column", observed, message) AS line FROM v)
  SELECT CAST(0 AS BIGINT) AS line, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result, count(*) || ' violation(s)' AS message FROM v
  UNION ALL SELECT line, 'violation', concat_ws(' ', "table" || ':', "check", "column", row_key, '(' || observed || ')', message) FROM n WHERE line <= 30"""
