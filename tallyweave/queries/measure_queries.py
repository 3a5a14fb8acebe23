"""Queries on observations, money, denominators and the analysis tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweave.functions.notes import first_nonblank, join_notes, presence_flag
from tallyweave.operators import joins, measures as M
from tallyweave.operators.keys import dedup
from tallyweave.queries import common as C
from tallyweave.queries.common import sql_ratio, sql_round
from tallyweave.session import shared


def q_obs_long(spark: SparkSession, folder: str) -> DataFrame:
    obs = C.observations(spark, folder)
    return obs.withColumn("suppressed", F.col("value_pct").isNull())


def q_component_average(spark, folder):
    return M.component_average(
        C.reading_slice(spark, folder), "group_name", "school_year", "source_name", "value_pct"
    )


def _strict_and_latest(spark, folder):
    return M.strict_and_latest(
        C.reading_slice(spark, folder), "group_name", "school_year", "source_name", "value_pct"
    )


def q_strict_latest(spark, folder):
    out = _strict_and_latest(spark, folder)
    return out.select("group_name", *[c for c in out.columns if c.startswith("strict_")])


def q_latest_available(spark, folder):
    out = _strict_and_latest(spark, folder)
    return out.select("group_name", *[c for c in out.columns if c.startswith("latest_")])


def q_latest_by_nation(spark, folder):
    """The same with every nation its own group, so values are direct."""
    return M.strict_and_latest(
        C.reading_slice(spark, folder).withColumn("own", F.col("source_name")),
        "own", "school_year", "source_name", "value_pct",
    )


def q_fallback_used(spark, folder):
    return M.fallback_used(_strict_and_latest(spark, folder)).select("group_name", "latest_period")


def q_multi_component(spark, folder):
    return M.multi_component(_strict_and_latest(spark, folder)).select("group_name", "strict_component_count")


def q_typed_entity_rows(spark, folder):
    return M.typed_entity_rows(
        C.entity_text_rows(spark, folder), "year", "quantity",
        {"gross": "Gross amount", "net": "Net amount", "returned": "Returned"}, keep=["l_suppkey"],
    )


def spending(spark, folder) -> DataFrame:
    """Money per year, nation and metric with its amount per unit."""
    rolled = M.rollup_sum(
        C.entity_rows(spark, folder), ["year", "source_name", "group_name"], C.MEASURES, "quantity", ("status", "note")
    )
    ids = ["year", "source_name", "group_name", "status", "note", "quantity"]
    long = M.unpivot_measures(rolled, ids, C.MEASURES)
    return long.withColumn("per_unit", M.safe_ratio("amount", "quantity"))


def q_spend_rollup(spark, folder):
    return spending(spark, folder)


def q_status_rollup(spark, folder):
    """Status and notes at region level, where sources disagree."""
    rolled = M.rollup_sum(
        C.entity_rows(spark, folder), ["group_name"], ["gross"], "quantity", ("status", "note")
    )
    return rolled


def population(spark, folder) -> DataFrame:
    totals = M.conditional_totals(
        C.population_cells(spark, folder), ["year", "source_name", "group_name", "n_nationkey"],
        "member", "people", "ALL", ["BUILDING", "MACHINERY"], "people",
    )
    return totals


def q_cond_totals(spark, folder):
    return population(spark, folder)


def denominated(spark, folder, people: DataFrame | None = None) -> DataFrame:
    """One denominator row per year and region: the last nation's, as a keyed lookup gives."""
    return M.attach_denominators(
        spending(spark, folder), ["year", "group_name"], "amount", people or population(spark, folder), "n_nationkey",
        own={"quantity": "per_source_unit"}, looked_up={"total": "per_person", "band": "per_band_person"},
    )


def q_denominators(spark, folder):
    return denominated(spark, folder)


def q_denominators_summed(spark, folder):
    """The same with denominators of all nations of a region added up."""
    return M.attach_denominators(
        spending(spark, folder), ["year", "group_name"], "amount", population(spark, folder), "n_nationkey",
        looked_up={"total": "per_person"}, on_duplicate="sum",
    ).select("year", "source_name", "metric", "amount", "total", "per_person")


def q_missing_denominators(spark, folder):
    """Money of years without any order has no denominator."""
    people = population(spark, folder).withColumn("source_name", F.when(F.col("year") <= 1999, F.col("source_name")))
    return M.missing_denominators(spending(spark, folder), ["year", "source_name"], people, "source_name")


def q_pivot_metrics(spark, folder):
    return M.pivot_metrics(
        spending(spark, folder), ["year", "source_name"], "metric", ["gross", "net"], ["amount", "per_unit"]
    )


def q_align_metrics(spark, folder):
    return M.align_metrics(
        C.observations(spark, folder), ["source_name", "school_year", "term"], "metric", "value_pct",
        {m: m.removeprefix("pct_") for m in C.METRICS},
    )


def _but(name: str):
    """The source name, blank for one nation, so that the spine has a gap there."""
    return F.when(F.col("source_name") != name, F.col("source_name"))


def spine(spark, folder) -> DataFrame:
    """One row per nation: reading values, 1998 money of two metrics, denominators, flags."""
    obs = C.reading_slice(spark, folder)
    reading = M.strict_and_latest(
        obs.withColumn("own", _but("NATION_3")), "own", "school_year", "source_name", "value_pct"
    ).withColumnRenamed("own", "name")
    population_rows = shared(population(spark, folder), "n_nationkey")
    money = denominated(spark, folder, population_rows).filter("year = 1998").withColumn("source_name", _but("NATION_7"))
    wide = M.pivot_metrics(
        money, ["source_name"], "metric", ["net", "gross"], ["amount", "per_person", "total"]
    ).withColumnRenamed("source_name", "name")
    people = dedup(
        population_rows.filter("year = 1998").select(
            F.col("source_name").alias("name"), "total", "band", "n_nationkey"
        ),
        ["name"], "n_nationkey",
    )
    reading_columns = [
        "strict_period", "strict_value", "latest_period", "latest_value", "strict_component_count", "strict_method"
    ]
    joined = joins.spine_join(
        "name",
        [
            (reading, {c: c for c in reading_columns}),
            (wide, {"net_amount": "net_amount", "net_per_person": "net_per_person",
                    "gross_amount": "gross_amount", "net_total": "money_total"}),
        ],
        [(people, {"total": "people_total", "band": "people_band"})],
    )
    return joined.select(
        "name", "strict_period", "strict_value", "latest_period", "latest_value", "strict_component_count",
        "strict_method", "net_amount", "net_per_person", "gross_amount",
        F.coalesce("money_total", "people_total").alias("population_total"),
        "people_band",
        presence_flag("strict_value").alias("has_strict"),
        presence_flag("latest_value").alias("has_latest"),
        presence_flag("net_amount").alias("has_net"),
        presence_flag("gross_amount").alias("has_gross"),
        first_nonblank("strict_method", F.lit("none")).alias("method_or_none"),
    )


def q_spine_join(spark, folder):
    return spine(spark, folder)


def entity_outcomes(spark, folder) -> DataFrame:
    """One row per customer that appears in any of three order tables, with group attributes."""
    orders = C.table(spark, folder, "orders")
    name = F.col("o_custkey").alias("entity")
    done = orders.filter("o_orderstatus = 'F'").groupBy(name).agg(F.count(F.lit(1)).alias("graduates"))
    graded = (
        orders.filter("o_orderpriority = '1-URGENT'")
        .groupBy(name)
        .agg(
            M.stable_round(F.avg(F.col("o_totalprice").cast("decimal(18,2)"))).alias("first_grade"),
            M.stable_round(
                F.avg(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast("decimal(18,2)")))
            ).alias("second_grade"),
        )
    )
    paired = (
        orders.filter("o_orderpriority = '5-LOW'")
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("paired_rows"), M.sum_or_null(F.when(F.col("o_orderstatus") == "P", 1)).alias("paired_sum"))
    )
    customer = C.table(spark, folder, "customer").join(
        C.nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    lookup = customer.select(
        F.col("c_custkey").alias("entity"), "source_name", "group_name",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "excluded_group_or_aggregate").otherwise("analysis_required").alias("priority"),
        F.when(F.col("c_acctbal") < 0, F.lit("negative balance")).alias("balance_note"),
    )
    joined = joins.entity_outer_join(
        "entity",
        {"done": (done, ["graduates"]), "graded": (graded, ["first_grade", "second_grade"]),
         "paired": (paired, ["paired_rows", "paired_sum"])},
        lookup, ["source_name", "group_name", "priority", "balance_note"],
    )
    return joined.select(
        "entity", "source_name", "group_name", "priority", "graduates", "first_grade", "second_grade",
        F.coalesce("paired_rows", F.lit(0)).alias("paired_rows"), "paired_sum",
        "has_done", "has_graded", "has_paired",
        (F.col("priority") == "excluded_group_or_aggregate").alias("is_excluded"),
        join_notes("balance_note", F.when(~F.col("has_done"), F.lit("no finished order"))).alias("notes"),
    )


def q_entity_outer(spark, folder):
    return entity_outcomes(spark, folder)


def summary(spark, folder, entities: DataFrame | None = None) -> DataFrame:
    rows = M.analysis_rows(entities or entity_outcomes(spark, folder), "priority", "is_excluded", "source_name")
    return joins.group_summary(
        rows, "source_name", "entity", "graduates", ["first_grade", "second_grade"],
        ["has_done", "has_graded", "has_paired"],
    )


def q_group_summary(spark, folder):
    return summary(spark, folder)


def q_weak_coverage(spark, folder):
    return M.weak_coverage(summary(spark, folder), "coverage_share", 0.9).select("source_name", "coverage_share")


def q_weighted_average(spark, folder):
    """Weighted and plain mean price per brand, returned lines without a weight."""
    lines = C.table(spark, folder, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    weight = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("decimal(10,2)"))
    return lines.groupBy("l_linestatus", "l_returnflag").agg(
        M.stable_round(M.weighted_average(price, weight)).alias("weighted"),
        M.stable_round(M.simple_average(price)).alias("simple"),
        M.stable_round(M.weighted_or_simple(price, weight)).alias("preferred"),
        M.weighting_method(M.weighted_average(price, weight)).alias("method"),
        M.sum_or_null(F.when(F.col("l_returnflag") == "R", 1)).alias("returned_lines"),
    )


def q_ratio_ties(spark, folder):
    """Ratios at a rounding tie and a hair beside it, one of each for every line."""
    lines = C.table(spark, folder, "lineitem")
    nudge = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("nudge")
    rows = lines.select("l_orderkey", "l_linenumber", nudge)
    amount = F.col("l_orderkey") * 40_000 + 20_000 + F.col("nudge")
    return rows.select("l_orderkey", "l_linenumber", "nudge", M.safe_ratio(amount, F.lit(4_000_000)).alias("ratio"))


def q_by_period(spark, folder):
    orders = C.table(spark, folder, "orders")
    return M.by_period_profile(orders.select(F.year("o_orderdate").alias("year"), "o_custkey"), "year", "o_custkey")


def q_period_audit(spark, folder):
    """People per year and segment with the source's own ALL and MACHINERY cells."""
    cells = C.population_cells(spark, folder)
    rows = cells.filter("member <> 'ALL'")
    own = F.col("source_name") == "NATION_0"
    return M.period_audit(
        rows, "year", "source_name", "member", cells, "people",
        {"people_of_first": own & (F.col("member") == "ALL"), "builders_of_first": own & (F.col("member") == "BUILDING")},
    )


def q_self_total(spark, folder):
    """Derived counts per year and nation beside the ALL cell of the source itself."""
    cells = C.population_cells(spark, folder)
    derived = cells.filter("member <> 'ALL'").groupBy("year", "source_name").agg(
        F.count_distinct("member").alias("segments"), F.sum("people").alias("people")
    )
    return M.self_lookup_total(
        derived, cells, ["year", "source_name"], F.col("member") == "ALL", "people", "source_total"
    )


def _sql(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


_AVERAGED = f"""
per AS (SELECT g, school_year AS p, count(DISTINCT source_name) AS components, count(value_pct) AS n, avg(value_pct) AS mean,
    count(DISTINCT source_name) FILTER (WHERE value_pct IS NOT NULL) AS valued,
    min(source_name) FILTER (WHERE value_pct IS NOT NULL) AS only_name FROM base GROUP BY ALL),
every AS (SELECT g, min(source_name) AS names, count(DISTINCT source_name) AS k FROM base GROUP BY g)"""


def _averaged(prefix: str, period: str, empty_note: str | None = None) -> str:
    """Output columns of one selected period; joined ``per`` row may be missing."""
    n = "coalesce(n, 0)"
    note = f"""CASE WHEN k <= 1 AND {n} > 0 THEN 'value of ' || names
      WHEN k <= 1 THEN names || ' has no value for ' || coalesce({period}, 'any period')
      WHEN {n} = 1 THEN 'only ' || only_name || ' has a value of ' || k || ' components'
      WHEN {n} > 1 THEN 'unweighted average of ' || valued || ' of ' || k || ' components'
      ELSE 'no value of ' || k || ' components' END"""
    if empty_note:
        note = f"CASE WHEN p IS NULL THEN '{empty_note}' ELSE {note} END"
    return f"""{sql_round('mean')} AS {prefix}value, coalesce(components, k) AS {prefix}component_count,
    {n} AS {prefix}nonmissing_component_count,
    CASE WHEN k <= 1 THEN 'direct_source_municipality_value' WHEN {n} = 1 THEN 'single_available_component'
      WHEN {n} > 1 THEN 'unweighted_source_component_average' ELSE 'no_nonmissing_component' END AS {prefix}method,
    {note} AS {prefix}note"""


def _base(group: str) -> str:
    return f"base AS (SELECT {group} AS g, school_year, source_name, value_pct FROM slice)"


_NEWEST = "newest AS (SELECT max(school_year) AS newest FROM base)"
_STRICT = f"""strict AS (SELECT every.g, newest AS strict_period, {_averaged('strict_', 'newest')}
  FROM every CROSS JOIN newest LEFT JOIN per ON per.g = every.g AND p = newest)"""
_LATEST = f"""latest AS (SELECT every.g, p AS latest_period, {_averaged('latest_', 'p', 'no value found in any period')}
  FROM every LEFT JOIN (SELECT * FROM per WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY g ORDER BY p DESC) = 1) AS per
    ON per.g = every.g)"""

_SPENDING = f"""rolled AS (SELECT year, source_name, group_name,
    CASE WHEN bool_or(status = 'harmonized') THEN 'harmonized' ELSE min(status) END AS status,
    coalesce(string_agg(DISTINCT note, ' | ' ORDER BY note) FILTER (WHERE note <> ''), '') AS note,
    CAST(sum(quantity) AS BIGINT) AS quantity, CAST(coalesce(sum(gross), 0) AS BIGINT) AS gross,
    CAST(coalesce(sum(net), 0) AS BIGINT) AS net, CAST(coalesce(sum(returned), 0) AS BIGINT) AS returned
  FROM entity_rows GROUP BY year, source_name, group_name),
spending AS (SELECT *, {sql_ratio('amount', 'quantity')} AS per_unit FROM (
  {' UNION ALL '.join(f"SELECT year, source_name, group_name, status, note, quantity, '{m}' AS metric, {m} AS amount FROM rolled" for m in C.MEASURES)}))"""

_DENOMINATED = f"""denominators AS (SELECT * FROM people
    QUALIFY row_number() OVER (PARTITION BY year, group_name ORDER BY n_nationkey DESC) = 1),
denominated AS (SELECT s.*, d.total, d.band, {sql_ratio('amount', 'quantity')} AS per_source_unit,
    {sql_ratio('amount', 'd.total')} AS per_person, {sql_ratio('amount', 'd.band')} AS per_band_person
  FROM spending s LEFT JOIN denominators d USING (year, group_name))"""

_OUTCOMES = f"""done AS (SELECT o_custkey AS entity, count(*) AS graduates FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
graded AS (SELECT o_custkey AS entity, {sql_round('(sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE / count(*))')} AS first_grade,
    {sql_round("(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O')::DOUBLE / NULLIF(count(*) FILTER (WHERE o_orderstatus = 'O'), 0))")} AS second_grade
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
paired AS (SELECT o_custkey AS entity, count(*) AS paired_rows,
    CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS BIGINT) AS paired_sum
  FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
outcomes AS (
  SELECT k.entity, source_name, group_name, priority, graduates, first_grade, second_grade,
    coalesce(paired_rows, 0) AS paired_rows, paired_sum, done.entity IS NOT NULL AS has_done,
    graded.entity IS NOT NULL AS has_graded, paired.entity IS NOT NULL AS has_paired,
    priority = 'excluded_group_or_aggregate' AS is_excluded,
    concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'negative balance' END,
      CASE WHEN done.entity IS NULL THEN 'no finished order' END) AS notes
  FROM (SELECT entity FROM done UNION SELECT entity FROM graded UNION SELECT entity FROM paired) k
  LEFT JOIN done USING (entity) LEFT JOIN graded USING (entity) LEFT JOIN paired USING (entity)
  LEFT JOIN (SELECT c_custkey, c_acctbal, source_name, group_name,
      CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'excluded_group_or_aggregate' ELSE 'analysis_required' END AS priority
    FROM customer JOIN nations ON c_nationkey = n_nationkey) ON c_custkey = k.entity)"""


def _weighted(v: str) -> str:
    usable = f"FILTER (WHERE {v} IS NOT NULL AND graduates > 0)"
    return f"(sum({v} * graduates) {usable} / sum(graduates) {usable})"


_COVERED = "(first_grade IS NOT NULL OR second_grade IS NOT NULL)"
_SUMMARY = f"""summary AS (SELECT source_name, CAST(sum(coalesce(graduates, 0)) AS BIGINT) AS total_weight,
    CAST(sum(CASE WHEN {_COVERED} THEN coalesce(graduates, 0) ELSE 0 END) AS BIGINT) AS covered_weight,
    {sql_ratio(f"sum(CASE WHEN {_COVERED} THEN coalesce(graduates, 0) ELSE 0 END)", "sum(coalesce(graduates, 0))", 4)} AS coverage_share,
    count(DISTINCT entity) AS entities, count(graduates) AS entities_with_weight,
    count(*) FILTER (WHERE {_COVERED}) AS entities_with_value,
    {', '.join(f"{sql_round(f'coalesce({_weighted(v)}, avg({v}))')} AS average_{v}, {sql_round(_weighted(v))} AS weighted_{v}, {sql_round(f'avg({v})')} AS unweighted_{v}" for v in ('first_grade', 'second_grade'))},
    CASE WHEN {_weighted('first_grade')} IS NOT NULL OR {_weighted('second_grade')} IS NOT NULL
      THEN 'graduate_count_weighted_where_available' ELSE 'unweighted_school_average' END AS weighting_method,
    bool_or(has_done) AS any_has_done, bool_or(has_graded) AS any_has_graded, bool_or(has_paired) AS any_has_paired
  FROM outcomes WHERE priority = 'analysis_required' AND NOT is_excluded AND source_name <> '' GROUP BY source_name)"""

_SPINE = f"""sp_obs AS (SELECT source_name AS g, school_year AS p, value_pct AS v FROM slice WHERE source_name <> 'NATION_3'),
sp_newest AS (SELECT max(p) AS newest FROM sp_obs),
sp_reading AS (SELECT g, newest AS strict_period, any_value(v) FILTER (WHERE p = newest) AS strict_value,
    max(p) FILTER (WHERE v IS NOT NULL) AS latest_period, arg_max(v, p) FILTER (WHERE v IS NOT NULL) AS latest_value
  FROM sp_obs, sp_newest GROUP BY g, newest),
sp_money AS (SELECT source_name AS g, max(amount) FILTER (WHERE metric = 'net') AS net_amount,
    max(per_person) FILTER (WHERE metric = 'net') AS net_per_person, max(amount) FILTER (WHERE metric = 'gross') AS gross_amount,
    max(total) FILTER (WHERE metric = 'net') AS net_total
  FROM denominated WHERE year = 1998 AND source_name <> 'NATION_7' GROUP BY 1),
spine AS (SELECT k.g AS name, strict_period, strict_value, latest_period, latest_value,
    CASE WHEN r.g IS NOT NULL THEN CAST(1 AS BIGINT) END AS strict_component_count,
    CASE WHEN r.g IS NOT NULL THEN 'direct_source_municipality_value' END AS strict_method,
    net_amount, net_per_person, gross_amount, coalesce(net_total, total) AS population_total, band AS people_band,
    strict_value IS NOT NULL AS has_strict, latest_value IS NOT NULL AS has_latest, net_amount IS NOT NULL AS has_net,
    gross_amount IS NOT NULL AS has_gross,
    CASE WHEN r.g IS NOT NULL THEN 'direct_source_municipality_value' ELSE 'none' END AS method_or_none
  FROM (SELECT g FROM sp_reading UNION SELECT g FROM sp_money) k
  LEFT JOIN sp_reading r USING (g) LEFT JOIN sp_money USING (g)
  LEFT JOIN (SELECT * FROM people WHERE year = 1998) p ON p.source_name = k.g)"""

_MONEY = (C.ENTITY_ROWS_SQL, _SPENDING)
_ALL_MONEY = (C.ENTITY_ROWS_SQL, _SPENDING, C.POPULATION_SQL, _DENOMINATED)
_REGION = (C.OBSERVATIONS_SQL, _base("group_name"), _AVERAGED, _NEWEST, _STRICT, _LATEST)
_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_USABLE = "FILTER (WHERE l_returnflag <> 'R' AND l_quantity > 0)"
_W = f"(sum({_PRICE} * CAST(l_quantity AS DECIMAL(10,2))) {_USABLE}::DOUBLE / sum(CAST(l_quantity AS DECIMAL(10,2))) {_USABLE}::DOUBLE)"
_S = f"(sum({_PRICE})::DOUBLE / count(*))"
SPINE_CTES = (C.OBSERVATIONS_SQL, C.ENTITY_ROWS_SQL.replace(C.NATIONS_SQL + ",", ""), _SPENDING, C.POPULATION_SQL, _DENOMINATED, _SPINE)
OUTCOME_CTES = (C.NATIONS_SQL, _OUTCOMES)
SUMMARY_CTES = (*OUTCOME_CTES, _SUMMARY)

QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

ORACLES = {
    "q_period_audit": f"""WITH {C.NATIONS_SQL}, members AS (
        SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, c_custkey, source_name, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey),
      cells AS (SELECT year, source_name, 'ALL' AS member, count(*) AS people FROM members GROUP BY ALL
        UNION ALL SELECT year, source_name, c_mktsegment, count(*) FROM members GROUP BY ALL),
      years AS (SELECT year, count(DISTINCT source_name) FILTER (WHERE member <> 'ALL') AS n,
        max(people) FILTER (WHERE source_name = 'NATION_0' AND member = 'ALL') AS a,
        max(people) FILTER (WHERE source_name = 'NATION_0' AND member = 'BUILDING') AS b FROM cells GROUP BY year)
      SELECT 'by_period' AS section, CAST(year AS VARCHAR) AS period, '' AS category, 'entities_with_rows' AS item, CAST(n AS VARCHAR) AS value FROM years
      UNION ALL SELECT 'by_period', CAST(year AS VARCHAR), '', 'people_of_first', CAST(a AS VARCHAR) FROM years
      UNION ALL SELECT 'by_period', CAST(year AS VARCHAR), '', 'builders_of_first', CAST(b AS VARCHAR) FROM years
      UNION ALL SELECT 'by_category', '', member, 'rows', CAST(count(*) AS VARCHAR) FROM cells WHERE member <> 'ALL' GROUP BY member""",
    "q_ratio_ties": """SELECT l_orderkey, l_linenumber, nudge,
        ((l_orderkey * 40000 + 20000 + nudge) * 200 + 4000000) // 8000000 / 100.0::DOUBLE AS ratio
        FROM lineitem, (SELECT CAST(unnest([-1, 0, 1]) AS INTEGER) AS nudge)""",
    "q_obs_long": _sql(C.OBSERVATIONS_SQL, select="SELECT *, value_pct IS NULL AS suppressed FROM obs"),
    "q_component_average": _sql(
        C.OBSERVATIONS_SQL, _base("group_name"), _AVERAGED,
        select=f"SELECT per.g AS group_name, p AS school_year, {_averaged('', 'p')} FROM per JOIN every USING (g)",
    ),
    "q_strict_latest": _sql(*_REGION, select="SELECT g AS group_name, * EXCLUDE (g) FROM strict"),
    "q_latest_available": _sql(*_REGION, select="SELECT g AS group_name, * EXCLUDE (g) FROM latest"),
    "q_latest_by_nation": _sql(
        C.OBSERVATIONS_SQL, _base("source_name"), _AVERAGED, _NEWEST, _STRICT, _LATEST,
        select="SELECT g AS own, * EXCLUDE (g) FROM strict JOIN latest USING (g)",
    ),
    "q_fallback_used": _sql(
        *_REGION,
        select="SELECT g AS group_name, latest_period FROM strict JOIN latest USING (g) WHERE strict_value IS NULL AND latest_value IS NOT NULL",
    ),
    "q_multi_component": _sql(
        *_REGION, select="SELECT g AS group_name, strict_component_count FROM strict WHERE strict_component_count > 1"
    ),
    "q_typed_entity_rows": _sql(
        C.ENTITY_ROWS_SQL, select="SELECT year, l_suppkey, quantity, gross, net, returned FROM money"
    ),
    "q_spend_rollup": _sql(*_MONEY, select="SELECT * FROM spending"),
    "q_status_rollup": _sql(
        C.ENTITY_ROWS_SQL,
        select="""SELECT group_name, CAST(sum(gross) AS BIGINT) AS gross, CAST(sum(quantity) AS BIGINT) AS quantity,
          CASE WHEN bool_or(status = 'harmonized') THEN 'harmonized' ELSE min(status) END AS status,
          coalesce(string_agg(DISTINCT note, ' | ' ORDER BY note) FILTER (WHERE note <> ''), '') AS note
          FROM entity_rows GROUP BY group_name""",
    ),
    "q_cond_totals": _sql(
        C.NATIONS_SQL, C.POPULATION_SQL, select="SELECT year, source_name, group_name, n_nationkey, total, band FROM people"
    ),
    "q_denominators": _sql(*_ALL_MONEY, select="SELECT * FROM denominated"),
    "q_denominators_summed": _sql(
        *_ALL_MONEY,
        select=f"""SELECT year, source_name, metric, amount, d.total, {sql_ratio('amount', 'd.total')} AS per_person
          FROM spending LEFT JOIN (SELECT year, group_name, CAST(sum(total) AS BIGINT) AS total FROM people GROUP BY ALL) d
          USING (year, group_name)""",
    ),
    "q_missing_denominators": _sql(
        *_ALL_MONEY,
        select="""SELECT DISTINCT source_name FROM spending s WHERE NOT EXISTS
          (SELECT 1 FROM people p WHERE p.year <= 1999 AND p.year = s.year AND p.source_name = s.source_name)""",
    ),
    "q_pivot_metrics": _sql(
        *_MONEY,
        select=f"""SELECT year, source_name, {', '.join(f"max({v}) FILTER (WHERE metric = '{m}') AS {m}_{v}" for m in ('gross', 'net') for v in ('amount', 'per_unit'))}
          FROM spending WHERE metric IN ('gross', 'net') GROUP BY year, source_name""",
    ),
    "q_align_metrics": _sql(
        C.OBSERVATIONS_SQL,
        select="""SELECT source_name, school_year, term, pct_urgent AS urgent, pct_high AS high, pct_rest AS rest,
          pct_urgent_high AS urgent_high FROM wide""",
    ),
    "q_spine_join": _sql(*SPINE_CTES, select="SELECT * FROM spine"),
    "q_entity_outer": _sql(*OUTCOME_CTES, select="SELECT * FROM outcomes"),
    "q_group_summary": _sql(*SUMMARY_CTES, select="SELECT * FROM summary"),
    "q_weak_coverage": _sql(
        *SUMMARY_CTES, select="SELECT source_name, coverage_share FROM summary WHERE coalesce(coverage_share, 0) < 0.9"
    ),
    "q_weighted_average": f"""SELECT l_linestatus, l_returnflag, {sql_round(_W)} AS weighted, {sql_round(_S)} AS simple,
        {sql_round(f'coalesce({_W}, {_S})')} AS preferred,
        CASE WHEN {_W} IS NOT NULL THEN 'graduate_count_weighted_where_available' ELSE 'unweighted_school_average' END AS method,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 END) AS BIGINT) AS returned_lines
        FROM lineitem GROUP BY l_linestatus, l_returnflag""",
    "q_by_period": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS entities, count(*) AS n_rows
        FROM orders GROUP BY 1""",
    "q_self_total": _sql(
        C.NATIONS_SQL, "seen AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, c_custkey, c_nationkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)",
        select="""SELECT year, source_name, count(DISTINCT c_mktsegment) AS segments, count(*) AS people, count(*) AS source_total
          FROM seen JOIN nations ON c_nationkey = n_nationkey GROUP BY ALL""",
    ),
}
