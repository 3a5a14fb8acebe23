"""Shared inputs of the registered queries: Spark frames and their SQL twins.

Stand-ins: a nation is a source group, its region the harmonised group; customers,
suppliers and parts are entities; order years and half-years are periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyweave.functions.numbers import school_year, stable_round
from tallyweave.operators.measures import typed_entity_rows, unpivot_measures
from tallyweave.session import shared

METRICS = ["pct_urgent", "pct_high", "pct_rest", "pct_urgent_high"]
MEASURES = ["gross", "net", "returned"]


SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table under its fixed schema, so no job is spent on reading footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def sql_round(expression: str, digits: int = 2) -> str:
    """Half up by floor, with room for the noise of doubles; no decimals, unlike the operator."""
    value, scale = f"CAST({expression} AS DOUBLE)", f"1{'0' * digits}.0::DOUBLE"
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5::DOUBLE + 1e-7::DOUBLE) / {scale})"


def sql_ratio(a: str, b: str, digits: int = 2) -> str:
    return sql_round(f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))", digits)


def nations(spark: SparkSession, folder: str) -> DataFrame:
    """Nation key, source name and region name."""
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", F.col("n_name").alias("source_name"), F.col("r_name").alias("group_name")
    )


NATIONS_SQL = """nations AS (
  SELECT n_nationkey, n_name AS source_name, r_name AS group_name
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def observation_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per nation, school year and term.

    Orders are counted per customer and term before customers are joined, so a customer
    with very many orders brings a handful of rows to the join.
    """
    priority = F.col("o_orderpriority")
    per_customer = (
        table(spark, folder, "orders")
        .groupBy(
            "o_custkey",
            F.year("o_orderdate").alias("year"),
            F.when(F.month("o_orderdate") <= 6, "H1").otherwise("H2").alias("term"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(priority == "1-URGENT").alias("urgent"),
            F.count_if(priority == "2-HIGH").alias("high"),
        )
    )
    customer = table(spark, folder, "customer")
    placed = per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
    counts = placed.groupBy("c_nationkey", "year", "term").agg(
        F.sum("n").alias("n"), F.sum("urgent").alias("urgent"), F.sum("high").alias("high")
    )
    return counts


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Long observations; a cell much smaller than the mean cell is suppressed."""
    cells = shared(observation_cells(spark, folder), "c_nationkey")
    least = cells.agg((F.avg("n") * 0.8).alias("least")).select("least").scalar()

    def percent(count: Column) -> Column:
        return F.when(F.col("n") >= least, stable_round(count * 100.0 / F.col("n"), 1))

    wide = cells.join(nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "source_name",
        "group_name",
        school_year("year").alias("school_year"),
        "term",
        percent(F.col("urgent")).alias("pct_urgent"),
        percent(F.col("high")).alias("pct_high"),
        percent(F.col("n") - F.col("urgent") - F.col("high")).alias("pct_rest"),
        percent(F.col("urgent") + F.col("high")).alias("pct_urgent_high"),
    )
    return unpivot_measures(
        wide, ["source_name", "group_name", "school_year", "term"], METRICS, "metric", "value_pct"
    )


def reading_slice(spark: SparkSession, folder: str) -> DataFrame:
    return observations(spark, folder).filter("term = 'H2' AND metric = 'pct_urgent_high'")


def _percent_sql(count: str) -> str:
    return f"CASE WHEN n >= least THEN {sql_round(f'({count}) * 100.0::DOUBLE / n', 1)} END"


OBSERVATIONS_SQL = f"""{NATIONS_SQL},
cells AS (
  SELECT c_nationkey, year(o_orderdate) AS y, CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS term,
    count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
    count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
wide AS (
  SELECT source_name, group_name, y || '-' || (y + 1) AS school_year, term,
    {_percent_sql('urgent')} AS pct_urgent, {_percent_sql('high')} AS pct_high,
    {_percent_sql('n - urgent - high')} AS pct_rest, {_percent_sql('urgent + high')} AS pct_urgent_high
  FROM cells JOIN nations ON c_nationkey = n_nationkey, (SELECT avg(n) * 0.8 AS least FROM cells)),
obs AS (
  {' UNION ALL '.join(f"SELECT source_name, group_name, school_year, term, '{m}' AS metric, {m} AS value_pct FROM wide" for m in METRICS)}),
slice AS (SELECT * FROM obs WHERE term = 'H2' AND metric = 'pct_urgent_high')"""


def entity_text_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Money per year and supplier as a spreadsheet prints it: text with decimal commas."""
    lineitem = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")

    def text(c: Column) -> Column:
        return F.replace(c.cast("string"), F.lit("."), F.lit(","))

    sums = lineitem.groupBy(F.year("l_shipdate").alias("year"), "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(price).alias("gross"),
        F.sum(price * (F.lit(1).cast("decimal(4,2)") - discount)).alias("net"),
        F.sum(F.when(F.col("l_returnflag") == "R", price)).alias("returned"),
    )
    return sums.select(
        F.col("year").cast("string").alias("year"),
        "l_suppkey",
        F.concat(F.col("quantity").cast("string"), F.lit(",0")).alias("quantity"),
        text(F.col("gross")).alias("Gross amount"),
        text(F.col("net")).alias("Net amount"),
        F.coalesce(text(F.col("returned")), F.lit(" ")).alias("Returned"),
    )


def entity_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Typed money per year and supplier with nation, region and carried status."""
    typed = typed_entity_rows(
        entity_text_rows(spark, folder),
        "year",
        "quantity",
        {"gross": "Gross amount", "net": "Net amount", "returned": "Returned"},
        keep=["l_suppkey"],
    )
    supplier = table(spark, folder, "supplier")
    placed = typed.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")
    )
    moved = F.col("n_nationkey") % 5 == 0
    return placed.select(
        "year",
        F.col("l_suppkey").alias("entity"),
        "source_name",
        "group_name",
        F.when(moved, "unchanged").otherwise("harmonized").alias("status"),
        F.when(moved, "").otherwise(F.concat(F.lit("part of "), "group_name")).alias("note"),
        "quantity",
        *MEASURES,
    )


ENTITY_ROWS_SQL = f"""{NATIONS_SQL},
money AS (
  SELECT year(l_shipdate) AS year, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
    CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)) AS BIGINT) AS gross,
    CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)) AS BIGINT) AS net,
    CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'R') AS DOUBLE)) AS BIGINT) AS returned
  FROM lineitem GROUP BY ALL),
entity_rows AS (
  SELECT year, l_suppkey AS entity, source_name, group_name,
    CASE WHEN n_nationkey % 5 = 0 THEN 'unchanged' ELSE 'harmonized' END AS status,
    CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'part of ' || group_name END AS note,
    quantity, gross, net, returned
  FROM money JOIN supplier ON l_suppkey = s_suppkey JOIN nations ON s_nationkey = n_nationkey)"""


def population_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ordering customers per year, nation and market segment, with an ALL member."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    seen = (
        orders.select("o_custkey", F.year("o_orderdate").alias("year")).distinct()
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("year", "c_nationkey", F.explode(F.array(F.lit("ALL"), F.col("c_mktsegment"))).alias("member"))
    )
    counts = seen.groupBy("year", "c_nationkey", "member").agg(F.count(F.lit(1)).alias("people"))
    return counts.join(nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "year", "source_name", "group_name", "n_nationkey", "member", "people"
    )


POPULATION_SQL = """seen AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, c_custkey, c_nationkey, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey),
people AS (
  SELECT year, source_name, group_name, n_nationkey, count(*) AS total,
    count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) AS band
  FROM seen JOIN nations ON c_nationkey = n_nationkey GROUP BY ALL)"""
