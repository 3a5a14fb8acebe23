"""Queries on cubes, pages, page layouts and text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyweave.functions import notes as T, numbers as P
from tallyweave.operators.coverage import extraction_audit
from tallyweave.operators.scan import carry_down, record_segments
from tallyweave.sources import cube as U, html as W, layout as L, lines as S, tables as B
from tallyweave.queries import common as C
from tallyweave.queries.common import sql_round

_DIMENSIONS = ["area", "age", "year"]


def cubes(spark, folder) -> DataFrame:
    """Each embedding as a 4 x 4 x 4 cube in JSON, its members indexed out of label order.

    Every value whose place divides by 11 is a null cell.
    """
    embeddings = C.table(spark, folder, "embeddings")

    def category(name: str) -> Column:
        codes = [F.lit(f"{name}{i}") for i in range(4)]
        index = F.map_from_arrays(F.array(*codes), F.array(*[F.lit(i) for i in (2, 0, 3, 1)]))
        label = F.map_from_arrays(F.array(*codes), F.array(*[F.lit(f"{name} no. {i}") for i in range(4)]))
        return F.struct(F.struct(index.alias("index"), label.alias("label")).alias("category"))

    values = F.transform(
        "embedding", lambda v, i: F.when(i % 11 != 0, F.round(v.cast("double") * 1000))
    )
    document = F.to_json(
        F.struct(
            F.array(*[F.lit(d) for d in _DIMENSIONS]).alias("id"),
            F.array(*[F.lit(4).cast("bigint")] * 3).alias("size"),
            F.map_from_arrays(
                F.array(*[F.lit(d) for d in _DIMENSIONS]), F.array(*[category(d) for d in _DIMENSIONS])
            ).alias("dimension"),
            values.alias("value"),
        ),
        {"ignoreNullFields": "false"},
    )
    return embeddings.select("vec_id", document.alias("cube"))


def q_flatten_cube(spark, folder):
    return U.flatten_cube(cubes(spark, folder), "cube", "vec_id", _DIMENSIONS)


def q_cube_grain(spark, folder):
    cells = U.flatten_cube(cubes(spark, folder), "cube", "vec_id", _DIMENSIONS)
    kept = U.cube_cells_to_grain(
        cells, drop={"area": "area no. 0"}, keep={"age": ["age no. 1", "age no. 2"]}, count="people"
    )
    return kept.select(
        "vec_id", "area", "age", P.school_year(P.ordinal_from_label(F.regexp_replace("year_code", "year", "202"))).alias("school_year"), "people"
    )


def q_html_lines(spark, folder):
    return W.html_to_lines(C.table(spark, folder, "pages"), "page_id", "html")


def q_links(spark, folder):
    return W.extract_links(C.table(spark, folder, "pages"), "page_id", "html", "url")


def q_first_link(spark, folder):
    return W.first_link(C.table(spark, folder, "pages"), "page_id", "html", "url", suffix="e", contains=["h"])


def q_embedded_urls(spark, folder):
    """Pages that carry a JSON tree built from the page and its neighbours, links at three depths."""
    pages = C.table(spark, folder, "pages")
    quoted = pages.select("page_id", "url", F.md5("html").alias("digest"))
    tree = F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.struct(
                        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
                        F.col("url"),
                        F.struct(
                            F.struct(F.concat(F.col("digest"), F.lit(".xlsx")).alias("url")).alias("a"),
                            F.struct(
                                F.lit("Inner & more").alias("title"),
                                F.array(F.struct(F.concat(F.lit("https://app.powerbi.com/"), "digest").alias("url"))).alias("embed"),
                            ).alias("b"),
                        ).alias("slices"),
                    ).alias("page")
                ).alias("pageProps")
            ).alias("props")
        )
    )
    html = F.concat(F.lit('<p>x</p><script id="__NEXT_DATA__" type="application/json">'), tree, F.lit("</script>"))
    return W.harvest_embedded_urls(quoted.select("page_id", html.alias("html")), "page_id", "html")


def _words(spark, folder) -> DataFrame:
    """Every word of every document at a place on paper: its number across, its line down."""
    # Whole texts are dealt, as they are far smaller than their placed words; lines then meet where they are.
    documents = C.table(spark, folder, "documents").select("doc_id", "text").repartition("doc_id")
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "line_text"))
    words = F.filter(F.split("line_text", " "), lambda w: w != "")
    placed = lines.select("doc_id", "line", F.posexplode(words).alias("word", "text"))
    return placed.select(
        "doc_id",
        (F.col("word") * 20.0).alias("x0"),
        (F.col("line") * 12.0 + (F.col("word") % 3) * 0.01).alias("top"),
        F.col("word").cast("bigint").alias("word_no"),
        "text",
    )


def q_words_to_lines(spark, folder):
    return L.words_to_lines(_words(spark, folder), ["doc_id"])


def q_layout_columns(spark, folder):
    bands = [("left", None, 240.0), ("right", 250.0, 450.0)]
    placed = L.split_layout_columns(_words(spark, folder), bands, min_top=12.0)
    return L.words_to_lines(placed, ["doc_id", "side"])


def _part_words(spark, folder, *tail: Column) -> DataFrame:
    """Part rows as printed lines: the words of the name, then the given words to the right."""
    part = C.table(spark, folder, "part")
    line = part.select("p_partkey", F.posexplode(F.concat(F.split("p_name", " "), F.array(*tail))).alias("word", "text"))
    return line.select(
        F.floor(F.col("p_partkey") / 40).alias("page"),
        ((F.col("p_partkey") % 40) * 10.0 + (F.col("word") % 2) * 0.02).alias("top"),
        (F.col("word") * 50.0 + 10).alias("x0"),
        F.col("word").cast("bigint").alias("word_no"),
        "text",
    )


def q_name_count_lines(spark, folder):
    size = F.when(F.col("p_size") % 5 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    words = _part_words(spark, folder, size)
    return L.parse_name_count_line(L.line_words(words, ["page"]), ["page"], headers=["red ring"])


def q_two_decimal_lines(spark, folder):
    first = F.format_string("%.1f", F.col("p_retailprice"))
    second = F.when(F.col("p_size") % 7 != 0, F.format_string("%d.%d", F.col("p_size"), F.col("p_size") % 10)).otherwise("x")
    words = _part_words(spark, folder, first, second)
    return L.parse_name_two_decimals_line(
        L.line_words(words, ["page"]), ["page"], headers=["hot rod"], total_name="old bolt", small_group="new gear"
    )


_ROW = r"^(.+?)\s+([0-9]+(?:\.[0-9]+)?)\s+([0-9]+(?:\.[0-9]+)?)\s+([0-9]+)$"


def _priced_lines(spark, folder) -> DataFrame:
    """Parts as text lines under a heading per brand block, with page furniture between."""
    part = C.table(spark, folder, "part")
    row = F.format_string("%s %.1f %d.5 %d", F.col("p_name"), F.col("p_retailprice"), F.col("p_size"), F.col("p_size"))
    head = F.when(F.col("p_partkey") % 10 == 3, F.concat(F.col("p_brand"), F.lit(" block")))
    number = F.when(F.col("p_partkey") % 25 == 0, F.col("p_size").cast("string"))
    noise = F.when(F.col("p_partkey") % 25 == 1, F.concat(F.lit("Table "), F.col("p_size").cast("string")))
    texts = F.filter(F.array(number, noise, head, row), lambda t: t.isNotNull())
    lines = part.select("p_partkey", F.posexplode(texts).alias("i", "text"))
    return lines.select(
        F.floor(F.col("p_partkey") / 500).alias("page"), ((F.col("p_partkey") % 500) * 4 + F.col("i")).alias("line_no"), "text"
    )


def _priced_rows(spark, folder) -> DataFrame:
    return S.parse_regex_line(
        _priced_lines(spark, folder), ["page"], "line_no", "text", _ROW,
        [("name", "string"), ("first_value", "double"), ("second_value", "double"), ("count", "bigint")],
        "heading", skip_prefixes=["Table "], small_group_labels=["red ring", "Brand#7 block"],
    )


def q_regex_lines(spark, folder):
    return _priced_rows(spark, folder)


def q_manual_review(spark, folder):
    """Rows with an unusual value, for review; the value stays as it is."""
    rows = _priced_rows(spark, folder).filter("issue IS NULL")
    flagged = rows.withColumn("reason", T.value_anomaly_flag(F.col("second_value") == 25.5, "unusual value; preserved"))
    return B.manual_review_rows(flagged, "priced", "reason", ["heading", "name"], "raw_text", "page")


def q_carry_heading(spark, folder):
    """The latest user text above every turn of a conversation."""
    turns = C.table(spark, folder, "conversations").select("conv_id", "turn", "role", F.md5("text").alias("digest"))
    user = F.when(F.col("role") == "user", F.col("digest"))
    return carry_down(turns, ["conv_id"], "turn", user, "asked")


def q_record_segments(spark, folder):
    turns = C.table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return record_segments(turns, ["conv_id"], "turn", F.col("role") == "user", "record_no")


_SECTION_METRICS = ["m1", "m2", "m3"]
_TERMS = {"Spring": "vor", "Autumn": "haust"}


def _section_lines(spark, folder) -> DataFrame:
    """Orders printed as a sectioned document per customer.

    A customer heading, then per order a term line, a year line and three value lines.
    Some orders print their values on the year line, some dashes, some one value too
    few, and some lack the term line after a new heading.
    """
    orders = C.table(spark, folder, "orders")
    year = F.year("o_orderdate") + 10
    k = F.col("o_orderkey") % 10
    percent = F.concat(((F.col("o_custkey") + F.col("o_orderkey")) % 100).cast("string"), F.lit(",5%"))
    dash = F.lit("–")
    year_line = F.concat(year.cast("string"), F.lit("–"), (year + 1).cast("string"))
    heading = F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"), F.when(k == 1, F.lit(" new")).otherwise(F.lit("")))
    inline = k == 2
    texts = F.array(
        heading,
        F.when(k != 3, F.when(F.month("o_orderdate") <= 6, "Spring").otherwise("Autumn")),
        F.when(inline, F.concat_ws(" ", year_line, percent, dash, percent)).otherwise(year_line),
        F.when(~inline, percent),
        F.when(k == 4, "Page").otherwise(F.lit(None)),
        F.when(~inline, F.when(k == 5, dash).otherwise(F.lit("7.5%"))),
        F.when(~inline & (k != 6), F.lit("100%")),
    )
    # A document counts its own orders, so its line numbers are dense.
    number = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("bigint")
    numbered = orders.select("o_custkey", number.alias("n"), texts.alias("texts"))
    lines = numbered.select("o_custkey", "n", F.posexplode("texts").alias("i", "text"))
    return lines.filter("text IS NOT NULL").select(
        F.col("o_custkey").alias("doc"), (F.col("n") * 8 + F.col("i")).alias("line_no"), "text"
    )


def _sections(spark, folder):
    rules = S.SectionRules(metrics=_SECTION_METRICS, periods=_TERMS, skip_lines=["Page"])
    return S.parse_sectioned_lines(_section_lines(spark, folder), "doc", "line_no", rules)


def q_sectioned_lines(spark, folder):
    rows, _ = _sections(spark, folder)
    return rows


def q_sectioned_issues(spark, folder):
    _, issues = _sections(spark, folder)
    return issues


def q_extraction_audit(spark, folder):
    rows, _ = _sections(spark, folder)
    return extraction_audit(rows, "value", ["year", "period", "metric"], "suppressed")


def _sourced(spark, folder) -> DataFrame:
    """All documents with their source's place in line; the entities are languages, and the
    first sources in line name the language of their English texts only."""
    documents = C.table(spark, folder, "documents").withColumn("priority", P.parse_digits(F.substring("source", 4, 9)))
    return documents.withColumn("entity", F.when((F.col("priority") > 2) | (F.col("lang") == "en"), F.col("lang")))


def q_source_choice(spark, folder):
    return B.choose_source(_sourced(spark, folder), "source", "entity", "priority", 4)


def q_rows_of_chosen(spark, folder):
    documents = _sourced(spark, folder)
    choice = B.choose_source(documents, "source", "entity", "priority", 4)
    return B.rows_of_chosen(documents, "source", choice).select("doc_id", "source", "lang")


def q_valid_records(spark, folder):
    part = C.table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string")).otherwise("20x4").alias("year"),
        F.when(F.col("p_size") % 4 == 0, "  ").otherwise(F.col("p_brand")).alias("area"),
    )
    return B.promote_valid_records(part, "year", "area")


def q_scalars(spark, folder):
    """Number, percent and code columns parsed back from text."""
    events = C.table(spark, folder, "events")
    k = F.col("event_id") % 8
    number = F.col("value").cast("decimal(18,2)").cast("string")
    comma = F.replace(number, F.lit("."), F.lit(","))
    messy = (
        F.when(k == 0, F.concat(F.lit(" "), comma, F.lit("  "))).when(k == 1, "nan").when(k == 2, "")
        .when(k == 3, F.concat(number, F.lit("d"))).otherwise(comma)
    )
    percent = F.when(k == 0, "–").when(k == 1, "-").when(k == 2, F.concat(comma, F.lit(" %"))).otherwise(F.concat(comma, F.lit("%")))
    rows = events.select("event_id", "user_id", "event_type", "value", messy.alias("messy"), percent.alias("pct"), F.col("ts"))
    year = F.year("ts")
    noted = T.add_provenance(rows, "https://example.com/events", "as printed")
    return noted.select(
        "event_id",
        P.parse_number("messy", True).alias("number"),
        P.parse_int("messy", True).alias("whole"),
        P.percent_value("pct").alias("percent"),
        P.percent_suppressed("pct").alias("suppressed"),
        P.percent_issue("pct").alias("issue"),
        P.format_number("value", 1).alias("shown"),
        P.safe_ratio("value", F.col("user_id") % 4).alias("ratio"),
        P.school_year(year).alias("school_year"),
        P.school_year_from_label(F.concat(year.cast("string"), F.lit("–"), (year + 1).cast("string"), F.lit(" 7%"))).alias("from_label"),
        P.map_codes("event_type", {"click": "c", "view": "v"}, F.lit("other")).alias("code"),
        P.strip_code_prefix(F.concat(F.lpad(F.col("user_id").cast("string"), 4, "0"), F.lit("  "), "event_type")).alias("stripped"),
        P.ordinal_from_label(F.concat(F.col("user_id").cast("string"), F.lit(". grade"))).alias("ordinal"),
        P.format_flag(F.col("value") > 50).alias("flag"),
        T.value_anomaly_flag(F.col("value") > 200, "unusual value").alias("anomaly"),
        "source_url",
        "source_note",
    )


_ORDERED = {0: "1", 1: "3", 2: "0", 3: "2"}


def _member(name: str, place: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{c}'" for i, c in _ORDERED.items())
    return f"CASE {place} {cases} END"


_CELLS_SQL = f"""cells AS (SELECT vec_id, i, CASE WHEN i % 11 <> 0 THEN round(CAST(v AS DOUBLE) * 1000) END AS value,
    {_member('area', 'i // 16')} AS a, {_member('age', 'i // 4 % 4')} AS g, {_member('year', 'i % 4')} AS y
  FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings))"""

_LINES_SQL = r"""lines AS (SELECT page_id, trim(regexp_replace(unnest(string_split(t, chr(10))), '\s+', ' ', 'g')) AS text,
    generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (
  SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<script.*?>.*?</script>', chr(10), 'g'), '(?is)<style.*?>.*?</style>', chr(10), 'g'), '(?i)<br\s*/?>', chr(10), 'g'),
    '(?i)</(p|div|tr|td|th|li|h[1-6]|section|article|table)>', chr(10), 'g'), '(?s)<[^>]+>', ' ', 'g'),
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&#39;', ''''), '&amp;', '&') AS t FROM pages))"""

_LINKS_SQL = r"""links AS (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS link_no, regexp_extract(url, '^[a-z]+://[^/?#]*') AS site FROM (
  SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages))"""

_WORDS_SQL = """lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
words AS (SELECT doc_id, line, list_filter(string_split(t, ' '), lambda w: w <> '') AS w FROM lines)"""

_PRICED_SQL = """priced AS (SELECT p_partkey // 500 AS page, p_partkey % 500 AS k, p_partkey, p_name, p_brand, p_size, p_retailprice,
    (CASE WHEN p_partkey % 25 IN (0, 1) THEN 1 ELSE 0 END) AS noise, p_partkey % 10 = 3 AS headed FROM part),
rows_of AS (SELECT page, k * 4 + noise + (CASE WHEN headed THEN 1 ELSE 0 END) AS line_no,
    last_value(CASE WHEN headed THEN p_brand || ' block' END IGNORE NULLS) OVER (PARTITION BY page ORDER BY k) AS heading,
    p_name AS name, CAST(printf('%.1f', p_retailprice) AS DOUBLE) AS first_value, p_size + 0.5::DOUBLE AS second_value, CAST(p_size AS BIGINT) AS count,
    p_name || ' ' || printf('%.1f', p_retailprice) || ' ' || p_size || '.5 ' || p_size AS raw_text FROM priced)"""

_SECTION_SQL = """o AS (SELECT *, o_orderkey % 10 AS k, (year(o_orderdate) + 10) || '-' || (year(o_orderdate) + 11) AS y,
    CASE WHEN month(o_orderdate) <= 6 THEN 'vor' ELSE 'haust' END AS term, ((o_custkey + o_orderkey) % 100) + 0.5::DOUBLE AS p,
    'Customer ' || o_custkey || CASE WHEN o_orderkey % 10 = 1 THEN ' new' ELSE '' END AS entity,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS record_no FROM orders),
good AS (SELECT * FROM o WHERE k NOT IN (3, 6)),
vals AS (SELECT o_custkey AS doc, record_no, y AS year, term AS period, entity, 'm1' AS metric, p AS value, false AS suppressed FROM good
  UNION ALL SELECT o_custkey, record_no, y, term, entity, 'm2', CASE WHEN k IN (2, 5) THEN NULL ELSE 7.5::DOUBLE END, k IN (2, 5) FROM good
  UNION ALL SELECT o_custkey, record_no, y, term, entity, 'm3', CASE WHEN k = 2 THEN p ELSE 100::DOUBLE END, false FROM good)"""

_COMMA = "replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"
_CHOICE_SQL = """counts AS (SELECT source, min(CAST(substr(source, 4) AS BIGINT)) AS priority,
    count(DISTINCT lang) FILTER (WHERE CAST(substr(source, 4) AS BIGINT) > 2 OR lang = 'en') AS entities
  FROM documents GROUP BY source),
best AS (SELECT coalesce(min(priority) FILTER (WHERE entities >= 4), max(priority)) AS best FROM counts)"""

QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

ORACLES = {
    "q_flatten_cube": f"""WITH {_CELLS_SQL} SELECT vec_id, CAST(i AS INTEGER) AS cell, 'area' || a AS area_code, 'area no. ' || a AS area,
        'age' || g AS age_code, 'age no. ' || g AS age, 'year' || y AS year_code, 'year no. ' || y AS year, value FROM cells""",
    "q_cube_grain": f"""WITH {_CELLS_SQL} SELECT vec_id, 'area no. ' || a AS area, 'age no. ' || g AS age,
        '202' || y || '-' || CAST(CAST('202' || y AS INTEGER) + 1 AS VARCHAR) AS school_year, CAST(value AS BIGINT) AS people
        FROM cells WHERE value IS NOT NULL AND a <> '0' AND g IN ('1', '2')""",
    "q_html_lines": f"""WITH {_LINES_SQL} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS line_no, text
        FROM lines WHERE text <> ''""",
    "q_links": f"WITH {_LINKS_SQL} SELECT page_id, CAST(link_no AS INTEGER) AS link_no, site || href AS url FROM links",
    "q_first_link": f"""WITH {_LINKS_SQL} SELECT page_id, arg_min(site || href, link_no) FILTER (WHERE lower(site || href) LIKE '%e'
        AND contains(lower(site || href), 'h')) AS url FROM links GROUP BY page_id""",
    "q_embedded_urls": """WITH d AS (SELECT page_id, url, md5(html) AS digest FROM pages),
        found AS (SELECT page_id, 'Page ' || page_id AS title, digest || '.xlsx' AS url, 0 AS n FROM d
          UNION ALL SELECT page_id, 'Inner & more', 'https://app.powerbi.com/' || digest, 1 FROM d
          UNION ALL SELECT page_id, 'Page ' || page_id, url, -1 FROM d WHERE contains(url, 'powerbi.com') OR contains(url, 'dwcdn.net') OR url LIKE '%.xlsx' OR url LIKE '%.xls')
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS url_no, title, url FROM found""",
    "q_words_to_lines": f"""WITH {_WORDS_SQL} SELECT doc_id, line * 12.0::DOUBLE AS top, array_to_string(w, ' ') AS text FROM words WHERE len(w) > 0""",
    "q_layout_columns": f"""WITH {_WORDS_SQL} SELECT doc_id, 'left' AS side, line * 12.0::DOUBLE AS top, array_to_string(w[1:12], ' ') AS text
          FROM words WHERE len(w) > 0 AND line >= 1
        UNION ALL SELECT doc_id, 'right', line * 12.0::DOUBLE, array_to_string(w[14:23], ' ') FROM words WHERE len(w) > 13 AND line >= 1""",
    "q_name_count_lines": """SELECT p_partkey // 40 AS page, (p_partkey % 40) * 10.0::DOUBLE AS top, p_name AS name, CAST(p_size AS BIGINT) AS count
        FROM part WHERE p_size % 5 <> 0 AND p_name <> 'red ring'""",
    "q_two_decimal_lines": """SELECT p_partkey // 40 AS page, (p_partkey % 40) * 10.0::DOUBLE AS top, p_name AS name,
        CAST(printf('%.1f', p_retailprice) AS DOUBLE) AS first_value, CAST(p_size || '.' || (p_size % 10) AS DOUBLE) AS second_value,
        CASE WHEN p_name = 'old bolt' THEN 'aggregate' ELSE 'entity' END AS row_type, p_name = 'new gear' AS is_small_group
        FROM part WHERE p_size % 7 <> 0 AND p_name <> 'hot rod'""",
    "q_regex_lines": f"""WITH {_PRICED_SQL} SELECT page, line_no, heading, name, first_value, second_value, count,
        CASE WHEN heading IS NULL THEN 'row without a heading above it' END AS issue, raw_text,
        name = 'red ring' OR coalesce(heading = 'Brand#7 block', false) AS is_small_group FROM rows_of""",
    "q_manual_review": f"""WITH {_PRICED_SQL} SELECT 'priced' AS "table", page, heading || ' | ' || name AS row_identifier,
        'unusual value; preserved' AS issue, raw_text FROM rows_of WHERE heading IS NOT NULL AND second_value = 25.5""",
    "q_carry_heading": """SELECT conv_id, turn, role, md5(text) AS digest,
        last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS asked FROM conversations""",
    "q_record_segments": """SELECT conv_id, turn, role, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS record_no
        FROM conversations""",
    "q_sectioned_lines": f"WITH {_SECTION_SQL} SELECT * FROM vals",
    "q_sectioned_issues": f"""WITH {_SECTION_SQL}, bad AS (SELECT *, record_no * 8 AS at0, ((o_custkey + o_orderkey) % 100) || ',5%' AS pct FROM o WHERE k IN (3, 6)),
        printed AS (SELECT *, at0 + 2 AS line_no, replace(y, '-', '–') AS raw_text FROM bad UNION ALL SELECT *, at0 + 3, pct FROM bad
          UNION ALL SELECT *, at0 + 5, '7.5%' FROM bad UNION ALL SELECT *, at0 + 6, '100%' FROM bad WHERE k = 3)
        SELECT o_custkey AS doc, line_no, record_no, raw_text,
          CASE WHEN k = 3 THEN 'record without entity or period' ELSE 'unexpected value count: 2' END AS issue FROM printed""",
    "q_extraction_audit": f"""WITH {_SECTION_SQL} SELECT 'summary' AS section, 'rows_extracted' AS item, CAST(count(*) AS VARCHAR) AS value, '' AS details FROM vals
        UNION ALL SELECT 'summary', 'non_null_value_rows', CAST(count(value) AS VARCHAR), '' FROM vals
        UNION ALL SELECT 'summary', 'suppressed_or_missing_value_rows', CAST(count(*) FILTER (WHERE suppressed) AS VARCHAR), '' FROM vals
        UNION ALL SELECT 'domain', 'year', CAST(count(DISTINCT year) AS VARCHAR), '' FROM vals
        UNION ALL SELECT DISTINCT 'domain_member', 'year', year, '' FROM vals
        UNION ALL SELECT 'domain', 'period', CAST(count(DISTINCT period) AS VARCHAR), '' FROM vals
        UNION ALL SELECT DISTINCT 'domain_member', 'period', period, '' FROM vals
        UNION ALL SELECT 'domain', 'metric', CAST(count(DISTINCT metric) AS VARCHAR), '' FROM vals
        UNION ALL SELECT DISTINCT 'domain_member', 'metric', metric, '' FROM vals""",
    "q_source_choice": f"""WITH {_CHOICE_SQL} SELECT source, entities, priority, priority = best AS chosen,
        CASE WHEN priority = best AND entities >= 4 THEN 'first source with enough entities'
          WHEN priority = best THEN 'fallback: no source has enough entities'
          WHEN entities >= 4 THEN 'a preferred source is complete' ELSE 'too few entities' END AS reason FROM counts, best""",
    "q_rows_of_chosen": f"""WITH {_CHOICE_SQL} SELECT doc_id, source, lang FROM documents
        WHERE source = (SELECT source FROM counts, best WHERE priority = best)""",
    "q_valid_records": """SELECT p_partkey, CAST(p_size AS VARCHAR) AS year, p_brand AS area FROM part WHERE p_size % 3 <> 0 AND p_size % 4 <> 0""",
    "q_scalars": f"""SELECT event_id, CASE WHEN event_id % 8 IN (1, 2, 3) THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS number,
        CASE WHEN event_id % 8 IN (1, 2, 3) THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS whole,
        CASE WHEN event_id % 8 IN (0, 1, 2) THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS percent,
        event_id % 8 IN (0, 1) AS suppressed,
        CASE WHEN event_id % 8 = 2 THEN 'unexpected percent value: ' || {_COMMA} || ' %' END AS issue,
        CAST(CAST(round(CAST(value AS DECIMAL(38,5)), 1) AS DECIMAL(38,1)) AS VARCHAR) AS shown,
        {sql_round('(value / NULLIF(user_id % 4, 0))')} AS ratio, year(ts) || '-' || (year(ts) + 1) AS school_year,
        year(ts) || '-' || (year(ts) + 1) AS from_label,
        CASE event_type WHEN 'click' THEN 'c' WHEN 'view' THEN 'v' ELSE 'other' END AS code, event_type AS stripped,
        CAST(user_id AS INTEGER) AS ordinal, CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS flag,
        CASE WHEN value > 200 THEN 'unusual value' END AS anomaly, 'https://example.com/events' AS source_url, 'as printed' AS source_note FROM events""",
}
