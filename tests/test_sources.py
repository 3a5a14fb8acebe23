import json
import tempfile
from pathlib import Path
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallyweave.sources import cube, html, layout, lines, tables


def test_csv_round_trip(spark):
    folder = tempfile.mkdtemp(prefix="run-") + "/t"
    df = spark.createDataFrame([("b", 'say "hi", x', None), ("a", None, "1.0")], "k string, t string, v string").withColumn("extra", F.lit(1))
    tables.write_table(df, folder, ["k", "t", "v"], "csv", sort_by=["k"])
    back = tables.read_text_table(spark, folder, ["k", "t", "v"])
    assert back.columns == ["k", "t", "v"]
    assert rows(back) == [("a", None, "1.0"), ("b", 'say "hi", x', None)]
    many = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") * 7919 % 1000).alias("k"), F.lit("t").alias("t"), F.lit(None).cast("string").alias("v"))
    tables.write_table(many.repartition(7), folder + "s", ["k"], "csv", sort_by=["k"])
    files = sorted(Path(folder + "s").glob("part-*"))
    written = [line for f in files for line in f.read_text().splitlines()[1:]]
    assert written == sorted(written) and len(written) == 1000
    tables.write_table(df, folder + "p", ["v", "k"], "parquet", partition_by=["k"])
    assert set(spark.read.parquet(folder + "p").columns) == {"v", "k"}


def _cube(ids, sizes, values, order=None):
    dims = {}
    for name, size in zip(ids, sizes):
        codes = [f"{name}{i}" for i in range(size)]
        dims[name] = {"category": {"index": {c: (i + 1) % size for i, c in enumerate(codes)}, "label": {c: f"label {c}" for c in codes}}}
    return json.dumps({"id": order or ids, "size": sizes, "dimension": dims, "value": values})


def test_cube_of_four_dimensions(spark):
    ids, sizes = ["s", "a", "y", "k"], [2, 3, 2, 1]
    values = [None if i == 4 else float(i) for i in range(12)]
    df = spark.createDataFrame([("c", _cube(ids, sizes, values))], "id string, json string")
    got = cube.flatten_cube(df, "json", "id", ids).orderBy("cell").collect()
    assert len(got) == 12
    for r in got:
        i = r["cell"]
        # Index order is one step away from label order.
        place = [i // 6 % 2, i // 2 % 3, i % 2, 0]
        codes = [f"{n}{(p - 1) % size}" for n, p, size in zip(ids, place, sizes)]
        assert [r[f"{n}_code"] for n in ids] == codes
        assert r["s"] == f"label {codes[0]}"
        assert r["value"] == values[i]


@pytest.mark.parametrize("bad", ["order", "length", "labels"])
def test_cube_guards(spark, bad):
    ids, sizes, values = ["s", "y"], [2, 2], [1.0, 2.0, 3.0, 4.0]
    text = _cube(ids, sizes, values, ["y", "s"]) if bad == "order" else _cube(ids, sizes, values[:3]) if bad == "length" else None
    if bad == "labels":
        broken = json.loads(_cube(ids, sizes, values))
        del broken["dimension"]["s"]["category"]["index"]["s1"]
        text = json.dumps(broken)
    df = spark.createDataFrame([("c", text)], "id string, json string")
    with pytest.raises(Exception, match="cube: "):
        cube.flatten_cube(df, "json", "id", ids).count()


def test_cube_grain(spark):
    cells = spark.createDataFrame([("all", "1", 5.0), ("x", "1", 3.0), ("x", "2", None), ("x", "9", 1.0)], "a string, g string, value double")
    assert rows(cube.cube_cells_to_grain(cells, drop={"a": "all"}, keep={"g": ["1", "2"]}, count="n")) == [("x", "1", 3)]
    with pytest.raises(Exception, match="not a whole number"):
        cube.cube_cells_to_grain(cells.union(spark.createDataFrame([("x", "1", 2.5)], cells.schema))).collect()
    assert cube.drop_totals(cells, "a", "all").count() == 3
    assert cube.in_domain(cells, "g", ["9"]).count() == 1


PAGE = """<html><head><style>p { <b> }</style><script>var a = "<p>no</p>";</script></head>
<body><p>First&nbsp;&nbsp;line<br/>Second &amp; third</p><table><tr><td>1</td><td> 2 </td></tr></table>
<ul><li><a href="/x/y.xlsx">abs</a></li><li><a class="k" href='sub/z.xlsx?q=1'>rel</a></li><li><a href="../up.XLSX">up</a></li></ul>
<!-- <a href="hidden.xlsx">no</a> --><a href="https://other.is/f.xlsx">far</a><a name="n">none</a></body></html>"""


def test_html_lines(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "   ")], "id int, html string")
    got = html.html_to_lines(df, "id", "html")
    assert [r["text"] for r in got.orderBy("line_no").collect()] == [
        "First line", "Second & third", "1", "2", "abs", "rel", "up", "no --> far none"
    ]
    assert rows(got) == rows(html.html_to_lines(df, "id", "html", exact=True))


def test_links(spark):
    base = "https://site.is/a/b/page?x=1"
    df = spark.createDataFrame([(1, base, PAGE)], "id int, url string, html string")
    assert [r["url"] for r in html.extract_links(df, "id", "html", "url").orderBy("link_no").collect()] == [
        "https://site.is/x/y.xlsx", "https://site.is/a/b/sub/z.xlsx?q=1", "https://site.is/a/up.XLSX", "https://other.is/f.xlsx"
    ]
    assert html.first_link(df, "id", "html", "url", ".xlsx", ["up"]).first()["url"] == "https://site.is/a/up.XLSX"
    assert html.first_link(df, "id", "html", "url", ".pdf").first()["url"] is None


def test_resolve_url_matches_the_standard_library(spark):
    bases = ["https://h.is", "https://h.is/", "https://h.is/a/b", "https://h.is/a/b/?q=1#f"]
    hrefs = ["x", "./x", "../x", "../../../x", "/x", "//o.is/x", "?k=v", "#top", "https://o.is/", "a/../b", "a/./b/", "..", "x?y#z", "mailto:a@b"]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in df.withColumn("u", html.resolve_url("b", "h")).collect():
        assert r["u"] == urljoin(r["b"], r["h"]), (r["b"], r["h"])


def test_embedded_urls(spark):
    tree = {"props": {"pageProps": {"page": {"title": "Top", "url": "https://h.is/no", "parts": [
        {"url": "https://app.powerbi.com/1"}, {"title": "In", "deep": {"url": "f.xls", "list": [[{"url": "https://x.dwcdn.net/2"}]]}}]}}}}
    page = f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(tree)}</script>'
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>"), (3, page.replace("{", "[", 1))], "id int, html string")
    assert rows(html.harvest_embedded_urls(df, "id", "html")) == [
        (1, 0, "Top", "https://app.powerbi.com/1"), (1, 1, "In", "f.xls"), (1, 2, "In", "https://x.dwcdn.net/2")
    ]


def _words(spark, printed):
    data = [(page, float(x), float(top), n, text) for page, (x, top, n, text) in printed]
    return spark.createDataFrame(data, "page int, x0 double, top double, word_no long, text string")


def test_layout(spark):
    printed = [
        (1, (100, 50.0, 0, "Header")), (1, (10, 100.02, 1, "Akur")), (1, (60, 100.04, 2, "skóli")), (1, (200, 100.0, 3, "22")),
        (1, (260, 100.0, 4, "Hóla")), (1, (400, 100.0, 5, "26")), (1, (245, 100.0, 6, "gutter")),
        (1, (10, 112.0, 7, "No")), (1, (60, 112.0, 8, "count")), (1, (10, 124.0, 9, "Fjöldi")), (1, (60, 124.0, 10, "9")),
    ]
    words = _words(spark, printed)
    placed = layout.split_layout_columns(words, [("left", None, 240.0), ("right", 250.0, 450.0)], min_top=90)
    keys = ["page", "side"]
    assert rows(layout.words_to_lines(placed, keys), "side", "top", "text") == [
        ("left", 100.0, "Akur skóli 22"), ("left", 112.0, "No count"), ("left", 124.0, "Fjöldi 9"), ("right", 100.0, "Hóla 26")
    ]
    got = layout.parse_name_count_line(layout.line_words(placed, keys), keys, headers=["Fjöldi"])
    assert rows(got, "name", "count") == [("Akur skóli", 22), ("Hóla", 26)]


def test_two_decimals(spark):
    printed = [
        (1, (10, 10.0, 0, "Heild")), (1, (60, 10.0, 1, "3.2")), (1, (90, 10.0, 2, "3.1")),
        (1, (10, 20.0, 3, "Few")), (1, (30, 20.0, 4, "left")), (1, (60, 20.0, 5, "2.8")), (1, (90, 20.0, 6, "2.51")),
        (1, (10, 30.0, 7, "One")), (1, (60, 30.0, 8, "2.8")), (1, (60, 40.0, 9, "2.8")), (1, (90, 40.0, 10, "2.9")), (1, (95, 40.0, 11, "3.9")),
    ]
    got = layout.parse_name_two_decimals_line(
        layout.line_words(_words(spark, printed), ["page"]), ["page"], total_name="Heild", small_group="Few left"
    )
    assert rows(got, "name", "first_value", "second_value", "row_type", "is_small_group") == [
        ("Few left", 2.8, 2.51, "entity", True), ("Heild", 3.2, 3.1, "aggregate", False)
    ]


def test_regex_lines(spark):
    text = ["Table 2", "A school 1.5 2.5 10", "Upper One", "B school 1 2.51 7", "Few 2.0 3.0 9", "12", "Upper Two", "C 4.0 4.0 1"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(text)], "page int, n long, text string")
    got = lines.parse_regex_line(
        df, ["page"], "n", "text", r"^(.+?)\s+(\d+(?:\.\d+)?)\s+(\d+(?:\.\d+)?)\s+(\d+)$",
        [("name", "string"), ("x", "double"), ("y", "double"), ("n_students", "bigint")], "heading",
        skip_prefixes=["Table 2"], small_group_labels=["Few"],
    )
    assert rows(got, "heading", "name", "y", "n_students", "issue", "is_small_group") == sorted([
        (None, "A school", 2.5, 10, "row without a heading above it", False), ("Upper One", "B school", 2.51, 7, None, False),
        ("Upper One", "Few", 3.0, 9, None, True), ("Upper Two", "C", 4.0, 1, None, False)], key=repr)
    flagged = got.withColumn("reason", F.when(F.col("y") == 2.51, F.lit("odd")))
    assert rows(tables.manual_review_rows(flagged, "t2", "reason", ["heading", "name"], "raw_text", "page")) == [
        ("t2", 1, "Upper One | B school", "odd", "B school 1 2.51 7")
    ]


DOCUMENTS = {
    1: ["Intro", "Garðabær", "Maí", "2020–2021", "71,5%", "–", "3%", "2021-2022 1% 2% 3%", "Sept", "2020-2021", "Page", "5%", "6%", "7%",
        "Höfn", "Maí", "2020-2021", "5%", "6%", "2021-2022", "1%", "2%", "3%", "STOP", "Late", "Maí", "2020-2021 1% 2% 3%"],
    2: ["Garður", "Maí", "2020-2021 1% 2% 3%", "9%", "2021-2022 1% 2% 3%", "Bær", "2020-2021 1% 2% 3%", "Sept", "2022-2023 1% 2% 3% 4%", "5%", "6%", "Maí", "2020-2021 1% x 3%"],
    3: ["Ísabær", "Sept", "2020-2021", "1%", "1. note", "2%", "3%", "2021-2022", "1%", "2%", "3%", "8%"],
    4: [],
}


def _record(year, period, entity, *values):
    return [(year, period, entity, f"m{i}", v) for i, v in enumerate(values, start=1)]


# Worked out by hand: complete records, and the number of records that are not.
EXPECTED = {
    1: (
        _record("2020-2021", "vor", "Garðabær", 71.5, None, 3.0)
        + _record("2021-2022", "vor", "Garðabær", 1.0, 2.0, 3.0)
        + _record("2020-2021", "haust", "Garðabær", 5.0, 6.0, 7.0)
        + _record("2021-2022", "vor", "Höfn", 1.0, 2.0, 3.0),
        1,  # two values only
    ),
    2: (
        _record("2020-2021", "vor", "Bær", 1.0, None, 3.0),
        4,  # no entity; a stray value as heading; a heading without period; too many values
    ),
    3: ([], 2),  # a note inside the record; a stray value as heading
    4: ([], 0),
}


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_sectioned_lines(spark, block_rows):
    data = [(d, i, t) for d, texts in DOCUMENTS.items() for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc int, n long, text string")
    rules = lines.SectionRules(
        metrics=["m1", "m2", "m3"], periods={"Maí": "vor", "Sept": "haust"}, skip_lines=["Page"],
        stop=F.col("text") == "STOP", early_heading=F.endswith(F.col("text"), F.lit("bær")), block_rows=block_rows,
    )
    got, issues = lines.parse_sectioned_lines(df, "doc", "n", rules)
    kept, found = got.collect(), issues.collect()
    for doc, (expected, bad) in EXPECTED.items():
        mine = [(r["year"], r["period"], r["entity"], r["metric"], r["value"]) for r in kept if r["doc"] == doc]
        assert sorted(mine, key=repr) == sorted(expected, key=repr), doc
        reasons = ("record without", "unexpected value count")
        broken = {r["record_no"] for r in found if r["doc"] == doc and r["issue"].startswith(reasons)}
        assert len(broken) == bad, doc
    assert [(r["doc"], r["raw_text"]) for r in found if r["issue"].startswith("unexpected percent")] == [(2, "x")]
    assert [(r["metric"], r["suppressed"]) for r in kept if r["doc"] == 1 and r["value"] is None] == [("m2", True)]
    assert {r["issue"] for r in found if r["doc"] == 2 and r["raw_text"] == "Maí"} == {"period line without entity"}


@pytest.mark.parametrize("block_rows", [4, 1000])
def test_endless_record_and_its_neighbours(spark, block_rows):
    texts = ["Town", "Maí", "2020–2021 1% 2% 3% 4%", *["5%"] * 30, "2021–2022", "6%", "7%", "x", "2022–2023", "6%", "7%", "8%"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc int, n long, text string")
    rules = lines.SectionRules(metrics=["m1", "m2", "m3"], periods={"Maí": "vor"}, block_rows=block_rows)
    got, issues = lines.parse_sectioned_lines(df, "doc", "n", rules)
    found = sorted((r["n"], r["record_no"], r["issue"]) for r in issues.collect())
    assert found[:31] == [(n, 1, "unexpected value count: 34") for n in range(2, 33)]
    assert found[31:34] == [(n, 2, "unexpected value count: 2") for n in range(33, 36)]
    assert [f[2] for f in found[34:]] == ["record without entity or period"] * 4
    assert got.count() == 0


def test_sectioned_documents_of_one_block_are_scanned_once(spark):
    """No second pass runs over the lines where no state is carried."""
    from tallyweave.queries import registry

    for name in ("q_sectioned_lines", "q_extraction_audit", "q_sectioned_issues"):
        df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        ran = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        assert sum("Window [" in line and "AS _in_sum_record_no" in line for line in ran.splitlines()) == 1, name


def test_words_of_documents_are_not_dealt_again(spark):
    """Texts are dealt once by document; their words, several times as large, are not shuffled."""
    from tallyweave.queries import registry

    for name in ("q_words_to_lines", "q_layout_columns"):
        df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        ran = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        dealt = [line for line in ran.splitlines() if "Exchange hashpartitioning" in line]
        assert len(dealt) == 1 and "doc_id" in dealt[0] and "top" not in dealt[0], name


def test_source_choice(spark):
    data = [("a", 1, e) for e in "xyz"] + [("b", 2, e) for e in "vwxyz"] + [("c", 3, e) for e in "uvwxyz"]
    df = spark.createDataFrame(data, "source string, priority int, entity string")
    choice = tables.choose_source(df, "source", "entity", "priority", 5)
    assert [r["source"] for r in choice.filter("chosen").collect()] == ["b"]
    assert tables.rows_of_chosen(df, "source", choice).count() == 5
    none = tables.choose_source(df, "source", "entity", "priority", 50).filter("chosen").first()
    assert (none["source"], none["reason"]) == ("c", "fallback: no source has enough entities")
    records = spark.createDataFrame([("2024", "a"), ("20x4", "a"), ("2024", " "), (None, "a")], "y string, g string")
    assert tables.promote_valid_records(records, "y", "g").count() == 1
