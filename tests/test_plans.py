import json

from pyspark.sql import functions as F

from helpers import rows
from tallyweave import constants as K
from tallyweave.operators.resolve import NameRules
from tallyweave.plans import analysis, crosswalk, indicators
from tallyweave.sources import cube
from tallyweave.sources.lines import SectionRules

GROUPS = [("Sandgerðisbær", "Suðurnesjabær", "harmonized", "former", 1), ("Garður", "Suðurnesjabær", "harmonized", "former", 2), ("Höfn", "Höfn", "unchanged", "", 3)]


def _groups(spark):
    return spark.createDataFrame(GROUPS, "source string, name string, status string, notes string, ordinal int")


def test_reading(spark):
    def page(entities):
        body = "".join(f"<h2>{e}</h2><p>Maí</p><td>2023–2024</td><td>50%</td><td>–</td><td>2022–2023</td><td>4,5%</td><td>6%</td>" for e in entities)
        return f"<html><p>Intro</p>{body}</html>"

    pages = spark.createDataFrame([("first", 1, page(["Höfn"])), ("second", 2, page(["Sandgerðisbær", "GARÐUR"])), ("third", 3, "<p>x</p>")], "page string, priority int, html string")
    rules = SectionRules(metrics=["a", "b"], periods={"Maí": "vor"}, early_heading=F.col("text") != "Intro")
    out = indicators.build_reading(pages, rules, _groups(spark), minimum=2)
    assert rows(out.choice.filter("chosen"), "page") == [("second",)]
    assert rows(out.rows, "entity", "group", "year", "metric", "value")[:4] == [
        ("GARÐUR", "Suðurnesjabær", "2022-2023", "a", 4.5), ("GARÐUR", "Suðurnesjabær", "2022-2023", "b", 6.0),
        ("GARÐUR", "Suðurnesjabær", "2023-2024", "a", 50.0), ("GARÐUR", "Suðurnesjabær", "2023-2024", "b", None),
    ]
    audit = {r["item"]: r["value"] for r in out.audit.filter("section <> 'domain_member'").collect()}
    assert (audit["rows_extracted"], audit["non_null_value_rows"], audit["entity"]) == ("8", "6", "2")
    assert {r["value"] for r in out.harmonization_audit.filter("section = 'name'").collect()} == {"Suðurnesjabær | harmonized"}
    # No page has enough entities: the last in line is the fallback, even if empty.
    assert rows(indicators.build_reading(pages, rules, _groups(spark), minimum=9).choice.filter("chosen"), "page") == [("third",)]


def test_spending_and_population(spark):
    records = spark.createDataFrame(
        [("2024", "2000 Sandgerðisbær", "s1", "10,0", "100,4", ""), ("2024", "2001 Garður", "s2", "5", "50", "7"), ("2024", "Elsewhere", "s3", "0", "9", None)],
        "year string, area string, entity string, count string, gross string, rent string",
    )
    document = {"id": ["area", "member", "year"], "size": [3, 3, 1], "dimension": {
        d: {"category": {"index": {c: i for i, c in enumerate(codes)}, "label": {c: c for c in codes}}}
        for d, codes in {"area": ["Alls", "Sandgerðisbær", "Garður"], "member": ["total", "6", "7"], "year": ["2024"]}.items()},
        "value": [999, 9, 9, 200, 10, 20, 100, 5, None]}
    cells = cube.flatten_cube(spark.createDataFrame([("c", json.dumps(document))], "k string, j string"), "j", "k", ["area", "member", "year"])
    population = indicators.build_population(cells.withColumn("people", F.col("value").cast("bigint")), _groups(spark), "Alls", "total", ["6", "7"])
    assert rows(population, "area", "group", "total", "band") == [("Garður", "Suðurnesjabær", 100, 5), ("Sandgerðisbær", "Suðurnesjabær", 200, 30)]
    ordered = population.withColumn("ordinal", F.col("total"))
    out = indicators.build_spending(records, {"gross": "gross", "rent": "rent"}, _groups(spark), ordered)
    assert rows(out.spending, "source", "metric", "amount", "count", "per_unit", "total", "per_person", "per_band_person") == sorted([
        ("Sandgerðisbær", "gross", 100, 10, 10.0, 200, 0.5, 3.33), ("Sandgerðisbær", "rent", 0, 10, 0.0, 200, 0.0, 0.0),
        ("Garður", "gross", 50, 5, 10.0, 200, 0.25, 1.67), ("Garður", "rent", 7, 5, 1.4, 200, 0.04, 0.23),
        ("Elsewhere", "gross", 9, 0, None, None, None, None), ("Elsewhere", "rent", 0, 0, None, None, None, None)], key=repr)
    assert rows(out.missing) == [("Elsewhere",)]
    summed = indicators.build_spending(records, {"gross": "gross"}, _groups(spark), ordered, on_duplicate="sum")
    assert rows(summed.spending.filter("source = 'Garður'"), "total", "band") == [(300, 35)]


def test_crosswalk(spark):
    a = spark.createDataFrame([("Akurskóli", "12"), ("Óþekkt", "3"), ("Heild", "99")], "n string, c string").withColumn("o", F.lit(1))
    b = spark.createDataFrame([("Akurskóli",), ("Annað",)], "n string")
    register = spark.createDataFrame([("Akurskóli", "Garður")], "canonical string, `group` string")
    manual = spark.createDataFrame([("Annað", "annad", "Annað II", "Höfn", "OK", "agreed"), ("Gone", "gone", "", "", "", "keep me")],
                                   "name string, folded string, canonical string, `group` string, status string, note string")
    out = crosswalk.build_crosswalk({"in_a": (a, "n"), "in_b": (b, "n")}, ["in_a"], register, manual, _groups(spark), NameRules(), (a, "n", "c", "o"))
    assert rows(out.crosswalk, "name", "group_source", "group", "group_status", "match_status", "weight") == sorted([
        ("Akurskóli", "Garður", "Suðurnesjabær", "harmonized", K.MATCHED_EXACT, 12), ("Annað", "Höfn", "Höfn", "unchanged", K.MATCHED_MANUAL, None),
        ("Heild", None, None, None, K.EXCLUDED, 99), ("Óþekkt", None, None, None, K.NEEDS_MANUAL_REVIEW, 3)], key=repr)
    assert rows(out.required_review, "name") == [("Óþekkt",)]
    assert out.reference_review.count() == 0
    assert rows(out.manual_template, "name", "note") == sorted([("Annað", "agreed"), ("Gone", "keep me"), ("Óþekkt", None)], key=repr)
    assert {r["item"]: r["value"] for r in out.audit.filter("section = 'unresolved_required'").collect()} == {"Óþekkt": "weight=3; possible_match_1=; group=; score="}


def test_analysis(spark):
    obs = spark.createDataFrame(
        [("g1", "s1", "2023-2024", "vor", "m", 50.0), ("g1", "s1", "2023-2024", "haust", "m", 1.0), ("g1", "s2", "2023-2024", "vor", "m", None),
         ("g2", "s3", "2022-2023", "vor", "m", 40.0), ("g2", "s3", "2023-2024", "vor", "m", None)],
        "`group` string, source string, school_year string, term string, metric string, value double",
    )
    spending = spark.createDataFrame(
        [(2024, "g1", "net", 100, 1.0, 2.0, 3.0, 10, 50, 5, "u", 1), (2024, "g3", "gross", 7, None, None, None, 1, None, None, "v", 2), (2023, "g9", "net", 1, None, None, None, 1, None, None, "", 3)],
        "year int, `group` string, metric string, amount long, per_unit double, per_person double, per_band_person double, units long, total long, band long, source_url string, ordinal int",
    )
    population = spark.createDataFrame([(2024, "g2", 11, 1, 1), (2024, "g2", 22, 2, 2), (2024, "g8", 9, 9, 3)], "year int, `group` string, total long, band long, ordinal int")
    graduates = spark.createDataFrame([("e1", 10, "", 1), ("e2", 30, "look", 2), ("Heild", 99, "", 3)], "name string, count long, review string, ordinal int")
    grades = spark.createDataFrame([("e1", 3.0, None, "entity", "", 1), ("Heild", 3.5, 3.5, "aggregate", "", 2)], "name string, x double, y double, row_type string, review string, ordinal int")
    paired = spark.createDataFrame([("e1", 4), ("e1", None), ("e4", None)], "name string, count long")
    cw = spark.createDataFrame([(n, n, g, p, "s", "1", "src", note) for n, g, p, note in [("e1", "g1", K.REQUIRED, "n1"), ("e2", "g1", K.REQUIRED, ""), ("e4", "g4", K.REQUIRED, None), ("Heild", None, K.EXCLUDED, "")]],
                               "name string, canonical string, `group` string, priority string, match_status string, match_confidence string, match_source string, note string")
    out = analysis.build_analysis(obs, spending, population, graduates, grades, paired, cw, ["x", "y"], analysis.AnalysisSettings("vor", "m", "2024", "net", "gross"), ["Heild"], [("c", "v", "d")])
    assert rows(out.spine, "group", "strict_value", "latest_value", "latest_period", "net_amount", "gross_amount", "population_total", "has_population", "source_url") == [
        ("g1", 50.0, 50.0, "2023-2024", 100, None, 50, True, "u"), ("g2", None, 40.0, "2022-2023", None, None, 22, True, None), ("g3", None, None, None, None, 7, None, False, "v")
    ]
    assert rows(out.entities, "name", "graduates", "paired_rows", "paired_count", "is_excluded", "notes") == [
        ("Heild", 99, 0, None, True, ""), ("e1", 10, 2, 4, False, "n1"), ("e2", 30, 0, None, False, "look"), ("e4", None, 1, None, False, "")
    ]
    assert rows(out.groups, "group", "total_weight", "coverage_share", "average_x", "average_y") == [("g1", 40, 0.25, 3.0, None), ("g4", 0, None, None, None)]
    audit = {(r["section"], r["item"]): (r["value"], r["details"]) for r in out.audit.filter("section NOT IN ('join_gap', 'member')").collect()}
    assert audit[("summary", "spine_rows")] == ("3", "") and audit[("summary", "entity_rows")] == ("4", "") and audit[("summary", "group_summary_rows")] == ("2", "")
    assert audit[("summary", "latest_available_fallback_groups")] == ("1", "") and audit[("summary", "weak_coverage_groups")] == ("2", "")
    assert audit[("coverage", "outcomes")] == ("2", "") and audit[("join_gap_summary", "spending_not_reading")] == ("1", "")
    members = {}
    for r in out.audit.filter("section = 'member'").collect():
        members.setdefault(r["item"], set()).add(r["value"])
    assert members["latest_available_fallback_groups"] == {"g2"} and members["weak_coverage_groups"] == {"g1", "g4"}
    assert members["outcomes"] == {"g1", "g4"} and members["spending_not_reading"] == {"g3"}
    assert audit[("caveat", "c")] == ("v", "d")


def test_shared_inputs_are_read_once(spark):
    from helpers import parquet_reads
    from tallyweave.queries import audit_queries, registry

    folder = "/root/testdata/sf0.001"
    assert parquet_reads(registry.QUERIES["q_sectioned_lines"](spark, folder), "orders") == 1
    assert parquet_reads(audit_queries.q_coverage_audit(spark, folder)) < 20
