import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallyweave import constants as K
from tallyweave.operators import coverage as V, quality as Q
from tallyweave.operators.measures import strict_and_latest


def _matrix(spark):
    return spark.createDataFrame([("a", True, True, True), ("b", True, False, False), ("c", False, True, True), ("d", True, False, True)],
                                 "k string, reading boolean, spending boolean, outcomes boolean")


def test_gap_rows_and_classes(spark):
    gaps = V.gap_rows(_matrix(spark), "k", ["reading", "spending", "outcomes"])
    assert rows(gaps, "comparison", "k") == [
        ("outcomes_not_reading", "c"), ("outcomes_not_spending", "d"), ("reading_not_outcomes", "b"),
        ("reading_not_spending", "b"), ("reading_not_spending", "d"), ("spending_not_reading", "c"),
    ]
    classed = V.classify_gaps(gaps, "k", "spending", ["reading", "outcomes"], ["d"], {"spending_not_reading": "by nature"})
    assert {(r["comparison"], r["k"]): (r["gap_type"], r["assessment"]) for r in classed.collect()} == {
        ("outcomes_not_reading", "c"): (K.HARMONIZATION_GAP, K.ASSESS_REVIEW),
        ("outcomes_not_spending", "d"): (K.TRUE_GAP, K.ASSESS_TRUE),
        ("reading_not_outcomes", "b"): (K.TRUE_GAP, K.ASSESS_TRUE),
        ("reading_not_spending", "b"): (K.TRUE_GAP, K.ASSESS_TRUE),
        ("reading_not_spending", "d"): (K.TRUE_GAP, K.ASSESS_TRUE),
        ("spending_not_reading", "c"): (K.TRUE_GAP, K.ASSESS_TRUE),
    }


def test_classified_audit(spark):
    a = spark.createDataFrame([("x", "X1"), ("x", "X0"), ("y", "Y"), ("", "blank")], "k string, s string")
    b = spark.createDataFrame([("y", "Y"), ("z", "Z")], "k string, s string")
    out = V.classified_gap_audit({"p": (a, "k", "s"), "q": (b, "k", "s")}, "k", ["p_not_q", "q_not_p"], "q", ["p"])
    assert rows(out, "section", "comparison", "k", "source_values", "note") == [
        ("gap", "p_not_q", "x", "p: X0 and 1 more", "has outcomes but is absent from q"),
        ("gap", "q_not_p", "z", "q: Z", "unexpected difference; inspect source and harmonised names"),
        ("spelling", "p", "x", "X0", ""), ("spelling", "p", "x", "X1", ""), ("spelling", "q", "z", "Z", ""),
        ("summary", "all_sources", "", "", "p=2; q=2"), ("summary", "p_not_q", "", "", "1"), ("summary", "q_not_p", "", "", "1"),
    ]


def test_extraction_and_harmonization_audits(spark):
    df = spark.createDataFrame([("2024", "a", 1.0), ("2024", "b", None), ("2023", "a", 2.0)], "y string, e string, v double")
    issues = spark.createDataFrame([("bad",)], "issue string")
    assert rows(V.extraction_audit(df, "v", ["y", "e"], issues=issues), "section", "item", "value") == sorted([
        ("domain", "e", "2"), ("domain_member", "e", "a"), ("domain_member", "e", "b"), ("domain", "y", "2"), ("domain_member", "y", "2023"),
        ("domain_member", "y", "2024"), ("summary", "non_null_value_rows", "2"), ("summary", "rows_extracted", "3"),
        ("summary", "suppressed_or_missing_value_rows", "1"), ("issues", "parsing_issues", "1"), ("issue_kind", "bad", "1"),
    ], key=repr)
    assert rows(V.distinct_lists(df.limit(0), "s", {"y": ("y", None)}), "section", "item", "value") == [("s", "y", "0")]
    named = spark.createDataFrame([("s1", "h", "harmonized", "n", 2), ("s1", "h", "harmonized", "first", 1), ("s2", "s2", "needs_review", None, 3)],
                                  "s string, h string, st string, n string, o int")
    got = {(r["section"], r["item"]): (r["value"], r["details"]) for r in V.harmonization_audit(named, "s", "h", "st", "n", "o").collect()}
    assert got[("name", "s1")] == ("h | harmonized", "first")
    assert got[("summary", "names_needing_review")] == ("1", "")
    assert got[("to_review", "s2")] == ("s2", "")
    assert got[("rows_by_status", "harmonized")] == ("2", "")


def _checks(df):
    return {(r["check"], r["row_key"], r["column"]) for r in df.collect()}


ROW_CASES = [
    (lambda: Q.expect_numeric("t"), "1.5", "x1"), (lambda: Q.expect_numeric("t", allow_blank=False), "2", ""), (lambda: Q.expect_range("n", 0, 10), 5.0, 11.0),
    (lambda: Q.expect_range("n", above=0, whole=True), 5.0, 1.5), (lambda: Q.expect_blank("t"), "", "x"), (lambda: Q.expect_status_absent("t"), "unchanged", "needs_review"),
    (lambda: Q.expect_not_blank("t"), "x", " "), (lambda: Q.expect_bounded_by("n", "m"), 100.0, 101.0), (lambda: Q.expect_ratio("n", "m", "m"), 1.02, 1.03),
    (lambda: Q.expect_sum(["n", "m"], total=150.0), 51.1, 51.2), (lambda: Q.expect_implies("n needs t", F.col("n") > 0, F.col("t") == "yes", "t"), "yes", "no"),
]


@pytest.mark.parametrize("make, good, bad", ROW_CASES)
def test_row_rules(spark, make, good, bad):
    rule = make()

    def frame(value):
        row = {"k": "r", "t": "yes", "n": 1.0, "m": 100.0} | ({"t": value} if isinstance(value, str) else {"n": value})
        return spark.createDataFrame([tuple(row.values())], "k string, t string, n double, m double")

    assert Q.check_rows(frame(good), "tbl", ["k"], [rule]).count() == 0
    assert _checks(Q.check_rows(frame(bad), "tbl", ["k"], [rule])) == {(rule.check, "r", rule.column)}


def test_row_rules_skip_nulls(spark):
    df = spark.createDataFrame([("r", None, None)], "k string, n double, m double")
    rules = [Q.expect_range("n", 0, 1), Q.expect_ratio("n", "m", "m"), Q.expect_sum(["n", "m"]), Q.expect_bounded_by("n", "m")]
    assert Q.check_rows(df, "t", ["k"], rules).count() == 0


def test_table_rules(spark):
    df = spark.createDataFrame([("a", "m1"), ("a", "m2"), ("b", "m1"), ("b", "m1")], "e string, m string")
    good = df.filter("e = 'a'")
    assert rows(Q.require_columns(df, "t", ["e", "zz"]), "column") == [("zz",)]
    assert Q.require_rows(df, "t").count() == 0 and Q.require_rows(df.filter("e = 'q'"), "t").count() == 1
    assert Q.require_rows(df, "t", exactly=4).count() == 0 and Q.require_rows(df, "t", exactly=5).count() == 1
    assert Q.expect_domain(df, "t", "m", ["m1", "m2"]).count() == 0
    assert rows(Q.expect_domain(df, "t", "m", ["m1", "m3"]), "row_key", "message") == [("m2", "value outside the domain"), ("m3", "value never occurs")]
    assert Q.expect_cardinality(df, "t", "e", exactly=2, at_least=2).count() == 0 and Q.expect_cardinality(df, "t", "e", at_least=3).count() == 1
    assert Q.expect_unique(good, "t", ["e", "m"]).count() == 0 and rows(Q.expect_unique(df, "t", ["e", "m"]), "row_key", "observed") == [("b | m1", "2")]
    assert Q.expect_complete_grid(good, "t", ["e"], "m", ["m1", "m2"]).count() == 0
    assert rows(Q.expect_complete_grid(df, "t", ["e"], "m", ["m1", "m2"]), "row_key", "observed") == [("b", "m2")]
    assert Q.expect_grid_size(df, "t", "e", 2).count() == 0 and Q.expect_grid_size(df, "t", "e", 3).count() == 1


def test_join_rules(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a", 0), (2, "x", 0), (4, "d", 0)], "k int, v string, extra int")
    assert Q.expect_preserved(before, before.withColumn("more", F.lit(1)), "t", ["k"]).count() == 0
    assert rows(Q.expect_preserved(before, after, "t", ["k"]), "row_key", "observed", "message") == [("2", "v", "columns changed"), ("3", "", "row was lost"), ("4", "", "row was added")]
    m = spark.createDataFrame([("s", "t"), ("q", "wrong")], "s string, h string")
    assert rows(Q.expect_mapping(m, "t", "s", "h", {"s": "t", "q": "r", "zz": "y"}), "row_key") == [("q",)]
    assert rows(Q.expect_mapping(m, "t", "s", "h", {"s": "t", "zz": "y"}, required=True), "row_key") == [("zz",)]
    need = spark.createDataFrame([("x",), ("y",), ("z",)], "e string")
    down = spark.createDataFrame([("x", "g"), ("y", "")], "e string, g string")
    assert rows(Q.expect_retained(need, down, "t", "e", "g"), "row_key", "message") == [("y", "required entity lost its group"), ("z", "required entity is missing")]
    child, parent = need.filter("e < 'z'"), need.filter("e > 'x'")
    assert rows(Q.expect_referential(child, parent, "t", ["e"], equal=True), "row_key", "message") == [("x", "no parent row"), ("z", "no child row")]
    assert Q.expect_referential(child, need, "t", ["e"]).count() == 0
    assert rows(Q.expect_queue(child, parent, "t", "e"), "row_key", "message") == [("x", "queued but resolved"), ("z", "unresolved but not queued")]
    assert Q.expect_queue(child, child, "t", "e", must_be_empty=True).count() == 2
    audit = spark.createDataFrame([("i", "1"), ("j", "2")], "item string, value string")
    assert rows(Q.expect_items(audit, "t", "item", "value", {"i": "1", "j": "3", "k": None}), "row_key", "message") == [("j", "item has another value"), ("k", "item is missing")]


def test_recomputed(spark):
    obs = spark.createDataFrame([("g", "2022", "a", 1.0), ("g", "2022", "b", 2.0), ("g", "2023", "a", None), ("h", "2023", "c", 4.0)], "g string, p string, s string, v double")
    out = strict_and_latest(obs, "g", "p", "s", "v")
    assert Q.expect_recomputed(out, obs, "t", "g", "p", "s", "v").count() == 0
    moved = out.withColumn("latest_value", F.col("latest_value") + 0.1).filter("g = 'g'")
    assert rows(Q.expect_recomputed(moved, obs, "t", "g", "p", "s", "v"), "row_key", "message")[0] == ("g", "latest value")
    assert "group is missing" in {r["message"] for r in Q.expect_recomputed(moved, obs, "t", "g", "p", "s", "v").collect()}


def test_report(spark):
    df = spark.createDataFrame([(i,) for i in range(40)], "k int")
    violations = Q.check_rows(df, "t", ["k"], [Q.expect_range("k", high=0)])
    report = Q.quality_report(violations).orderBy("line").collect()
    assert (report[0]["result"], report[0]["message"], len(report)) == ("FAIL", "39 violation(s)", 31)
    assert Q.quality_report(violations.filter("false")).first()["result"] == "PASS"
