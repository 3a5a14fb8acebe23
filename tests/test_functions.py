import html
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from tallyweave.functions import names as N, notes, numbers as P


@pytest.mark.parametrize(
    "text, comma, expected",
    [(" 71,5 ", True, 71.5), ("nan", False, None), ("NaN", False, None), ("", False, None), (None, False, None),
     ("1d", False, None), ("abc", False, None), ("-3", False, -3.0), ("1e3", False, 1000.0), ("1,5", False, None)],
)
def test_parse_number(spark, text, comma, expected):
    assert one(spark, text, lambda c: P.parse_number(c, comma)) == expected


def test_parse_int_cuts_and_whole_rounds(spark):
    assert one(spark, "7.9", P.parse_int) == 7
    assert one(spark, "-7.9", P.parse_int) == -7
    assert one(spark, 7.5, P.whole, "double") == 8
    assert one(spark, "12a", P.parse_digits) is None


@pytest.mark.parametrize(
    "text, value, suppressed, issue",
    [("71,5%", 71.5, False, None), ("71.5%", 71.5, False, None), ("–", None, True, None), ("-", None, True, None),
     ("", None, True, None), (None, None, True, None), ("71,5", None, False, "unexpected percent value: 71,5")],
)
def test_percent(spark, text, value, suppressed, issue):
    assert one(spark, text, P.percent_value) == value
    assert one(spark, text, P.percent_suppressed) is suppressed
    assert one(spark, text, P.percent_issue) == issue


def test_rounding_ignores_float_noise(spark):
    assert one(spark, 2.675, P.stable_round, "double") == 2.68
    assert one(spark, 71.5149, P.stable_round, "double") == 71.51
    # The same mean summed in another order.
    assert one(spark, 71.515 - 1e-13, P.stable_round, "double") == one(spark, 71.515, P.stable_round, "double")
    assert one(spark, 1e30, P.stable_round, "double") == 1e30


@pytest.mark.parametrize("top, bottom, want", [(10699999, 4000000, 2.67), (10700000, 4000000, 2.68), (10700001, 4000000, 2.68), (-10699999, 4000000, -2.67)])
def test_values_just_under_a_tie_stay_below(spark, top, bottom, want):
    df = spark.createDataFrame([(top, bottom)], "a bigint, b bigint")
    assert df.select(P.safe_ratio("a", "b")).first()[0] == want


def test_ratio_and_formats(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (None, 4.0), (10.0, None)], "a double, b double")
    assert rows(df.select(P.safe_ratio("a", "b"))) == sorted([(2.5,), (None,), (None,), (None,)], key=repr)
    assert one(spark, 3.0, P.format_number, "double") == "3.0"
    assert one(spark, 1173867999.0, P.format_number, "double") == "1173867999.0"
    assert one(spark, 3.126, P.format_number, "double") == "3.13"
    assert one(spark, None, P.format_number, "double") == ""


def test_periods_and_codes(spark):
    assert one(spark, 2024, P.school_year, "int") == "2024-2025"
    assert one(spark, "2024–2025", P.school_year_from_label) == "2024-2025"
    assert one(spark, "2024-2025 71,5% –", P.school_year_from_label) == "2024-2025"
    assert one(spark, "1999-2000", P.school_year_from_label) is None
    assert one(spark, "10. bekkur", P.ordinal_from_label) == 10
    assert one(spark, "3000  Akranes ", P.strip_code_prefix) == "Akranes"
    assert one(spark, "b", lambda c: P.map_codes(c, {"a": "1"})) is None
    assert one(spark, "b", lambda c: P.map_codes(c, {"a": "1"}, F.lit("0"))) == "0"


def _group_key(text):
    text = text.casefold().strip()
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(re.findall("[a-z0-9]+", text))


def test_group_rule_equals_unicode_tables_on_every_latin_letter(spark):
    letters = [chr(c) for a, b in N._BLOCKS for c in range(a, b)] + list("AZaz09_-/ ")
    words = [f"x{ch}y" for ch in letters] + ["Grímsnes– og Grafningshreppur", "Garðabær", "  Ölfus ", "STRASSE Maß"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: (r["fast"], r["exact"]) for r in df.select("w", N.fold_key("w").alias("fold"), N.fold_key("w").alias("fast"), N.fold_key("w", exact=True).alias("exact")).collect()}
    for w in words:
        assert got[w] == (_group_key(w), _group_key(w)), w


def test_compatibility_forms_fold_by_default(spark):
    assert one(spark, "ﬁskur Ａ１ ⒜ ①", N.fold_key) == "fiskur a1 a 1"


def test_two_rules_differ(spark):
    assert one(spark, "Garðabær", N.fold_key) == "gar ab r"
    assert one(spark, "Garðabær", N.fold_name) == "gardabaer"
    assert one(spark, "NÚ ehf. - Þórshöfn", N.fold_name) == "nu thorshofn"
    assert one(spark, "ehfa ses", N.fold_name) == "ehfa"
    assert one(spark, "Skóli ib", lambda c: N.fold_name(c, [])) == "skoli ib"
    assert one(spark, "Skóli ib", lambda c: N.fold_name(c, exact=True)) == "skoli"


def test_alias_and_hints(spark):
    assert one(spark, "grunnskolinn i sandgerdi", N.alias_name) == "grunnskoli sandgerdi"
    assert one(spark, "grunnskolinn hellu", N.alias_name) == "grunnskoli hellu"
    assert one(spark, "akurskoli reykjanesbae", N.contains_hint) == "Reykjanesbær"
    assert one(spark, "akurskoli", N.contains_hint) is None
    assert one(spark, "heild", N.is_group_or_total) is True


def test_variants(spark):
    got = one(spark, "Grunnskólinn Hellu (eldri) / Barnaskólinn", N.name_variants)
    assert got == sorted(
        {"grunnskolinn hellu eldri barnaskolinn", "grunnskolinn hellu barnaskolinn", "grunnskoli hellu eldri barnaskolinn",
         "grunnskoli hellu barnaskolinn", "grunnskolinn hellu", "grunnskoli hellu", "barnaskolinn", "barnaskoli hellu"}
    )
    assert one(spark, "()", N.name_variants) == []
    assert one(spark, "Akurskóli", N.name_variants) == ["akurskoli"]


def test_priority_and_small_groups(spark):
    df = spark.createDataFrame(
        [("excluded_group_or_aggregate", True), ("matched_exact", True), ("matched_exact", False)], "s string, f boolean"
    )
    assert [r[0] for r in df.select(N.priority_class("s", F.col("f"))).collect()] == [
        "excluded_group_or_aggregate", "analysis_required", "reference_only"
    ]
    few = spark.createDataFrame([("few", "x"), ("a", "few"), ("a", None)], "e string, p string")
    assert [r[0] for r in few.select(N.is_small_group(["few"], "e", "p")).collect()] == [True, True, False]


def test_notes(spark):
    df = spark.createDataFrame([("a", "", None, "b")], "p string, q string, r string, s string")
    got = df.select(notes.join_notes("p", "q", "r", "s"), notes.first_nonblank("q", "r", "s"), notes.presence_flag("r")).first()
    assert tuple(got) == ("a; b", "b", False)
    listed = spark.createDataFrame([("b",), ("a",), ("b",), ("",), (None,)], "v string").agg(notes.sorted_list("v"))
    assert listed.first()[0] == "a; b"


def test_unescape_matches_the_standard_library(spark):
    from tallyweave.sources.html import unescape

    texts = ["a &amp; b", "&lt;p&gt;", "&#8211;x&#x2013;", "&aacute;&Eth;&thorn;", "&unknown; &", "no entity", "&nbsp;&copy;2024 &middot; &hellip;", "&amp;lt;", "&quot;q&quot; &#39;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", unescape("t").alias("a"), unescape("t", exact=True).alias("b")).collect():
        assert r["a"] == html.unescape(r["t"]), r["t"]
        assert r["b"] == html.unescape(r["t"])


def test_letters_with_longer_forms_are_looked_up(spark):
    """Only letters that a text holds are replaced, and no class of all of them is tried at each character."""
    letters, _, longer = N.accent_rule()
    text = "".join(f"x{a}" for a, _ in longer) + "ж" + "é"
    df = spark.createDataFrame([(text,), (None,), ("",), ("straße",)], "c string").select(N.remove_accents(F.col("c")).alias("r"))
    assert [r["r"] for r in df.collect()] == ["".join(f"x{b}" for _, b in longer) + "ж" + "e", None, "", "strasse"]
    assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString().upper()
    folded = [("the lost los_ ,les,them und.", "lost los them"), ("théthe the", "thethe"), ("theж the", "the")]
    for given, want in folded:
        assert one(spark, given, lambda c: N.fold_name(c, ["the", "und", "les", "los"])) == want
