import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallyweave import constants as K
from tallyweave.operators import harmonize as H, joins, keys, measures as M

OBS = [
    # group, period, source, value
    ("One", "2022-2023", "one", 50.0), ("One", "2023-2024", "one", 60.0),
    ("Three", "2022-2023", "a", 10.0), ("Three", "2022-2023", "b", 20.0), ("Three", "2022-2023", "c", None),
    ("Three", "2023-2024", "a", None), ("Three", "2023-2024", "b", 30.0),
    ("Empty", "2022-2023", "x", None), ("Empty", "2022-2023", "y", None),
    ("Older", "2022-2023", "o", 70.0), ("Older", "2023-2024", "o", None),
    ("Absent", "2021-2022", "p", 5.0), ("Absent", "2021-2022", "q", 6.0),
]


@pytest.fixture()
def obs(spark):
    return spark.createDataFrame(OBS, "g string, p string, s string, v double")


def test_strict_and_latest(obs):
    got = {r["g"]: r.asDict() for r in M.strict_and_latest(obs, "g", "p", "s", "v").collect()}
    view = {g: (r["strict_value"], r["strict_component_count"], r["strict_nonmissing_component_count"], r["strict_method"],
                r["latest_period"], r["latest_value"], r["latest_component_count"], r["latest_method"]) for g, r in got.items()}
    assert view == {
        "One": (60.0, 1, 1, K.METHOD_DIRECT, "2023-2024", 60.0, 1, K.METHOD_DIRECT),
        "Three": (30.0, 2, 1, K.METHOD_SINGLE, "2023-2024", 30.0, 2, K.METHOD_SINGLE),
        "Empty": (None, 2, 0, K.METHOD_NONE, None, None, 2, K.METHOD_NONE),
        "Older": (None, 1, 0, K.METHOD_DIRECT, "2022-2023", 70.0, 1, K.METHOD_DIRECT),
        "Absent": (None, 2, 0, K.METHOD_NONE, "2021-2022", 5.5, 2, K.METHOD_AVERAGE),
    }
    assert all(r["strict_period"] == "2023-2024" for r in got.values())
    assert got["Empty"]["latest_note"] == "no value found in any period"
    assert got["Three"]["strict_note"] == "only b has a value of 3 components"
    out = M.strict_and_latest(obs, "g", "p", "s", "v")
    assert rows(M.fallback_used(out), "g") == [("Absent",), ("Older",)]
    assert rows(M.multi_component(out), "g") == [("Absent",), ("Empty",), ("Three",)]


def test_component_average(obs):
    got = M.component_average(obs, "g", "p", "s", "v")
    assert rows(got.filter("g = 'Three'"), "p", "value", "component_count", "nonmissing_component_count", "method") == [
        ("2022-2023", 15.0, 3, 2, K.METHOD_AVERAGE), ("2023-2024", 30.0, 2, 1, K.METHOD_SINGLE)
    ]


def test_component_rows(obs):
    got = M.component_rows(obs, "g", "p", "s", "v")
    assert rows(got.filter("g = 'Three' AND p = '2023-2024'"), "s", "values") == [("a", 0), ("b", 1)]


def test_rollup_and_reshape(spark):
    df = spark.createDataFrame(
        [("g", 10, 1, None, "unchanged", "b"), ("g", -4, 2, None, "harmonized", "a"), ("g", None, 3, None, "unchanged", "b"),
         ("h", 1, 1, 5, "unchanged", ""), ("h", 1, 1, 5, "needs_review", None)],
        "g string, a long, n long, e long, status string, note string",
    )
    rolled = M.rollup_sum(df, ["g"], ["a", "e"], "n", ("status", "note"))
    assert rows(rolled) == [("g", 6, 0, 6, "harmonized", "a | b"), ("h", 2, 10, 2, "needs_review", "")]
    long = M.unpivot_measures(rolled, ["g"], ["a", "e"])
    assert rows(long) == [("g", "a", 6), ("g", "e", 0), ("h", "a", 2), ("h", "e", 10)]
    assert rows(M.pivot_metrics(long, ["g"], "metric", ["e", "a"], ["amount"])) == [("g", 0, 6), ("h", 10, 2)]
    assert rows(M.align_metrics(long, ["g"], "metric", "amount", {"a": "first", "zz": "none"})) == [("g", 6, None), ("h", 2, None)]
    assert rows(M.slice_rows(long, g="g", metric="a")) == [("g", "a", 6)]


def test_conditional_totals(spark):
    df = spark.createDataFrame(
        [("x", "ALL", 90, 1), ("x", "ALL", 100, 2), ("x", "6", 5, 3), ("x", "7", 6, 4), ("x", "20", 50, 5),
         ("no total", "6", 5, 1), ("null total", "ALL", None, 1), ("null total", "6", 1, 2)],
        "g string, m string, v long, o int",
    )
    assert rows(M.conditional_totals(df, ["g"], "m", "v", "ALL", ["6", "7"], "o")) == [("x", 100, 11)]


def test_denominators(spark):
    money = spark.createDataFrame([(2024, "a", 100, 4), (2024, "b", 50, 0), (2024, "c", 9, 3)], "year int, g string, amount long, own long")
    people = spark.createDataFrame([(2024, "a", 10, 1), (2024, "a", 20, 2), (2024, "b", 0, 1), (2023, "c", 5, 1)], "year int, g string, total long, o int")
    args = (money, ["year", "g"], "amount", people, "o")

    def got(**kw):
        out = M.attach_denominators(*args, own={"own": "per_own"}, looked_up={"total": "per_head"}, **kw)
        return rows(out, "g", "per_own", "total", "per_head")

    assert got() == [("a", 25.0, 20, 5.0), ("b", None, 0, None), ("c", 3.0, None, None)]
    assert got(on_duplicate="first")[0] == ("a", 25.0, 10, 10.0)
    assert got(on_duplicate="sum")[0] == ("a", 25.0, 30, 3.33)
    with pytest.raises(Exception, match="duplicate key: 2024, a"):
        got(on_duplicate="error")
    assert rows(M.missing_denominators(money, ["year", "g"], people, "g")) == [("c",)]


def test_dedup(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 2, None), ("j", 5, "z")], "k string, o int, v string")
    assert rows(keys.dedup(df, ["k"], "o")) == [("j", 5, "z"), ("k", 2, None)]
    assert rows(keys.dedup(df, ["k"], "o", "first")) == [("j", 5, "z"), ("k", 1, "x")]
    assert rows(keys.latest_per_key(spark.createDataFrame([("k", 1, 9), ("k", 2, 7), ("k", 2, 8)], "k string, y int, o int"), ["k"], "y", "o", ["o"])) == [("k", 2, 7)]
    with pytest.raises(ValueError):
        keys.dedup(df, ["k"], "o", "some")


def test_dedup_keeps_values_without_an_order(spark):
    df = spark.createDataFrame([("a", None, 10), ("b", None, 1), ("b", 2, 2), ("b", None, 9), ("t", 1, 5), ("t", 1, 4)], "k string, o int, v int")
    assert rows(keys.dedup(df, ["k"], "o")) == [("a", None, 10), ("b", 2, 2), ("t", 1, 5)]
    assert rows(keys.dedup(df, ["k"], "o", "first")) == [("a", None, 10), ("b", 2, 2), ("t", 1, 4)]


def test_dedup_error_is_not_pruned(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k string, o int, v int")
    for read in (lambda d: d.select("k").collect(), lambda d: d.count(), lambda d: d.collect()):
        with pytest.raises(Exception, match="duplicate key: a"):
            read(keys.dedup(df, ["k"], "o", "error"))
    assert keys.dedup(df.filter("o = 1"), ["k"], "o", "error").count() == 1


def test_null_names_meet_in_one_row(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    c = spark.createDataFrame([(None, 5)], "k string, c int")
    got = joins.entity_outer_join("k", {"a": (a, ["a"]), "b": (b, ["b"]), "c": (c, ["c"])})
    assert rows(got, "k", "a", "b", "c") == sorted([(None, 1, 3, 5), ("x", 2, None, None), ("y", None, 4, None)], key=repr)


def test_key_sets(spark):
    a = spark.createDataFrame([("x",), ("y",), ("",), (None,)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    ka, kb = keys.key_set(a, "k"), keys.key_set(b, "k")
    assert rows(keys.key_union(ka, kb)) == [("x",), ("y",), ("z",)]
    assert rows(keys.key_difference(ka, kb)) == [("x",)]
    assert rows(keys.key_set_difference_both_ways(ka, kb)) == [("x", "left_only"), ("z", "right_only")]
    assert keys.append_sections(ka, kb).count() == 4


def test_group_summary(spark):
    df = spark.createDataFrame(
        [("g", "a", 10, 3.0, None, True), ("g", "b", 30, 4.0, 2.0, False), ("g", "c", None, 9.0, None, False), ("g", "d", 0, 8.0, None, False),
         ("g", "e", 5, None, None, False), ("none", "f", 7, None, None, False), ("light", "h", None, 3.0, None, False), ("light", "i", None, 4.0, None, False)],
        "g string, e string, w long, x double, y double, flag boolean",
    )
    got = {r["g"]: r for r in joins.group_summary(df, "g", "e", "w", ["x", "y"], ["flag"]).collect()}
    g = got["g"]
    assert (g["total_weight"], g["covered_weight"], g["coverage_share"], g["entities"]) == (45, 40, 0.8889, 5)
    assert (g["weighted_x"], g["unweighted_x"], g["average_x"]) == (3.75, 6.0, 3.75)
    assert (g["entities_with_weight"], g["entities_with_value"], g["any_flag"], g["weighting_method"]) == (4, 4, True, K.WEIGHTED)
    assert (got["none"]["average_x"], got["none"]["coverage_share"], got["none"]["weighting_method"]) == (None, 0.0, K.UNWEIGHTED)
    assert (got["light"]["average_x"], got["light"]["weighted_x"], got["light"]["coverage_share"]) == (3.5, None, None)
    weak = M.weak_coverage(joins.group_summary(df, "g", "e", "w", ["x", "y"]), "coverage_share")
    assert rows(weak, "g") == [("light",), ("none",)]


def test_spine_and_entity_joins(spark):
    a = spark.createDataFrame([("k1", 1), ("k2", 2), ("", 9)], "k string, a int")
    b = spark.createDataFrame([("k2", "x"), ("k3", "y")], "k string, b string")
    c = spark.createDataFrame([("k1", True), ("k9", False)], "k string, c boolean")
    out = joins.spine_join("k", [(a, {"a": "a_out"}), (b, {"b": "b"})], [(c, {"c": "c"})])
    assert rows(out) == [("k1", 1, None, True), ("k2", 2, "x", None), ("k3", None, "y", None)]
    got = joins.entity_outer_join("k", {"a": (a.filter("k <> ''"), ["a"]), "b": (b, ["b"])}, c, ["c"])
    assert rows(got, "k", "a", "b", "has_a", "has_b", "c") == [
        ("k1", 1, None, True, False, True), ("k2", 2, "x", True, True, None), ("k3", None, "y", False, True, None)
    ]


def test_small_measures(spark):
    df = spark.createDataFrame([("x", 2, 1.0), ("x", 3, None), ("y", None, None)], "g string, n long, w double")
    assert rows(df.groupBy("g").agg(M.sum_or_null("n"), M.weighted_average("n", "w"))) == [("x", 5, 2.0), ("y", None, None)]
    cells = spark.createDataFrame([(1, "ALL", 9), (1, "a", 4), (2, "a", 5)], "y int, m string, v long")
    derived = cells.filter("m <> 'ALL'").select("y", "v")
    assert rows(M.self_lookup_total(derived, cells, ["y"], F.col("m") == "ALL", "v", "total")) == [(1, 4, 9), (2, 5, None)]
    names = spark.createDataFrame([("a b c", 3), ("a b", 1), ("z", 0), ("q r", 2)], "f string, o int")
    assert [tuple(r) for r in M.token_pattern_top_k(names, "f", "o", 2).collect()] == [("a b", 2, 1), ("z", 1, 0)]
    flags = spark.createDataFrame([(True, False, 1), (True, True, None), (False, False, 1)], "p boolean, q boolean, g int")
    assert rows(M.match_rate(flags, ["p", "q"], F.col("g").isNotNull()), "source", "rate_text") == [("p", "1/2 (50.0%)"), ("q", "0/1 (0.0%)")]
    text = spark.createDataFrame([("2024.0", "12,0", "7,5", " ")], "year string, n string, a string, b string")
    assert rows(M.typed_entity_rows(text, "year", "n", {"x": "a", "z": "b"})) == [(2024, 12, 8, None)]


CROSSWALK = [
    (1, "Sandgerðisbær", "Suðurnesjabær", "harmonized", "former"), (2, "Grímsnes- og Grafningshreppur", "Grímsnes", "unchanged", None),
    (3, "Garðabær", "Garðabær", "unchanged", "first"), (4, "GARÐABÆR!", "Other", "unchanged", "second"),
    (5, "Sandgerðisbær", "Later", "needs_review", "again"), (6, " ", "Blank", "unchanged", ""),
]


def test_harmonize_tiers(spark):
    cw = spark.createDataFrame(CROSSWALK, "o int, src string, name string, status string, notes string")
    names = ["Sandgerðisbær ", "Grímsnes— og Grafningshreppur", "garðabær", "Dash–x", "Nowhere", ""]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    out = H.harmonize(df, "n", cw, ["src", "name", "status", "notes"], "o", ["h", "s", "t"], variants={"Dash–x": ("X", "harmonized", "listed")}, folded_note="folded.", carried_note="kept")
    assert rows(out, "i", "h", "s", "t") == [
        (0, "Later", "needs_review", "again"), (1, "Grímsnes", "unchanged", "folded."), (2, "Garðabær", "unchanged", "folded. first"),
        (3, "X", "harmonized", "listed"), (4, "Nowhere", "unchanged", "kept"), (5, "", "unchanged", "kept"),
    ]
    exact = H.lookup_exact(df, "n", cw, ["src", "name", "status", "notes"], "o", ["h", "s", "t"], carried_note="kept")
    assert rows(exact, "i", "h", "s", "t")[2:] == [(2, "garðabær", "unchanged", "kept"), (3, "Dash–x", "unchanged", "kept"), (4, "Nowhere", "unchanged", "kept"), (5, None, None, None)]


def test_overrides(spark):
    schema = "k string, a string, b string, o int"
    defaults = spark.createDataFrame([("x", "da", "db", 0), ("y", "da", "db", 0)], schema)
    edited = spark.createDataFrame([("x", "ea", "", 1), ("z", "", "eb", 2), ("  ", "no", "no", 3)], schema)
    assert rows(H.override_rows(defaults, edited, "k", "o")) == [("x", "ea", ""), ("y", "da", "db"), ("z", "", "eb")]
    assert rows(H.override_fields(defaults, edited, "k", "o")) == [("x", "ea", "db"), ("y", "da", "db"), ("z", None, "eb")]
    manual = spark.createDataFrame([("x", "x", "g", "matched"), ("w", "w", "", "OK"), ("v", "v", "", "")], "k string, f string, g string, s string")
    assert rows(H.accepted_overrides(manual, "s", "g"), "k") == [("x",)]
    open_names = spark.createDataFrame([("x", "x"), ("u", "u")], "k string, f string")
    assert rows(H.review_template(manual, open_names, "k", "f", ["g", "s"]), "k", "s") == [("u", None), ("w", "OK"), ("x", "matched")]
