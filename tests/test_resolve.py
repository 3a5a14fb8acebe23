import itertools
import random
from decimal import ROUND_HALF_EVEN, Decimal
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from helpers import jobs_of, rows
from tallyweave import constants as K
from tallyweave.operators import resolve as R
from tallyweave.operators import similarity
from tallyweave.operators.similarity import best_entries, pairs_looked_at, similar_pairs
from tallyweave.queries import name_queries


def _names(seed, count, alphabet="abcd ", longest=14):
    random.seed(seed)
    made = {"".join(random.choice(alphabet) for _ in range(random.randint(1, longest))).strip() for _ in range(count)}
    base = ["grunnskoli hellu", "grunnskoli holmavik", "grunnskolinn hellu", "akurskoli", "akraskoli", "akurskoli ii", "ab", "acb", "a"]
    return sorted((made | set(base)) - {""})


def _check(spark, left, right, threshold):
    a, b = (spark.createDataFrame([(t,) for t in side], "text string") for side in (left, right))
    got = {(r["a"], r["b"]): r["score"] for r in similar_pairs(a, b, threshold).collect()}
    expected = {}
    for x, y in itertools.product(left, right):
        score = SequenceMatcher(None, x, y).ratio()
        if score >= threshold:
            expected[(x, y)] = score
    assert got == expected
    return len(expected)


@pytest.mark.parametrize("threshold", [0.6, 0.7, 0.78, 0.95])
def test_similarity_join_loses_nothing(spark, threshold):
    assert _check(spark, _names(1, 120), _names(2, 120), threshold) > 0


def test_similarity_join_on_tiny_and_long_strings(spark):
    tiny = ["".join(p) for n in (1, 2, 3) for p in itertools.product("ab", repeat=n)]
    _check(spark, tiny, tiny, 0.78)
    random.seed(3)
    text = "".join(random.choice("abcdefghij ") for _ in range(400)).strip()
    edited = text[:100] + "xyz" + text[130:]
    _check(spark, [text, edited, text[::-1]], [edited, text], 0.78)


def test_small_blocks_and_places(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 9)
    left, right = _names(7, 90), _names(8, 110)
    _check(spark, left, right, 0.7)
    a, b = (spark.createDataFrame([(t, i % 3) for i, t in enumerate(side)], "text string, place_no int") for side in (left, right))
    got = {(r["a"], r["b"]) for r in similar_pairs(a, b, 0.7, within="place_no").collect()}
    want = {(x, y) for i, x in enumerate(left) for j, y in enumerate(right) if i % 3 == j % 3 and SequenceMatcher(None, x, y).ratio() >= 0.7}
    assert got == want
    assert similar_pairs(a, b, 1.5).count() == 0


def _wide_names(spark, folder="/root/testdata/sf0.01"):
    """Part names with type and brand, which grow with the table."""
    part = spark.read.parquet(f"{folder}/part.parquet")
    return sorted(r[0] for r in part.select(F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))).distinct().collect())


def _misspelled(names, seed):
    pick = random.Random(seed)
    out = []
    for name in names:
        at = pick.randrange(len(name))
        out.append(name[:at] + pick.choice("xyz") + name[at + 1 :])
    return out


def _entry_tables(spark, left, right):
    a = spark.createDataFrame([(t,) for t in left], "text string")
    b = spark.createDataFrame([(t, [(t.title(), "g")]) for t in right], "text string, entries array<struct<canonical:string,`group`:string>>")
    return a, b


def test_pairs_looked_at_grow_slower_than_the_square(spark):
    names = _wide_names(spark)
    looked = []
    for count in (400, 800, 1600):
        right = random.Random(1).sample(names, count)
        a, b = _entry_tables(spark, _misspelled(right, 2)[::4], right)
        found = pairs_looked_at(a, b, K.SIMILARITY_REVIEW, 5).first()
        assert found["possible"] == len(set(_misspelled(right, 2)[::4])) * count
        looked.append(found["looked_at"])
    # Twice the names on both sides are four times the pairs.
    assert looked[1] < 3.8 * looked[0] and looked[2] < 3.4 * looked[1] and looked[2] < 0.75 * found["possible"]


@pytest.mark.parametrize("pivots, block", [(32, 2_000), (5, 7)])
def test_best_entries_against_all_pairs(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(similarity, "PIVOTS", pivots)
    monkeypatch.setattr(similarity, "BLOCK", block)
    monkeypatch.setattr(similarity, "STRINGS_A_PIVOT", 10)
    right = _names(11, 150) + random.Random(2).sample(_wide_names(spark), 120)
    left = _names(12, 60) + _misspelled(right[-60:], 4)
    a, _ = _entry_tables(spark, left, [])
    # Some entries have several spellings, some spellings several entries.
    entries = {t: sorted({(f"N{i % 97}", "g"), (f"N{i % 89}", "h")}) for i, t in enumerate(right)}
    b = spark.createDataFrame(list(entries.items()), "text string, entries array<struct<canonical:string,`group`:string>>")
    found = best_entries(a, b, 0.7, 4).withColumn("score", F.bround("score", 3)).groupBy("a", "canonical", "group").agg(F.max("score").alias("score"))
    got = {tuple(r) for r in R.rank_candidates(found, "a", 4).select("a", "rank", "canonical", "group", "score").collect()}
    want = set()
    for x in set(left):
        best = {}
        for t, e in entries.items():
            score = SequenceMatcher(None, x, t).ratio()
            for name in e if score >= 0.7 else ():
                best[name] = max(best.get(name, 0), score)
        rounded = sorted((-_bround(s), name) for name, s in best.items())
        want |= {(x, i + 1, *name, -s) for i, (s, name) in enumerate(rounded[:4])}
    assert got == want and len(want) > 100


def _bround(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.001"), ROUND_HALF_EVEN))


def test_building_a_resolution_starts_no_job(spark):
    folder = "/root/testdata/sf0.001"
    for query in (name_queries.q_resolve, name_queries.q_resolution_audit, name_queries.q_similarity_top5):
        assert jobs_of(spark, lambda: query(spark, folder)) == 0


RULES = R.NameRules(magnitude={"vikurskoli": "North"}, count_keys={("vikurskoli", "South"): "vikurskoli sud"})
REGISTER = [
    ("Akurskóli", "East"), ("Brekkuskóli", "East"), ("Brekkuskóli", "West"), ("Grunnskóli Hellu", "South"),
    ("Víkurskóli", "North"), ("Víkurskóli", "South"), ("Hamraborgarskóli", "West"), ("Laugarnesskoli", "North"), ("Laugarnesskolj", "South"),
    ("Reykjanesskoli", "East"),
]


@pytest.fixture(scope="module")
def resolved(spark):
    universe = [
        ("Akurskóli", True, False), ("Heild", True, False), ("Brekkuskóli", True, False), ("Grunnskólinn á Hellu", False, True),
        ("Víkurskóli", True, False), ("Hamraborgarskóla", True, False), ("Laugarnesskola", True, True), ("Skóli Akureyri", True, False),
        ("Handmade", True, False), ("Qqq", False, True), ("Qqq www", False, True), ("Reykjanesskolj akureyri", False, True),
    ]
    df = spark.createDataFrame(universe, "name string, in_a boolean, in_b boolean")
    register = spark.createDataFrame(REGISTER + REGISTER[:2], "canonical string, `group` string")
    manual = spark.createDataFrame([("Handmade", "Akurskóli", "East", "by hand")], "name string, canonical string, `group` string, note string")
    weights = spark.createDataFrame([("Víkurskóli", 50), ("Brekkuskóli", 5)], "name string, weight bigint")
    counts = R.latest_counts(
        spark.createDataFrame([("Víkurskóli", "2023", "9", 1), ("Víkurskóli", "2024", "48", 2), ("Víkurskóli suð", "2024", "6", 3), ("Akurskóli", "x", "5", 4)],
                              "n string, y string, c string, o int"), "n", "y", "c", "o", RULES)
    return R.resolve_entities(df, ["in_a", "in_b"], ["in_a"], register, manual, RULES, weights, counts)


def test_every_branch(resolved):
    got = {r["name"]: (r["match_status"], r["canonical"], r["group"], r["match_confidence"], r["priority"]) for r in resolved.names.collect()}
    assert got["Akurskóli"] == (K.MATCHED_EXACT, "Akurskóli", "East", "1.000", K.REQUIRED)
    assert got["Heild"] == (K.EXCLUDED, None, None, "1.000", K.EXCLUDED)
    assert got["Grunnskólinn á Hellu"] == (K.MATCHED_RULE, "Grunnskóli Hellu", "South", "1.000", K.REFERENCE_ONLY)
    assert got["Víkurskóli"] == (K.MATCHED_RULE, "Víkurskóli", "North", "0.950", K.REQUIRED)
    assert got["Handmade"][:3] == (K.MATCHED_MANUAL, "Akurskóli", "East")
    score = SequenceMatcher(None, "hamraborgarskola", "hamraborgarskoli").ratio()
    assert score < 0.95 and got["Hamraborgarskóla"] == (K.NEEDS_MANUAL_REVIEW, None, None, f"{score:.3f}", K.REQUIRED)
    # Owned by two groups with the same name: exact and alias must not accept it.
    assert got["Brekkuskóli"][0] == K.NEEDS_MANUAL_REVIEW
    assert got["Skóli Akureyri"][:3] == (K.MATCHED_GROUP_ONLY, None, "Akureyrarkaupstaður")
    assert got["Qqq"] == (K.NEEDS_MANUAL_REVIEW, None, None, None, K.REFERENCE_ONLY)


def test_size_evidence(resolved):
    note = resolved.names.filter("name = 'Víkurskóli'").first()["size_note"]
    assert note == "observed count 50 is nearer to 48 than to 6, the next namesake"


def test_queues_and_audit(resolved):
    required = R.review_queue(resolved, K.REQUIRED, ["in_a"])
    assert {r["name"] for r in required.collect()} == {"Brekkuskóli", "Hamraborgarskóla", "Laugarnesskola"}
    brekku = required.filter("name = 'Brekkuskóli'").first()
    assert (brekku["possible_match_1_group"], brekku["possible_match_2_group"], brekku["possible_match_1_score"]) == ("East", "West", 1.0)
    other = R.review_queue(resolved, K.REFERENCE_ONLY, [])
    assert all(r["note"].endswith("not needed downstream") for r in other.collect())
    audit = {(r["section"], r["dataset"], r["item"]): r["value"] for r in R.resolution_audit(resolved, ["in_a", "in_b"]).collect()}
    assert audit[("summary", "", "total_names")] == "12"
    assert audit[("match_rate_by_source", "in_a", "matched_non_excluded")] == "4/7 (57.1%)"
    assert audit[("common_unmatched_patterns", "", "qqq")] == "1"


def test_acceptance(spark):
    df = spark.createDataFrame(
        [(0.96, None, "g", None), (0.96, 0.93, "g", None), (0.99, 0.95, "g", None), (0.94, None, "g", None), (0.99, None, "g", "h"), (0.99, None, "g", "g"), (None, None, None, None)],
        "first_score double, second_score double, first_group string, hint string",
    )
    got = [r[0] for r in df.select(R.similarity_accepted(F.col("hint"))).collect()]
    assert got == [True, False, True, False, False, True, False]


def test_presence_and_weights(spark):
    a = spark.createDataFrame([("x",), (" x ",), ("",), ("y",)], "n string")
    b = spark.createDataFrame([("y",), (None,)], "n string")
    assert rows(R.presence_matrix({"in_a": (a, "n"), "in_b": (b, "n")})) == [("x", True, False), ("y", True, True)]
    w = spark.createDataFrame([("x", "5", 1), ("x", "7", 2), ("y", "n/a", 3)], "n string, v string, o int")
    names = spark.createDataFrame([("x",), ("y",)], "name string")
    assert rows(R.attach_weight(names, "name", w, "n", "v", "o")) == [("x", 7), ("y", None)]
