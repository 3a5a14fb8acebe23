import os

from tallyweave.llm import common


def test_written_tables_are_removed(spark):
    kept = common.written(spark.range(3).toDF("x"))
    path = common._written[-1]
    assert kept.count() == 3 and os.path.isdir(path)
    assert common.remove_written(spark) > 0
    assert not os.path.exists(path) and common.remove_written(spark) == 0


def test_fresh_names_ignore_case(spark):
    df = spark.range(1).selectExpr("id AS A", "id AS a_")
    assert common.fresh(df, "a") == "a__" and common.fresh(df, "b") == "b"


def test_only_one_operators_tables_are_held():
    made = []

    def make(x):
        return lambda: made.append(x) or x

    assert [common.held(("k", x), make(x)) for x in (1, 1, 2, 1)] == [1, 1, 2, 1]
    assert made == [1, 2, 1]
