import __spark_entry__ as entry


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns[0] == "name"
