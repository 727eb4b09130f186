import __spark_entry__ as entry


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 80


def test_entry_runs(spark):
    assert entry.entry(spark).limit(5).count() == 5
