import __spark_entry__ as entry


def test_registry_is_complete():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 30


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["question_id", "rank", "file_path", "first_character_index",
                          "last_character_index", "score"]
    assert df.count() > 0
