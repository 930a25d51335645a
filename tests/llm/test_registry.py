import __spark_entry__ as entry


def test_eleven_queries():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
