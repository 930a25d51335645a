"""Names of queries, with what they run and the SQL that gives the same rows."""

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    """Registers the function under its name, with SQL that runs on the same tables."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add
