import pytest

from quillon import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, same):
    same(queries.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_runs(name, spark, sf):
    queries.queries()[name](spark, sf).collect()
