import oracle
import pytest

from wardline.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert oracle.differences(QUERIES[name](spark, sf), SQL[name], con) is None


def test_every_query_runs_and_is_registered(spark, sf):
    import __spark_entry__

    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert SQL.keys() <= __spark_entry__.oracle_sql().keys()
    assert __spark_entry__.entry(spark).columns == ["l_partkey", "records", "rejected"]
