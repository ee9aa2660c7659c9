import __spark_entry__ as driver
import oracle
import pytest

from sparkrank import catalog


# Without SQL: what they find is held against exact search in test_graph.
BY_RECALL = {"approx_recall_top10", "graph_top10", "graph_then_cosine"}


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_sql(spark, con, small, name):
    assert name in catalog.SQL or name in BY_RECALL
    rows, _, problem = oracle.compare(spark, con, small, name)
    assert problem is None


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    found = driver.entry(spark)
    assert found.columns == ["query_id", "doc_id", "score", "rank"]
    assert found.count() > 0
