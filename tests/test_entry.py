import __spark_entry__ as driver
from vacanta.plans.oracles import ORACLES
from vacanta.plans.queries import QUERIES


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.columns == ["search_city", "postings", "lowest", "highest"]
    assert df.count() == 20  # 1,500 pages are 100 tasks: 5 keywords in 20 areas


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert all(callable(q) for q in driver.queries().values())
