"""Every registered query against its SQL."""

import pytest

from tests.compare import duck, duck_table, spark_table
from vacanta.plans.oracles import ORACLES
from vacanta.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    got_columns, got = spark_table(QUERIES[name](spark, sf_dir))
    want_columns, want = duck_table(con, ORACLES[name])
    assert got_columns == want_columns
    assert len(got) == len(want)
    differing = [pair for pair in zip(got, want) if pair[0] != pair[1]][:3]
    assert not differing
