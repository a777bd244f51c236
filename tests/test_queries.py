"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import DATA, connect, difference

SF_DIR = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, db, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        assert len(got) > 0
    else:
        assert difference(got, db.execute(oracle).df()) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns
