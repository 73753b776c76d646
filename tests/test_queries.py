"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from hazeline.plans.oracle import ORACLE
from hazeline.plans.queries import QUERIES
from tests.compare import DATA, connect, difference

SMALL = DATA / "sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not SMALL.exists():
        pytest.skip("no test data here")
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(SMALL))
    assert difference(df, duck, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark, duck):
    assert contract.entry(spark).count() > 0


def test_comparison_notices_differences(spark, duck):
    df = spark.sql("select 1 as a, 2.0D as b")
    assert difference(df, duck, "select 1 as a, cast(2 as double) as b") is None
    assert difference(df, duck, "select 1 as a, cast(3 as double) as b") is not None
    assert difference(df, duck, "select 1 as a, cast(2 as double) as c") is not None
    assert difference(df, duck, "select 1 as a, 2 as b") is not None
    assert difference(df, duck, "select 1 as a, cast(2 as double) as b where false") is not None
