"""Registered text queries against their SQL, plan rules for native ones, and the optional subpackage."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from hazeline.llm.oracle import ORACLE
from hazeline.llm.queries import QUERIES
from tests.compare import DATA, connect, difference
from tests.conftest import plan_of

SMALL = DATA / "sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not SMALL.exists():
        pytest.skip("no test data here")
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, str(SMALL)), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op2_virtual_slots", "op5_secret_spans", "op9_chat_turns"])
def test_native_queries_run_no_python(spark, duck, name):
    plan = plan_of(QUERIES[name](spark, str(SMALL)))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
