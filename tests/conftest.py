from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hazeline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tests",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    yield session
    session.stop()


def rows(df):
    """Rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def frame(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
