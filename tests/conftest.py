from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orgmetrics.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", "orgmetrics-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Both sides of every join are shuffled, as with tables too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def rows(df):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=str)
