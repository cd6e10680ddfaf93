"""Every registered query against its SQL on the smallest sample tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from orgmetrics.queries import ORACLES, QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert name in ORACLES
    assert differences(ours, sql.sql(ORACLES[name]).to_arrow_table()) == []


# Queries with lookups or upserts take other plans when nothing can be broadcast.
SHUFFLED = [
    "section_report",
    "country_trend",
    "organiser_links",
    "unknown_organisers",
    "cause_coverage",
    "link_by_name",
    "missing_causes",
    "fk_orphans",
    "fk_set_null",
    "fk_update_cascade",
    "fk_delete_cascade",
    "upsert_sections",
    "upsert_activities",
    "upsert_affected",
    "insert_ignore_links",
    "replace_links",
    "slug_reachable",
    "stats_causes",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_equals_sql_without_broadcast(spark, no_broadcast, sql, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert differences(ours, sql.sql(ORACLES[name]).to_arrow_table()) == []


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_registry_loads_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], timeout=120)
    assert done.returncode == 0


def test_registry_loads_without_an_optional_library():
    code = (
        "import sys; sys.modules['sentencepiece'] = None; import warnings; warnings.simplefilter('ignore'); "
        "import __spark_entry__ as e; assert len(e.queries()) > 100 and 'pipeline' not in e.queries()"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], timeout=120)
    assert done.returncode == 0
