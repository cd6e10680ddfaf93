"""What the plans of the registered queries may and may not contain."""

from __future__ import annotations

import pytest

from orgmetrics.queries import QUERIES

SF = "/root/testdata/sf0.001"
PAGE_PARSERS = {
    "extract_countries",
    "extract_sections",
    "extract_section_details",
    "extract_activities",
    "extract_activity_links",
    "last_page_number",
    "page_chunks",
}


@pytest.fixture(autouse=True)
def whole_plan_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"incremental_ingest"}))
def test_no_cross_joins_and_no_python_outside_page_parsing(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "MapInArrow" in plan) == (name in PAGE_PARSERS)


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("retention_errors", "EqualTo(event_type,error)"),
        ("fk_delete_cascade", "Not(EqualTo(o_orderstatus,P))"),
        ("union_chunks", "EqualTo(l_returnflag,R)"),
        ("insert_ignore_links", "LessThan(l_shipdate,"),
        ("upsert_activities", "GreaterThanOrEqual(o_orderdate,"),
        ("activity_search", "EqualTo(o_orderpriority,2-HIGH)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(QUERIES[name](spark, SF))


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("format_date", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"),
        ("duplicate_keys", "struct<l_orderkey:bigint,l_suppkey:bigint>"),
        ("eligible_sections", "struct<s_suppkey:bigint,s_name:string,s_nationkey:int,s_acctbal:double>"),
    ],
)
def test_only_used_columns_are_read(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(QUERIES[name](spark, SF))


def test_queue_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["scrape_queue"](spark, SF))


def test_counts_are_combined_before_the_shuffle(spark):
    plan = plan_of(QUERIES["success_by_section"](spark, SF))
    assert plan.index("count") < plan.index("Exchange") < plan.index("partial_count")


def test_validation_evaluates_each_rule_once(spark):
    plan = plan_of(QUERIES["validate_activities"](spark, SF))
    assert plan.count("over 10000") == 1
