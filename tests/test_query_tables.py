"""Registered queries on small tables made here, where the sample's rows show nothing."""

from __future__ import annotations

from orgmetrics.queries import QUERIES
from orgmetrics.queries.tables import SCHEMAS
from tests.conftest import rows


def put(spark, folder, name, given):
    """A table of ``SCHEMAS``; ``given`` are dicts, other columns are NULL."""
    schema = spark.createDataFrame([], SCHEMAS[name]).schema
    made = [tuple(g.get(f) for f in schema.names) for g in given]
    spark.createDataFrame(made, schema).write.parquet(f"{folder}/{name}.parquet")


def test_all_namesakes_are_linked(spark, tmp_path):
    """One name in fifty, whatever the distance of the numbers; stored sections alone."""
    suppliers = [(k, 1.0) for k in (3, 53, 103, 2, 4, 54)] + [(153, -1.0)]
    put(spark, tmp_path, "nation", [{"n_nationkey": 0, "n_name": "X", "n_regionkey": 0}])
    put(spark, tmp_path, "supplier", [
        {"s_suppkey": k, "s_name": f"Supplier#{k}", "s_nationkey": 0, "s_acctbal": b} for k, b in suppliers
    ])
    given = [(1, 3), (1, 53), (2, 153), (3, 4), (3, 4)]
    put(spark, tmp_path, "lineitem", [{"l_orderkey": o, "l_suppkey": s} for o, s in given])
    found = rows(QUERIES["organiser_links"](spark, str(tmp_path)))
    assert found == sorted([(o, s) for o in (1, 2) for s in (3, 53, 103)] + [(3, 4), (3, 54)], key=str)
