"""Tables of versions, incremental upserts, retention by day, bulk inserts and what they survive."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orgmetrics import schemas
from orgmetrics.operators import constraints, joins, upsert, validation
from orgmetrics.operators.validation import Ruleset
from orgmetrics.plans.retention import expire_logs, log_table
from orgmetrics.plans.revalidation import revalidation_run
from orgmetrics.schemas import PAGE_DDL, Table
from orgmetrics.session import shared_dir
from orgmetrics.sources.tables import bulk_insert, conform
from orgmetrics.sources.versions import VersionedTable, bucket_of, compact
from orgmetrics.streaming.incremental import ingest_upserts
from tests.conftest import rows
from tests.test_runs import card, card_rules, extract

COLUMNS = "id bigint, slug string, n int, created_at timestamp_ntz, updated_at timestamp_ntz"
AS_OF = dt.datetime(2024, 1, 1)


def as_of(day: int = 1):
    return F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz")


def new_table(tmp_path, buckets=4):
    return VersionedTable(str(tmp_path / "table"), COLUMNS, bucket_of(["slug"], buckets))


def batch(spark, *pairs):
    return spark.createDataFrame([(s, n, i) for i, (s, n) in enumerate(pairs)], "slug string, n int, at int")


def put(table, source, token, day=1):
    return table.upsert(source, token, ["slug"], ["n"], as_of(day), ["at"], id_column="id")


def test_upserts_commit_versions(spark, tmp_path):
    table = new_table(tmp_path)
    assert table.read(spark).collect() == [] and table.version(spark).number == 0
    assert put(table, batch(spark, ("a", 1), ("b", 2), ("a", 3)), "0")
    assert rows(table.read(spark).select("slug", "n")) == [("a", 3), ("b", 2)]
    ids = {r["slug"]: r["id"] for r in table.read(spark).collect()}
    assert sorted(ids.values()) == [1, 2]
    assert put(table, batch(spark, ("b", None), ("c", 4)), "1", day=2)
    found = {r["slug"]: r for r in table.read(spark).collect()}
    assert {s: r["n"] for s, r in found.items()} == {"a": 3, "b": None, "c": 4}
    assert {**ids, "c": 3} == {s: r["id"] for s, r in found.items()}
    assert (found["b"]["created_at"].day, found["b"]["updated_at"].day, found["a"]["updated_at"].day) == (1, 2, 1)
    # The version before can still be read.
    assert rows(table.read(spark, number=1).select("slug", "n")) == [("a", 3), ("b", 2)]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = new_table(tmp_path)
    assert put(table, batch(spark, ("a", 1)), "0")
    before = rows(table.read(spark))
    assert not put(table, batch(spark, ("a", 99), ("z", 1)), "0", day=5)
    assert rows(table.read(spark)) == before and table.version(spark).number == 1


def test_a_crash_between_the_writes_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = new_table(tmp_path)
    assert put(table, batch(spark, ("a", 1)), "0")
    make = type(spark).createDataFrame

    def dies(self, data, *args, **kwargs):
        if isinstance(data, list) and data and len(data[0]) == 5:
            raise RuntimeError("lost before the list was written")
        return make(self, data, *args, **kwargs)

    source = batch(spark, ("a", 2), ("b", 1))
    monkeypatch.setattr(type(spark), "createDataFrame", dies)
    with pytest.raises(RuntimeError):
        put(table, source, "1")
    monkeypatch.undo()
    assert rows(table.read(spark).select("slug", "n")) == [("a", 1)]
    assert put(table, source, "1")
    assert rows(table.read(spark).select("slug", "n")) == [("a", 2), ("b", 1)]
    assert sorted(r["id"] for r in table.read(spark).collect()) == [1, 2]


def test_only_touched_parts_are_read_and_written(spark, tmp_path):
    table = new_table(tmp_path, buckets=8)
    assert put(table, batch(spark, *((f"s{i}", i) for i in range(200))), "0")
    first = table.version(spark).folders
    assert len(first) == 8
    assert put(table, batch(spark, ("s7", 700)), "1")
    second = table.version(spark).folders
    assert sum(first[p] != second[p] for p in first) == 1
    opened = {Path(f).parent.name + Path(f).parent.parent.name for f in table.read(spark).inputFiles()}
    assert opened == {f"part={p}" + second[p] for p in second}
    one = table.read(spark, ["3"])
    assert all("part=3" in f for f in one.inputFiles())
    plan = table.read(spark).filter("part = '3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_compaction_keeps_the_rows(spark, tmp_path):
    table = new_table(tmp_path)
    for i in range(3):
        assert put(table, batch(spark, (f"k{i}", i), ("same", i)), str(i))
    before = rows(table.read(spark))
    assert compact(table, spark, "compaction")
    assert rows(table.read(spark)) == before
    assert len(set(table.version(spark).folders.values())) == 1
    assert table.version(spark).last_id == 4
    assert table.unlisted(spark) and not set(table.unlisted(spark)) & set(table.version(spark).folders.values())
    assert put(table, batch(spark, ("new", 1)), "3")
    assert sorted(r["id"] for r in table.read(spark).collect()) == [1, 2, 3, 4, 5]


def test_ingest_upserts_every_batch_once(spark, tmp_path):
    landed = str(tmp_path / "landed")
    columns = "event_slug string, url string, page_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
    key = ["event_slug"]

    def ingest(name, **options):
        state = f"{shared_dir(spark)}/{name}"
        table = VersionedTable(f"{state}/table", columns, bucket_of(key, 4))
        ingest_upserts(
            spark, landed, state, extract, card_rules(), table, key, ["url", "page_id"], ["page_id", "position"],
            as_of(), **options,
        )
        return rows(table.read(spark).select("event_slug", "page_id")), table.version(spark).number

    def land(*pages):
        spark.createDataFrame(list(pages), PAGE_DDL).coalesce(1).write.mode("append").parquet(landed)

    name = uuid.uuid4().hex
    land((0, "u0", f"<html>{card('a')}{card('b')}</html>"), (1, "u1", "broken"))
    assert ingest(name) == ([("a", 0), ("b", 0)], 1)
    land((2, "u2", f"<html>{card('b')}{card('c!')}</html>"))
    assert ingest(name) == ([("a", 0), ("b", 2)], 2)
    assert ingest(name) == ([("a", 0), ("b", 2)], 2)
    assert ingest(uuid.uuid4().hex, files_per_batch=1) == ([("a", 0), ("b", 2)], 2)


def test_retention_rewrites_one_day(spark, tmp_path):
    stamps = [None, *(dt.datetime(2024, 1, d, h) for d in range(1, 11) for h in (1, 13))]
    table = schemas.VALIDATION_ERRORS
    found = spark.createDataFrame([(i, "m", s) for i, s in enumerate(stamps)], "id bigint, error_message string, created_at timestamp_ntz")
    log = log_table(str(tmp_path / "log"), table)
    assert log.commit(spark, "landed", conform(found, table))
    before = log.version(spark).folders
    assert len(before) == 11
    expire_logs(spark, {table.name: log}, "2024-02-04 06:00:00", "run-1")
    kept = [s for s in stamps if s is None or s >= dt.datetime(2024, 1, 5, 6)]
    assert sorted(map(str, (r["created_at"] for r in log.read(spark).collect()))) == sorted(map(str, kept))
    after = log.version(spark).folders
    assert set(before) - set(after) == {f"2024-01-0{d}" for d in range(1, 5)}
    assert [p for p in after if after[p] != before[p]] == ["2024-01-05"]
    # The same run again, and one whose day is gone.
    expire_logs(spark, {table.name: log}, "2024-02-04 06:00:00", "run-1")
    assert log.version(spark).number == 2
    expire_logs(spark, {table.name: log}, "2025-01-01 00:00:00", "run-2")
    assert [r["created_at"] for r in log.read(spark).collect()] == [None]


def test_a_day_without_rows_left_goes(spark, tmp_path):
    table = schemas.FAILED_SCRAPES
    found = spark.createDataFrame([("u", dt.datetime(2024, 1, 5, 1))], "url string, last_attempt timestamp_ntz")
    log = log_table(str(tmp_path / "log"), table)
    log.commit(spark, "landed", conform(found, table))
    expire_logs(spark, {table.name: log}, "2024-02-04 06:00:00", "run")
    assert log.version(spark).folders == {} and log.read(spark).collect() == []


def test_bulk_insert_is_repeatable_and_sized(spark, tmp_path):
    path = str(tmp_path / "bulk")
    some = spark.range(1000).withColumn("extra", F.lit(1))
    bulk_insert(some, path, "one", ["id"], rows_per_file=300)
    bulk_insert(some, path, "one", ["id"], rows_per_file=300)
    found = bulk_insert(spark.range(5), path, "two")
    assert found.columns == ["id"] and found.count() == 1005
    assert len(list(Path(path, "batch=one").glob("*.parquet"))) >= 4
    with pytest.raises(ValueError):
        bulk_insert(some, path, "../x")


def test_upsert_returning_agrees_with_the_version(spark, tmp_path):
    target = spark.createDataFrame([(7, "a", 1, AS_OF, AS_OF), (3, "b", 2, AS_OF, AS_OF)], COLUMNS)
    source = batch(spark, ("b", 20), ("c", 30), ("d", None)).drop("at")
    version, written = upsert.upsert_returning(
        target, source, ["slug"], ["n"], as_of(9), str(tmp_path / "v"), id_column="id"
    )
    assert rows(written.select("slug", "n", "action")) == [("b", 20, "updated"), ("c", 30, "inserted"), ("d", None, "inserted")]
    whole = {r["slug"]: r for r in version.collect()}
    assert {s: r["id"] for s, r in whole.items() if s in "ab"} == {"a": 7, "b": 3}
    assert sorted(whole[s]["id"] for s in "cd") == [8, 9]
    for r in written.drop("action").collect():
        assert r == whole[r["slug"]]
    assert whole["a"]["updated_at"] == AS_OF and whole["b"]["updated_at"].day == 9
    assert rows(version) == rows(upsert.upsert(target, source, ["slug"], ["n"], as_of(9), id_column="id"))


# --- constraints and projections


def test_constraints_count_what_breaks_them(spark):
    table = Table(
        "t", "k bigint", ("k",), not_null=("a",), longest=(("a", 2),), checks=(("n >= 0", "n >= 0"),),
        unique=(("a", "n"),), references=(("p", "parent", "id"),),
    )
    parent = Table("parent", "id bigint", ("id",))
    given = spark.createDataFrame(
        [(1, "x", 1, 1), (1, "abc", -1, 2), (None, None, None, None), (2, "x", 1, 9), (3, "é😀", 0, 9), (4, "x", None, 1)],
        "k bigint, a string, n int, p bigint",
    )
    report = constraints.constraint_report({"t": given, "parent": spark.range(1, 3)}, {"t": table, "parent": parent})
    found = {(r["table_name"], r["rule"]): r["n_bad"] for r in report.collect()}
    assert found == {
        ("t", "k NOT NULL"): 1, ("t", "a NOT NULL"): 1, ("t", "a AT MOST 2"): 1, ("t", "CHECK n >= 0"): 1,
        ("t", "UNIQUE (k)"): 1, ("t", "UNIQUE (a, n)"): 1, ("t", "p REFERENCES parent (id)"): 2,
        ("parent", "id NOT NULL"): 0, ("parent", "UNIQUE (id)"): 0,
    }
    assert {r["n_rows"] for r in report.collect()} == {6, 2}
    broken = {r["k"]: r["broken"] for r in constraints.violations(given, table).collect()}
    assert broken == {1: ["a AT MOST 2", "CHECK n >= 0"], None: ["k NOT NULL", "a NOT NULL"]}


def test_every_stored_table_has_its_rules(spark):
    empty = {n: spark.createDataFrame([], t.schema) for n, t in schemas.TABLES.items()}
    report = constraints.constraint_report(empty, schemas.TABLES).collect()
    assert {r["table_name"] for r in report} == set(schemas.TABLES)
    assert all(r["n_bad"] == r["n_rows"] == 0 for r in report)


def test_create_projections_follow_the_schema(spark):
    given = spark.createDataFrame([("tr-a", "A", 5)], "accounts_platform_slug string, name string, id bigint")
    made = constraints.create_projection(given, schemas.SECTIONS)
    assert set(made.columns) == set(schemas.SECTIONS.schema.names) - set(schemas.SECTIONS.generated)
    zero = constraints.create_projection(spark.range(1).select(F.col("id").alias("section_id")), schemas.OVERALL_STATISTICS)
    assert zero.first()["online_activities"] == 0


# --- re-validation


def test_revalidation_writes_back_what_changed(spark):
    stored = spark.createDataFrame(
        [(1, "", False, AS_OF), (2, "fine", False, AS_OF), (3, "", True, AS_OF), (4, "x" * 20, False, AS_OF)],
        "id bigint, name string, is_valid boolean, updated_at timestamp_ntz",
    )
    known = spark.createDataFrame(
        [(1, "name", "shorter than 1"), (1, "name", "shorter than 1"), (2, "name", "missing"), (3, "name", "old"), (4, "name", "missing")],
        "id bigint, field_name string, error_message string",
    )
    run = revalidation_run(stored, known, validation.lookup_rules(10), "id", as_of(3), ["name"])
    assert rows(run.changes) == [
        (1, "name", "shorter than 1", "kept"),
        (2, "name", "missing", "cleared"),
        (4, "name", "longer than 10", "new"),
        (4, "name", "missing", "cleared"),
    ]
    found = {r["id"]: r for r in run.rows.collect()}
    assert {k: r["is_valid"] for k, r in found.items()} == {1: False, 2: True, 3: True, 4: False}
    assert found[3]["updated_at"] == AS_OF and found[2]["updated_at"].day == 3
    assert rows(run.errors.select("activity_event_slug", "error_message")) == [("4", "longer than 10")]


def test_strict_dates_report_their_errors(spark):
    from orgmetrics.functions.dates import parse_event_date_strict

    given = spark.createDataFrame([("2023-11-08", "a"), ("31/02/2023", ""), (None, "b"), (" ", "c")], "start_date string, name string")
    parsed = parse_event_date_strict(F.col("start_date"))
    found = given.select(parsed.alias("d")).select("d.*").collect()
    assert [tuple(r) for r in found] == [(dt.date(2023, 11, 8), None), (None, "not a date"), (None, "missing"), (None, "missing")]
    checked = validation.validate(given, Ruleset({}, [("name", [(F.col("name") == "", "empty")])]))
    merged = validation.with_parse_errors(checked, {"start_date": parsed})
    assert [[e["field_name"] for e in r["errors"]] for r in merged.collect()] == [[], ["name", "start_date"], ["start_date"], ["start_date"]]
    assert [r["is_valid"] for r in merged.collect()] == [True, False, False, False]


# --- hot keys


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(spark, no_broadcast, how):
    n = 3000
    key = F.when(F.col("id") < n / 3, 7).when(F.col("id") < 2 * n / 3, None).otherwise(F.col("id") % 50)
    facts = spark.range(n).select(key.alias("k"), "id")
    dim = facts.filter("k < 30").groupBy("k").agg(F.count("*").alias("v"))
    assert rows(joins.salted_join(facts, dim, "k", how)) == rows(facts.join(dim, "k", how))


def test_salted_join_spreads_a_hot_key(spark, no_broadcast):
    """Half of the rows have one key and the other side is aggregated on it: no task gets the key whole."""
    facts = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def largest(joined):
            sizes = joined.groupBy(F.spark_partition_id()).count().select("count").collect()
            sizes = sorted(r["count"] for r in sizes)
            return sizes[-1] / sizes[len(sizes) // 2]

        assert largest(facts.join(counts, "k")) > 3
        assert largest(joins.salted_join(facts, counts, "k", shares=64)) < 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_assembled_statistics_are_one_pass(spark):
    from orgmetrics.queries import QUERIES

    plan = QUERIES["stats_assembled"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # Line items, parts and orders, each read once.
    assert plan.count("Relation [") == 3


def test_unique_rules_group_once(spark, no_broadcast):
    """Rows that are distinct already are not grouped by their key a second time."""
    table = Table("t", "a bigint, b bigint", ("a", "b"))
    given = spark.range(100).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b")).distinct()
    report = constraints.constraint_report({"t": given}, {"t": table}).filter("rule LIKE 'UNIQUE%'")
    assert [(r["n_bad"], r["n_rows"]) for r in report.collect()] == [(0, 35)]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[a#\d+L, b#\d+L\], \[.*count\(1\)", plan)


def test_unique_rules_count_repeats_with_nulls(spark):
    table = Table("t", "a bigint, b bigint", ("a", "b"))
    given = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (1, None), (1, None), (None, None), (2, 1)], "a bigint, b bigint")
    report = constraints.constraint_report({"t": given}, {"t": table}).collect()
    assert {r["rule"]: r["n_bad"] for r in report}["UNIQUE (a, b)"] == 2


def test_error_changes_group_once(spark):
    """Repeats of either side count once, without groupings of their own."""
    ddl = "id bigint, field_name string, error_message string"
    before = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", None), (1, "b", None), (2, "a", "x")], ddl)
    errors = "id bigint, errors array<struct<field_name:string,error_message:string>>"
    checked = spark.createDataFrame([(1, [("b", None), ("b", None), ("c", "z"), ("c", "z")])], errors)
    found = validation.error_changes(before, checked, "id")
    assert rows(found) == [(1, "a", "x", "cleared"), (1, "b", None, "kept"), (1, "c", "z", "new")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_a_table_without_a_key_has_no_unique_rule(spark):
    known = {"t": Table("t", "a bigint", (), unique=(("a",),)), "u": Table("u", "b bigint", ()), "v": Table("v", "b bigint", (), references=(("b", "u", "b"),))}
    one = spark.createDataFrame([(1,), (1,), (None,)], "b bigint")
    given = {"t": one.withColumnRenamed("b", "a"), "u": one, "v": spark.createDataFrame([(1,), (2,), (None,)], "b bigint")}
    report = constraints.constraint_report(given, known).collect()
    assert {(r["table_name"], r["rule"]): (r["n_bad"], r["n_rows"]) for r in report} == {
        ("t", "UNIQUE (a)"): (1, 3), ("v", "b REFERENCES u (b)"): (1, 3),
    }
