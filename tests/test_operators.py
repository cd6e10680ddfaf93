from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgmetrics import schemas
from orgmetrics.functions.slugs import slugify
from orgmetrics.operators import integrity, joins, quality, retention, selection, upsert, validation
from orgmetrics.sources.tables import append_rows, conform, empty_table, write_snapshot
from tests.conftest import rows

AS_OF = dt.datetime(2024, 1, 1)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- joins


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_hot_and_missing_keys(spark, no_broadcast, how):
    """One key holds a third of the rows, another third has no key, the rest is spread."""
    n = 3000
    key = F.when(F.col("id") < n / 3, 7).when(F.col("id") < 2 * n / 3, None).otherwise(F.col("id") % 50)
    facts = spark.range(n).select(key.alias("k"), "id")
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    values = {r["k"]: r["v"] for r in dim.collect()}
    given = [(r["k"], r["id"]) for r in facts.collect()]
    expected = {
        "inner": [(k, i, values[k]) for k, i in given if k in values],
        "left": [(k, i, values.get(k)) for k, i in given],
        "left_semi": [(k, i) for k, i in given if k in values],
        "left_anti": [(k, i) for k, i in given if k not in values],
    }
    assert rows(joins.lookup_join(facts, dim, "k", how)) == sorted(expected[how], key=str)


# --- organisers


def organisers(spark):
    activities = spark.createDataFrame(
        [(1, ["Ab c", "AB-C"]), (1, ["ab c", None, "--", ""]), (2, ["x"]), (3, None), (None, ["ab c"])],
        "activity_id bigint, organisers array<string>",
    )
    sections = spark.createDataFrame(
        [(5, "ab c"), (5, "Ab-C"), (6, "AB C"), (7, "--"), (8, None), (None, "ab c"), (9, "y")], "id bigint, name string"
    )
    return activities, sections


@pytest.mark.parametrize("large", [True, False])
def test_organiser_links_are_distinct(spark, request, large):
    """Repeated activities, sections and spellings of a name give each link once; empty names give none."""
    if large:
        request.getfixturevalue("no_broadcast")
    found = rows(selection.organiser_links(*organisers(spark), slugify))
    assert found == sorted([(a, s) for a in (1, None) for s in (5, 6, None)], key=str)
    assert rows(selection.unknown_organisers(*organisers(spark), slugify)) == sorted([(1, "--"), (1, ""), (1, None), (2, "x")], key=str)


def test_organiser_links_are_not_shuffled(spark, no_broadcast):
    """The pairs of activities and sections of a name meet last; names of single rows are not normalised."""
    plan = selection.organiser_links(*organisers(spark), slugify)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join Inner")]
    assert not any("Filter" in line and "regexp_replace(" in line and "_name#" in line for line in plan.splitlines())


# --- keyed writes

TARGET_DDL = "id bigint, k string, a string, b int, created_at timestamp_ntz, updated_at timestamp_ntz"
OLD = dt.datetime(2020, 1, 1)


def target(spark, keys):
    return spark.createDataFrame(
        [(i + 1, k, f"old-{k}", i, OLD, OLD) for i, k in enumerate(keys)], TARGET_DDL
    )


def source(spark, items):
    """(key, a) pairs; their order is the order of arrival."""
    data = [(k, a, None, n) for n, (k, a) in enumerate(items)]
    return spark.createDataFrame(data, "k string, a string, b int, seq int")


def run_upsert(t, s, **options):
    return upsert.upsert(t, s, ["k"], ["a", "b"], as_of(), order_by=["seq"], **options)


@pytest.mark.parametrize("large", [False, True])
def test_upsert(spark, request, large):
    if large:
        request.getfixturevalue("no_broadcast")
    t = target(spark, ["x", "y"])
    result = run_upsert(t, source(spark, [("y", "1"), ("z", "2"), ("y", "3")]), id_column="id")
    assert result.columns == t.columns
    assert rows(result) == [
        (1, "x", "old-x", 0, OLD, OLD),
        (2, "y", "3", None, OLD, AS_OF),
        (3, "z", "2", None, AS_OF, AS_OF),
    ]


keys = st.lists(st.sampled_from("abcdef"), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.sampled_from("abcdef")), st.lists(st.tuples(st.sampled_from("cdefgh"), st.sampled_from("pq"))))
def test_upsert_properties(spark, stored, items):
    t, s = target(spark, sorted(stored)), source(spark, items)
    once = run_upsert(t, s, id_column="id")
    expected = {k: f"old-{k}" for k in stored}
    expected.update(dict(items))
    found = {r["k"]: r["a"] for r in once.collect()}
    assert found == expected
    assert sorted(r["id"] for r in once.collect()) == list(range(1, len(expected) + 1))
    again = run_upsert(once, s, id_column="id")
    assert rows(again) == rows(once)


def test_assigned_ids_are_dense_and_stable(spark):
    new = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(None).cast("bigint").alias("id"))
    first = upsert.assign_ids(new, ["k"], F.lit(10), buckets=16)
    second = upsert.assign_ids(new.repartition(7), ["k"], F.lit(10), buckets=16)
    assert sorted(r["id"] for r in first.collect()) == list(range(11, 5011))
    assert rows(first) == rows(second)


def test_upsert_into_an_empty_table(spark):
    stored = empty_table(spark, schemas.CAUSES)
    found = spark.createDataFrame([("b",), ("a",)], "name string")
    result = upsert.upsert(stored, found, ["name"], [], as_of(), touched=None, id_column="id")
    assert sorted((r["name"], r["created_at"]) for r in result.collect()) == [("a", AS_OF), ("b", AS_OF)]
    assert sorted(r["id"] for r in result.collect()) == [1, 2]


def test_affected_rows(spark):
    found = upsert.upsert_affected(
        target(spark, ["x"]), source(spark, [("x", "1"), ("y", "2"), ("x", "3")]), ["k"], ["a"], ["seq"]
    )
    assert rows(found) == [("x", "3", "updated"), ("y", "2", "inserted")]


def test_latest_per_key_keeps_one_whole_row(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None), ("b", 1, "y")], "k string, seq int, v string")
    assert rows(upsert.latest_per_key(frame, ["k"], ["seq"])) == [("a", 3, None), ("b", 1, "y")]


def test_links(spark):
    ddl = "activity_id bigint, section_id bigint"
    old = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], ddl)
    new = spark.createDataFrame([(1, 2), (1, 3), (1, 3)], ddl)
    assert rows(upsert.insert_ignore(old, new, ["activity_id", "section_id"])) == [(1, 3)]
    owners = spark.createDataFrame([(1,), (3,)], "activity_id bigint")
    assert rows(upsert.replace_links(old, owners, new, "activity_id")) == [(1, 2), (1, 3), (2, 1)]


def test_touch_and_partial_update(spark):
    t = target(spark, ["x", "y"])
    hit = spark.createDataFrame([("y",), ("y",)], "k string")
    assert [r["updated_at"] for r in upsert.touch(t, hit, "k", "updated_at", as_of()).orderBy("k").collect()] == [OLD, AS_OF]
    patch = spark.createDataFrame([("x", None, 9)], "k string, a string, b int")
    found = upsert.partial_update(t, patch, ["k"]).orderBy("k").collect()
    assert [(r["a"], r["b"]) for r in found] == [("old-x", 9), ("old-y", 1)]


def test_snapshots_and_appends(spark, tmp_path):
    t = target(spark, ["x"])
    path = str(tmp_path / "v1")
    assert rows(write_snapshot(t, path)) == rows(t)
    append_rows(t.withColumn("extra", F.lit(1)), path, t.columns)
    assert spark.read.parquet(path).count() == 2


def test_conform_adds_and_orders_columns(spark):
    frame = spark.createDataFrame([("x", "TR")], "name string, country_code string")
    found = conform(frame, schemas.COUNTRIES)
    assert found.schema == schemas.COUNTRIES.schema
    assert found.first()["slug"] is None


def test_tables_have_keys(spark):
    assert len(schemas.TABLES) == 17
    for table in schemas.TABLES.values():
        names = set(table.schema.names)
        assert set(table.key) <= names and set(table.update) <= names


# --- integrity and retention


def test_foreign_keys(spark, no_broadcast):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, p string")
    parent = spark.createDataFrame([("a",)], "key string")
    assert rows(integrity.fk_orphans(child, parent, "p", "key")) == [(2, "b")]
    assert rows(integrity.on_delete_set_null(child, parent, "p", "key")) == [(1, "a"), (2, None), (3, None)]
    assert rows(integrity.on_delete_cascade(child, parent, "p", "key")) == [(1, "a")]
    renames = spark.createDataFrame([("a", "z")], "old_key string, new_key string")
    assert rows(integrity.on_update_cascade(child, renames, "p")) == [(1, "z"), (2, "b"), (3, None)]


def test_retention_edges(spark):
    limit = AS_OF - dt.timedelta(days=30)
    stamps = [limit, limit - dt.timedelta(microseconds=1), None]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, created_at timestamp_ntz")
    assert [r["id"] for r in retention.retain_errors(frame, as_of()).orderBy("id").collect()] == [0, 2]
    flags = spark.createDataFrame(
        [(0, False, stamps[1]), (1, True, stamps[1]), (2, None, stamps[1]), (3, False, None)],
        "id int, is_valid boolean, updated_at timestamp_ntz",
    )
    assert [r["id"] for r in retention.retain_activities(flags, as_of()).orderBy("id").collect()] == [1, 2, 3]


# --- selection

SECTIONS = [
    (1, "A", True, dt.datetime(2023, 1, 2)),
    (2, "B", None, None),
    (3, "C", True, None),
    (4, "D", False, dt.datetime(2020, 1, 1)),
    (5, "E", True, dt.datetime(2023, 1, 1)),
]
SECTION_DDL = "id bigint, name string, can_scrape_activities boolean, last_scraped timestamp_ntz"


def test_queues(spark):
    frame = spark.createDataFrame(SECTIONS, SECTION_DDL)
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(selection.scrape_queue(frame)) == [3, 5, 1]
    assert ids(selection.scrape_queue(frame, 2)) == [3, 5]
    assert ids(selection.scrape_queue(frame, 0)) == [3, 5, 1]
    assert ids(selection.stalest_sections(frame)) == [2, 3, 4, 5, 1]
    assert sorted(ids(selection.stale_sections(frame, F.lit("2023-01-08 12:00:00").cast("timestamp_ntz")))) == [2, 3, 4, 5]


def test_refresh_due(spark):
    ddl = "scraper_module string, status string, completed_at timestamp_ntz"
    sections = spark.createDataFrame(SECTIONS, SECTION_DDL)

    def reason(completed, s=sections):
        runs = spark.createDataFrame([("accounts", "completed", c) for c in completed], ddl)
        return selection.refresh_due(s, runs, as_of()).first()["reason"]

    assert reason([AS_OF]) is None
    assert reason([AS_OF - dt.timedelta(days=31)]) == "last run too old"
    assert reason([]) == "never completed"
    assert reason([AS_OF], sections.limit(0)) == "no sections"


def test_search_conditions_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "activities")
    frame = spark.range(10).select("id", F.lit("Party").alias("title"), F.col("id").cast("int").alias("participants"))
    frame.write.parquet(path)
    search = selection.ActivitySearch(title="PART", min_participants=3, max_participants=5)
    found = selection.activity_search(spark.read.parquet(path), search)
    assert [r["id"] for r in found.orderBy("id").collect()] == [3, 4, 5]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(participants,3)" in plan
    assert selection.activity_search(frame, selection.ActivitySearch()).count() == 10


def test_pages_of_results(spark):
    frame = spark.range(50).select((F.col("id") / 10).cast("int").alias("g"), "id")
    offset = selection.page_of(frame, ["g", "id"], 3, 7).collect()
    after = selection.page_after(frame, ["g", "id"], [1, 13], 7).collect()
    assert [r["id"] for r in offset] == list(range(14, 21)) == [r["id"] for r in after]


def test_reachable(spark):
    sections = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "b")], "id int, slug string")
    answers = spark.createDataFrame([("a", 200), ("a", 200), ("", 200), ("b", 404)], "slug string, status int")
    found = selection.reachable(sections, answers, "slug").orderBy("id").collect()
    assert [r["can_scrape_activities"] for r in found] == [True, False, False, False]


# --- validation

GOOD = {
    "event_slug": " Boat-Party-1 ",
    "url": "https://a.example.org/x",
    "title": " Boat   Party ",
    "description": "A  description of it",
    "start_date": dt.date(2023, 11, 8),
    "end_date": dt.date(2023, 11, 8),
    "city": "Istanbul",
    "country_code": " tr",
    "participants": 160,
    "activity_type": "Social",
    "organisers": [" a", "a", ""],
    "causes": ["x"],
    "objectives": None,
    "sdgs": [4, 3, 4],
}
ACTIVITY_DDL = (
    "event_slug string, url string, title string, description string, start_date date, end_date date, "
    "city string, country_code string, participants int, activity_type string, organisers array<string>, "
    "causes array<string>, objectives array<string>, sdgs array<int>"
)


def check(spark, **changes):
    frame = spark.createDataFrame([tuple({**GOOD, **changes}.values())], ACTIVITY_DDL)
    return validation.validate_activities(frame, F.lit("2023-11-08").cast("date"), ["Social"]).first()


def test_valid_activity_is_cleaned(spark):
    row = check(spark)
    assert row["is_valid"] and row["errors"] == []
    assert (row["event_slug"], row["title"], row["country_code"]) == ("boat-party-1", "Boat Party", "TR")
    assert (row["organisers"], row["objectives"], row["sdgs"]) == (["a"], [], [4, 3])
    assert row["is_future_event"] is False


@pytest.mark.parametrize(
    ("changes", "field"),
    [
        ({"event_slug": "a b"}, "event_slug"),
        ({"event_slug": None}, "event_slug"),
        ({"url": "ftp://x"}, "url"),
        ({"title": "  "}, "title"),
        ({"title": "x" * 256}, "title"),
        ({"description": "too    short"[:9]}, "description"),
        ({"start_date": None}, "start_date"),
        ({"end_date": dt.date(2023, 11, 7)}, "end_date"),
        ({"city": "x" * 101}, "city"),
        ({"country_code": "T1"}, "country_code"),
        ({"participants": -1}, "participants"),
        ({"participants": 10001}, "participants"),
        ({"activity_type": "Other"}, "activity_type"),
        ({"sdgs": [18]}, "sdgs"),
    ],
)
def test_invalid_activity(spark, changes, field):
    row = check(spark, **changes)
    assert [e["field_name"] for e in row["errors"]] == [field] and not row["is_valid"]


def test_all_fields_report(spark):
    row = check(spark, title=None, participants=-5, sdgs=[0])
    assert [e["field_name"] for e in row["errors"]] == ["title", "participants", "sdgs"]


def test_valid_and_invalid_make_the_input(spark):
    frame = spark.createDataFrame([(n,) for n in ("", "ok", None, "x" * 101)], "name string")
    checked = validation.validate(frame, validation.lookup_rules(100))
    good, bad = validation.split_valid(checked)
    assert (good.count(), bad.count()) == (1, 3)
    assert rows(validation.validation_summary(checked)) == [(1, 4)]
    logged = validation.error_rows(checked, "activities", as_of())
    expected = set(schemas.VALIDATION_ERRORS.schema.names) - {"id"}
    assert set(logged.columns) == expected and logged.count() == 3


def test_missing_statistics_lists(spark):
    frame = spark.createDataFrame([(1, [], 0), (2, ["a"], -1), (3, None, 1)], "id int, causes array<string>, n int")
    checked = validation.validate(frame, validation.count_rules(["n"], ["causes"])).orderBy("id").collect()
    assert [[e["field_name"] for e in r["errors"]] for r in checked] == [["causes"], ["n"], ["causes"]]


# --- gates


@pytest.mark.parametrize(
    ("values", "reason"),
    [
        ((40, 400, 280, 40), None),
        ((39, 400, 400, 0), "too few countries"),
        ((40, 399, 399, 0), "too few sections"),
        ((40, 400, 279, 0), "low validation rate"),
        ((40, 400, 400, 41), "too many errors"),
    ],
)
def test_accounts_gate(spark, values, reason):
    names = "countries_processed int, sections_processed int, sections_validated int, errors int"
    row = quality.accounts_gate(spark.createDataFrame([values], names)).first()
    assert (row["reason"], row["passed"]) == (reason, reason is None)


@pytest.mark.parametrize(
    ("values", "reason"),
    [
        ((10, 50, 2), None),
        ((0, 0, 0), "no sections"),
        ((10, 49, 0), "too few activities"),
        ((10, 50, 3), "too many errors"),
    ],
)
def test_activities_gate(spark, values, reason):
    frame = spark.createDataFrame([values], "sections_processed int, activities_processed int, errors int")
    row = quality.activities_gate(frame).first()
    assert (row["reason"], row["passed"]) == (reason, reason is None)


def test_quality_score_of_nothing(spark):
    assert spark.range(1).select(quality.quality_score(F.lit(0), F.lit(0))).first()[0] == 0.0
