"""Whole runs over a small invented network, and the incremental job."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orgmetrics import schemas
from orgmetrics.operators import extraction
from orgmetrics.operators.validation import Ruleset, activity_rules
from orgmetrics.plans.accounts import accounts_run
from orgmetrics.plans.activities import activities_run
from orgmetrics.plans.full import full_run
from orgmetrics.plans.retention import retention_run
from orgmetrics.schemas import PAGE_DDL
from orgmetrics.session import shared_dir
from orgmetrics.sources.tables import conform, empty_table
from orgmetrics.streaming.incremental import batches, compact, current_rows, ingest_available
from tests.conftest import rows
from tests.test_extraction import DOCUMENT, HEAD, SECTION, SITE

ACCOUNTS, ACTIVITIES = SITE.accounts_url, SITE.activities_url
AS_OF = dt.datetime(2023, 11, 8)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def card(slug):
    return f'<article class="activities-mini-preview"><b class="eg-c-card-title"><a href="/activity/{slug}">x</a></b></article>'


def detail(title, organiser, cause="Culture", people="12", country="Türkiye"):
    return f"""<html><h1>{title}</h1><div class="activity__field-ct-act-description"><div class="field__item">A long description</div></div>
      <div class="highlight-dates-single"><span>09/11/2023</span></div>
      <div class="highlight-data-text"><span>City</span><span>{country}</span></div><b class="highlight-data-text-big">{people}</b>
      <div class="pseudo__items pseudo__organisers"><a>{organiser}</a><a>Stranger</a></div>
      <div class="activity-cause"><a>{cause}</a></div><div class="field-sdgs-wrapper"><img alt="SDG 3"></div></html>"""


PAGES = {
    f"{ACCOUNTS}/": '<html><a href="/country/tr">Türkiye</a><a href="/country/de">Germany</a><a href="/country/d1">Nowhere</a></html>',
    f"{ACCOUNTS}/country/tr": """<html><div class="views-view-grid"><a href="/section/tr-a">Net Alpha</a>
        <a href="/section/tr-b">Beta</a><a href="/section/tr c">Gamma</a></div></html>""",
    f"{ACCOUNTS}/country/de": '<html><div class="views-view-grid"></div></html>',
    f"{ACCOUNTS}/section/tr-a": SECTION,
    f"{ACCOUNTS}/section/tr-b": "no markup at all",
    f"{ACTIVITIES}/organisation/net-alpha/activities?page=0": f'<html>{card("boat-1")}{card("walk-2")}<a title="Go to last page" href="?page=2">x</a></html>',
    f"{ACTIVITIES}/organisation/net-alpha/activities?page=1": f'<html>{card("walk-2")}{card("gone-3")}{card("bad-4")}</html>',
    f"{ACTIVITIES}/activity/boat-1": detail("Boat", "Net Alpha"),
    f"{ACTIVITIES}/activity/walk-2": detail("Walk", "NET ALPHA", "Unlisted", "7", "Atlantis"),
    f"{ACTIVITIES}/activity/bad-4": detail("", "Net Alpha", people="10001"),
    f"{ACTIVITIES}/organisation/net-alpha/statistics": f"{HEAD}{json.dumps(DOCUMENT)}</script></html>",
}


@pytest.fixture(scope="module")
def pages(spark):
    """Every page, and an older copy of each that must not count."""
    old = [(i, u, "<html><h1>Older copy</h1></html>") for i, u in enumerate(PAGES)]
    new = [(i + len(old), u, h) for i, (u, h) in enumerate(PAGES.items())]
    return spark.createDataFrame(old + new, PAGE_DDL)


@pytest.fixture(scope="module")
def answers(spark):
    return spark.createDataFrame(
        [
            (f"{ACTIVITIES}/organisation/net-alpha/activities", 200),
            (f"{ACTIVITIES}/organisation/net-beta/activities", 404),
        ],
        "url string, status int",
    )


@pytest.fixture(scope="module")
def accounts(spark, pages, answers):
    stored = empty_table(spark, schemas.COUNTRIES), empty_table(spark, schemas.SECTIONS)
    return accounts_run(pages, answers, *stored, SITE, as_of())


def test_accounts_run(accounts):
    assert rows(accounts.countries.select("country_code", "name", "section_count")) == [
        ("DE", "Germany", 0),
        ("TR", "Türkiye", 2),
    ]
    found = accounts.sections.select("accounts_platform_slug", "city", "can_scrape_activities", "last_scraped")
    assert rows(found) == [("tr-a", "Ankara", True, None), ("tr-b", None, False, None)]
    assert sorted(r["id"] for r in accounts.sections.collect()) == [1, 2]
    assert accounts.sections.schema.names == schemas.SECTIONS.schema.names
    assert rows(accounts.validation_errors.select("field_name")) == [("accounts_platform_slug",), ("country_code",)]
    assert rows(accounts.rejected_pages.select("url")) == [(f"{ACCOUNTS}/section/tr-b",)]
    logged = accounts.failed_scrapes.select("url", "scraper_module", "error_message")
    assert rows(logged) == [(f"{ACCOUNTS}/section/tr-b", "accounts", "no html element")]
    row = accounts.summary.first()
    assert (row["sections_processed"], row["sections_validated"], row["errors"], row["passed"]) == (2, 1, 2, False)


@pytest.fixture(scope="module")
def stored(spark, accounts):
    tables = {name: empty_table(spark, t) for name, t in schemas.TABLES.items()}
    tables["countries"], tables["sections"] = accounts.countries, accounts.sections
    tables["activity_causes"] = conform(spark.createDataFrame([(1, "Culture"), (2, "Sport")], "id bigint, name string"), schemas.CAUSES)
    tables["sdgs"] = conform(spark.createDataFrame([(30, "SDG 3")], "id bigint, name string"), schemas.SDGS)
    return tables


def test_activities_run(spark, pages, stored):
    run = activities_run(pages, stored, SITE, as_of())
    found = run.tables["activities"].select("event_slug", "title", "country_code", "is_valid", "is_future_event")
    assert rows(found) == [
        ("bad-4", "", "TR", False, True),
        ("boat-1", "Boat", "TR", True, True),
        ("walk-2", "Walk", None, True, True),
    ]
    ids = {r["event_slug"]: r["id"] for r in run.tables["activities"].collect()}
    section = stored["sections"].filter("accounts_platform_slug = 'tr-a'").first()["id"]
    assert rows(run.tables["activity_section_organisers"]) == sorted(((i, section) for i in ids.values()), key=str)
    assert rows(run.tables["activity_to_cause"]) == sorted([(ids["boat-1"], 1), (ids["bad-4"], 1)], key=str)
    assert run.tables["activity_to_sdg"].count() == 3
    assert rows(run.validation_errors.select("activity_event_slug", "field_name")) == [
        ("bad-4", "participants"),
        ("bad-4", "title"),
        ("walk-2", "country_code"),
    ]
    assert rows(run.failed_scrapes.select("url", "section_id")) == [
        (f"{ACTIVITIES}/activity/gone-3", None),
        (f"{ACTIVITIES}/organisation/net-alpha/activities?page=2", section),
    ]
    overall = run.tables["section_overall_statistics"]
    assert rows(overall.select("section_id", "physical_activities", "scraped_at")) == [(section, 7, AS_OF)]
    assert run.tables["section_cause_statistics"].count() == 3
    for name, frame in run.tables.items():
        assert frame.columns == schemas.TABLES[name].schema.names, name

    again = activities_run(pages, {**stored, **run.tables}, SITE, as_of(), only="net-alpha")
    for name, frame in run.tables.items():
        assert rows(again.tables[name]) == rows(frame), name


def test_sections_that_share_a_slug(spark, pages, stored):
    """Both get every card and every gap once; neither multiplies the other's rows."""
    sections = stored["sections"]
    one = sections.filter("accounts_platform_slug = 'tr-a'")
    twin = one.withColumn("id", F.lit(77).cast("bigint")).withColumn("accounts_platform_slug", F.lit("tr-z"))
    both = {**stored, "sections": sections.unionByName(twin.withColumn("name", F.lit("NET-ALPHA")))}
    run = activities_run(pages, both, SITE, as_of())
    first = one.first()["id"]
    summary = run.summary.first()
    assert (summary["sections_processed"], summary["activities_processed"], summary["statistics_processed"]) == (2, 6, 2)
    assert summary["errors"] == 0
    url = f"{ACTIVITIES}/organisation/net-alpha/activities?page=2"
    assert rows(run.failed_scrapes.filter(F.col("url") == url).select("section_id")) == sorted([(first,), (77,)], key=str)
    links = run.tables["activity_section_organisers"]
    assert rows(links.groupBy("section_id").count()) == sorted([(first, 3), (77, 3)], key=str)
    assert run.tables["section_overall_statistics"].count() == 2


def test_statistics_outlive_a_missing_page(spark, pages, stored):
    section = stored["sections"].filter("accounts_platform_slug = 'tr-a'").first()["id"]
    table = schemas.OVERALL_STATISTICS
    kept = conform(spark.createDataFrame([(1, section, 77, 5)], "id bigint, section_id bigint, physical_activities bigint, online_activities bigint"), table)
    without = pages.filter(~F.col("url").endswith("/statistics"))
    run = activities_run(without, {**stored, table.name: kept}, SITE, as_of())
    assert rows(run.tables[table.name].select("section_id", "physical_activities", "online_activities")) == [(section, 77, 5)]
    assert run.summary.first()["statistics_processed"] == 0
    # A section that never had any gets zeros.
    fresh = activities_run(without, stored, SITE, as_of()).tables[table.name]
    assert rows(fresh.select("section_id", "physical_activities")) == [(section, 0)]


def test_negative_statistics_are_logged_and_not_stored(spark, pages, stored):
    document = json.loads(json.dumps(DOCUMENT).replace('"7"', '"-7"').replace(" 7]", " -7]"))
    text = f"{HEAD}{json.dumps(document)}</script></html>"
    assert "-7" in text
    changed = pages.withColumn("html", F.when(F.col("url").endswith("/statistics") & F.col("html").contains("script"), text).otherwise(F.col("html")))
    run = activities_run(changed, stored, SITE, as_of())
    assert run.tables["section_overall_statistics"].count() == 0
    logged = run.validation_errors.filter("scraper_module = 'statistics'").select("field_name").distinct()
    assert ("physical_activities",) in rows(logged)


def test_rejected_pages_are_logged_with_their_reason(spark, pages, stored):
    url = f"{ACTIVITIES}/activity/gone-3"
    broken = pages.unionByName(spark.createDataFrame([(99, url, "no markup")], PAGE_DDL))
    run = activities_run(broken, stored, SITE, as_of())
    assert rows(run.failed_scrapes.filter(F.col("url") == url).select("error_message")) == [("no html element",)]


def test_every_page_is_parsed_once(spark, pages, stored, no_broadcast):
    """One reading per good page of a kind, whatever the number of joins behind it."""
    activities_run(pages, stored, SITE, as_of())
    kinds = {"listed": "/organisation/%/activities?page=%", "parsed": "/activity/%"}
    written = {}
    for folder in Path(shared_dir(spark)).glob("activities-*"):
        written[folder.stat().st_mtime] = folder
    last = written[max(written)]
    for name, like in kinds.items():
        landed = pages.filter(F.col("url").like(f"{ACTIVITIES}{like}") & F.col("html").contains("<html")).count()
        assert spark.read.parquet(f"{last}/{name}").count() == landed
    for frame in (spark.read.parquet(f"{last}/cards"), spark.read.parquet(f"{last}/activities")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan


def test_full_run_refreshes_sections_only_when_due(spark, pages, answers, accounts):
    empty = {name: empty_table(spark, t) for name, t in schemas.TABLES.items()}
    first, activities = full_run(pages, answers, empty, SITE, as_of())
    assert rows(first.countries) == rows(accounts.countries)
    assert activities.tables["activities"].count() == 3
    status = first.status.unionByName(activities.status)
    assert rows(status.select("scraper_module", "status")) == [("accounts", "completed"), ("activities", "completed")]
    stored = {**empty, "countries": first.countries, "sections": first.sections, **activities.tables}
    stored["scraper_status"] = conform(status, schemas.SCRAPER_STATUS)
    second, again = full_run(pages, answers, stored, SITE, as_of())
    assert second is None
    assert rows(again.tables["activities"]) == rows(activities.tables["activities"])


def test_retention_run(spark, stored):
    old = AS_OF - dt.timedelta(days=31)
    activities = conform(
        spark.createDataFrame([(1, False, old), (2, True, old), (3, False, AS_OF)], "id bigint, is_valid boolean, updated_at timestamp_ntz"),
        schemas.ACTIVITIES,
    )
    links = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], schemas.ORGANISERS.schema)
    result = retention_run({**stored, "activities": activities, "activity_section_organisers": links}, as_of())
    assert sorted(r["id"] for r in result["activities"].collect()) == [2, 3]
    assert rows(result["activity_section_organisers"]) == [(2, 1), (3, 2)]


def extract(pages):
    cards = extraction.extract_activity_links(pages, SITE)
    return cards.select("event_slug", F.col("activity_url").alias("url"), "page_id", "position")


def card_rules():
    rules = activity_rules()
    return Ruleset(rules.clean, [x for x in rules.checks if x[0] in ("event_slug", "url")])


def test_incremental_ingest_equals_batch(spark, tmp_path):
    landed = str(tmp_path / "landed")
    batch = [
        [(0, "u0", f"<html>{card('a')}{card('b')}</html>"), (1, "u1", "broken")],
        [(2, "u2", f"<html>{card('b')}{card('c!')}</html>")],
    ]
    state = f"{shared_dir(spark)}/{uuid.uuid4().hex}"

    def ingest(into, **options):
        ingest_available(spark, landed, into, extract, card_rules(), **options)
        return rows(current_rows(spark, into, ["event_slug"], ["page_id"]).select("event_slug", "page_id"))

    spark.createDataFrame(batch[0], PAGE_DDL).coalesce(1).write.mode("append").parquet(landed)
    assert ingest(state) == [("a", 0), ("b", 0)]
    spark.createDataFrame(batch[1], PAGE_DDL).coalesce(1).write.mode("append").parquet(landed)
    assert ingest(state) == [("a", 0), ("b", 2)]
    assert ingest(state) == [("a", 0), ("b", 2)]
    assert batches(spark, state, "rejected").count() == 1
    assert batches(spark, state, "checked").filter("not is_valid").count() == 1
    # From the start, one file at a time: other batches, same table.
    replay = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    assert ingest(replay, files_per_batch=1) == [("a", 0), ("b", 2)]
    compact(spark, state, ["event_slug"], ["page_id"], f"{replay}-compact")
    again = current_rows(spark, f"{replay}-compact", ["event_slug"], ["page_id"])
    assert rows(again.select("event_slug", "page_id")) == [("a", 0), ("b", 2)]
