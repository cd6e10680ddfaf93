"""The activities run: work queue, listing pages, detail pages, links, statistics, gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics import schemas
from orgmetrics.functions import urls
from orgmetrics.functions.slugs import slugify
from orgmetrics.operators import (
    extraction,
    integrity,
    quality,
    selection,
    statistics,
    upsert,
    validation,
)
from orgmetrics.operators.extraction import Site
from orgmetrics.operators.joins import lookup_join
from orgmetrics.plans.stage import Stage, run_status
from orgmetrics.sources.pages import from_latest, only_wanted, page_gate
from orgmetrics.sources.settings_json import page_statistics

SLUG = "activities_platform_slug"


@dataclass(frozen=True)
class ActivitiesRun:
    """Next versions by table name, log rows to append, and the run's verdict."""

    tables: dict[str, DataFrame]
    validation_errors: DataFrame
    failed_scrapes: DataFrame
    summary: DataFrame
    status: DataFrame


def activities_run(
    pages: DataFrame,
    stored: dict[str, DataFrame],
    site: Site,
    as_of: Column,
    limit: int | None = None,
    only: str | None = None,
) -> ActivitiesRun:
    """``stored`` maps table names to the stored tables; ``only`` picks one section by its slug."""
    stage = Stage(pages.sparkSession, "activities")
    good, rejected = page_gate(pages)
    narrow = bool(only or limit)  # a run over few sections reads only their pages
    sections = stored["sections"]
    queue = (
        selection.section_by_slug(sections, only)
        if only
        else selection.scrape_queue(sections, limit)
    )
    queue = stage.table(queue.select("id", "name", SLUG), "queue")

    listing = good.filter(F.col("url").startswith(site.activities_url + "/organisation/"))
    listing = listing.filter(F.col("url").rlike(r"/activities(\?|$)"))
    listed, landed, missing_listing = _listing_pages(queue, listing, site, stage, narrow)
    # Sections that share a slug share its pages, so a page may belong to several.
    cards = extraction.listed_cards(listed, site).drop("page_id")
    cards = stage.table(cards.join(landed.select("url", "id"), "url"), "cards")

    events = good.filter(F.col("url").startswith(site.activities_url + site.activity_marker))
    linked = stage.table(extraction.linked_activities(cards), "linked")
    missing_detail = linked.join(events.select("url").distinct(), "url", "left_anti")
    # Every page is parsed once, before anything is joined, and what it gave is written.
    wanted = only_wanted(events, linked) if narrow else events
    parsed = stage.table(extraction.extract_activities(wanted, site, as_of), "parsed")
    parsed = lookup_join(from_latest(parsed, events).drop("page_id"), linked, "url")
    # One event may be reachable under two addresses.
    parsed = upsert.latest_per_key(parsed, ["event_slug"], ["url"])
    checked = stage.table(validation.validate_activities(parsed, as_of), "activities")

    activities, countries_unknown = _known_countries(checked, stored["countries"], as_of)
    key, update = list(schemas.ACTIVITIES.key), list(schemas.ACTIVITIES.update)
    next_activities = stage.table(
        upsert.upsert(stored["activities"], activities, key, update, as_of, id_column="id"),
        "next_activities",
    )
    ids = next_activities.select("event_slug", F.col("id").alias("activity_id"))
    touched = stage.table(activities.join(ids, "event_slug"), "touched")

    tables = {"activities": next_activities, **_links(touched, sections, stored)}
    found_statistics, documents, invalid = _statistics(
        queue, good, stored, site, as_of, stage, narrow
    )
    tables.update(found_statistics)
    done = landed.filter(F.col("page") == 0).select("id")
    tables["sections"] = upsert.touch(sections, done, "id", "last_scraped", as_of)

    errors = validation.error_rows(checked, "activities", as_of, event_slug=F.col("event_slug"))
    errors = stage.table(errors.unionByName(countries_unknown).unionByName(invalid), "errors")
    failed = _failures(missing_listing, missing_detail, rejected, as_of)
    failed = stage.table(failed, "failed")
    listed_by = cards.join(checked.select("event_slug"), "event_slug", "left_semi")
    listed_by = listed_by.select("id", "event_slug").distinct()
    summary = quality.activity_run_summary(
        done, listed_by, documents, queue.join(done, "id", "left_anti")
    )
    summary = stage.table(quality.activities_gate(summary), "summary")
    return ActivitiesRun(
        tables, errors, failed, summary, run_status(summary, "activities", as_of)
    )


def _listing_pages(queue, listing, site, stage, narrow) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(what the listing pages say, landed addresses by section, wanted ones that are missing)."""
    slugs = queue.select(SLUG).distinct()
    if narrow:
        folder = urls.listing_url(site.activities_url, F.col(SLUG)).alias("folder")
        own = F.substring_index("url", "?", 1).alias("folder")
        listing = listing.withColumn("folder", own).join(slugs.select(folder), "folder", "left_semi")
        listing = listing.drop("folder")
    # One reading gives both the number of pages and the cards.
    listed = stage.table(extraction.extract_listing(listing, site), "listed")
    listed = from_latest(listed, listing)
    first = slugs.select(
        SLUG, urls.listing_page_url(site.activities_url, F.col(SLUG), F.lit(0)).alias("url")
    )
    last = lookup_join(listed.select("url", "last_page"), first, "url").select(SLUG, "last_page")
    # A section without a first page still asks for it, so that the gap is logged.
    ranges = slugs.join(last, SLUG, "left").select(
        SLUG, F.coalesce("last_page", F.lit(0)).alias("last_page")
    )
    ranges = stage.table(ranges, "ranges")
    addresses = listing.select("url").distinct()
    landed, missing = extraction.page_fanout(queue, addresses, site, ranges)
    return listed, stage.table(landed, "landed"), missing


def _known_countries(checked, countries, as_of) -> tuple[DataFrame, DataFrame]:
    """Activities with references to stored countries only, and a log row for every other code."""
    known = countries.select("country_code")
    unknown = integrity.fk_orphans(checked, known, "country_code", "country_code")
    error = F.struct(
        F.lit("country_code").alias("field_name"), F.lit("unknown country").alias("error_message")
    )
    rows = validation.error_rows(
        unknown.withColumn("errors", F.array(error)),
        "activities",
        as_of,
        event_slug=F.col("event_slug"),
    )
    linked = integrity.on_delete_set_null(checked, known, "country_code", "country_code")
    return linked, rows


def _links(touched: DataFrame, sections: DataFrame, stored: dict) -> dict[str, DataFrame]:
    """Next versions of the four junction tables: links of the touched activities are replaced."""
    owner = "activity_id"
    organisers = selection.organiser_links(touched, sections.select("id", "name"), slugify)
    result = {}
    table = schemas.ORGANISERS.name
    result[table] = upsert.replace_links(stored[table], touched, organisers, owner)
    goals = F.transform("sdgs", lambda n: F.concat(F.lit("SDG "), n.cast("string")))
    names = touched.select(owner, "causes", "objectives", goals.alias("sdgs"))
    for table, column, lookup, link in (
        (schemas.ACTIVITY_CAUSES, "causes", schemas.CAUSES, "cause_id"),
        (schemas.ACTIVITY_OBJECTIVES, "objectives", schemas.OBJECTIVES, "objective_id"),
        (schemas.ACTIVITY_SDGS, "sdgs", schemas.SDGS, "sdg_id"),
    ):
        found = selection.links_by_name(names, owner, column, stored[lookup.name], link)
        result[table.name] = upsert.replace_links(stored[table.name], touched, found, owner)
    return result


def _statistics(
    queue, pages, stored, site, as_of, stage, narrow
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(next versions of the four statistics tables, sections with a document, error rows).

    Only a parsed document overwrites stored counts. A section that has neither a document nor a
    stored row gets zeros. Rows with a negative count are logged and not stored.
    """
    wanted = queue.select(
        F.col("id").alias("section_id"),
        urls.statistics_url(site.activities_url, F.col(SLUG)).alias("url"),
    )
    ours = pages.filter(F.col("url").rlike("/organisation/[^/]+/statistics$"))
    read = only_wanted(ours, wanted) if narrow else ours
    read = read.select("page_id", "url", page_statistics(F.col("html")).alias("stats"))
    read = from_latest(stage.table(read, "statistics_pages"), ours)
    # Sections that share a slug share its document.
    parsed = wanted.join(read.filter("stats IS NOT NULL"), "url").select("section_id", "stats")
    parsed = stage.table(parsed, "statistics")
    overall = statistics.overall_statistics(parsed)
    known = stored[schemas.OVERALL_STATISTICS.name].select("section_id")
    rest = queue.select(F.col("id").alias("section_id")).join(known, "section_id", "left_anti")
    zeros = statistics.zero_filled(rest, overall, "section_id").filter(~F.col("has_statistics"))
    rows = {
        schemas.OVERALL_STATISTICS: overall.unionByName(zeros),
        schemas.CAUSE_STATISTICS: statistics.category_statistics(parsed, "section_id", "causes"),
        schemas.TYPE_STATISTICS: statistics.category_statistics(parsed, "section_id", "types"),
        schemas.PARTICIPANT_STATISTICS: statistics.category_statistics(
            parsed, "section_id", "participants"
        ),
    }
    tables, invalid = {}, None
    for table, found in rows.items():
        counts = [f.name for f in table.schema if f.name in found.columns and _is_count(f)]
        checked = validation.validate(found, validation.count_rules(counts))
        checked = stage.table(checked, f"checked_{table.name}")
        good, _ = validation.split_valid(checked)
        bad = validation.error_rows(checked, "statistics", as_of, section_id=F.col("section_id"))
        invalid = bad if invalid is None else invalid.unionByName(bad)
        tables[table.name] = upsert.upsert(
            stored[table.name],
            good.withColumn("scraped_at", as_of),
            list(table.key),
            list(table.update),
            as_of,
            created=None,
            touched=None,
            id_column="id",
        )
    return tables, parsed.select("section_id"), invalid


def _is_count(field) -> bool:
    return field.dataType.typeName() in ("integer", "long") and field.name not in ("id", "section_id")


def _failures(
    missing_listing: DataFrame, missing_detail: DataFrame, rejected: DataFrame, as_of: Column
) -> DataFrame:
    """Failure-log rows of the pages that were wanted but never landed, or not as a page."""
    none = F.lit(None).cast("bigint")
    gaps = missing_listing.select("url", F.col("id").alias("section_id")).unionByName(
        missing_detail.select("url", none.alias("section_id"))
    )
    reasons = rejected.groupBy("url").agg(F.max("error_message").alias("reason"))
    return gaps.join(reasons, "url", "left").select(
        "url",
        "section_id",
        F.lit("activities").alias("scraper_module"),
        F.lit(None).cast("int").alias("http_status_code"),
        F.coalesce("reason", F.lit("page not landed")).alias("error_message"),
        F.lit(0).alias("retry_count"),
        as_of.cast("timestamp_ntz").alias("last_attempt"),
        F.lit(True).alias("will_retry"),
    )
