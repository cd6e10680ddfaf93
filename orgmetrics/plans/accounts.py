"""The accounts run: country list, country pages, section pages, reachability, upserts, gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics import schemas
from orgmetrics.functions import urls
from orgmetrics.operators import extraction, quality, selection, upsert, validation
from orgmetrics.operators.extraction import Site
from orgmetrics.operators.joins import lookup_join
from orgmetrics.operators.runlog import rejected_page_rows
from orgmetrics.plans.stage import Stage, run_status
from orgmetrics.sources.pages import from_latest, page_gate
from orgmetrics.sources.tables import conform


@dataclass(frozen=True)
class AccountsRun:
    countries: DataFrame
    sections: DataFrame
    validation_errors: DataFrame
    rejected_pages: DataFrame
    failed_scrapes: DataFrame
    summary: DataFrame
    status: DataFrame


def accounts_run(
    pages: DataFrame,
    answers: DataFrame,
    countries: DataFrame,
    sections: DataFrame,
    site: Site,
    as_of: Column,
) -> AccountsRun:
    """``pages`` are the landed pages, ``answers`` (url, status) the reachability probes,
    ``countries`` and ``sections`` the stored tables."""
    stage = Stage(pages.sparkSession, "accounts")
    good, rejected = page_gate(pages)
    slug = "accounts_platform_slug"

    crawled = _countries(good, site)
    checked = validation.validate(crawled, validation.country_rules())
    checked_countries = stage.table(checked, "countries")
    found_countries, _ = validation.split_valid(checked_countries)

    listing = _listing(good, found_countries, site)
    details = _details(good, site)
    merged = selection.merge_details(listing, details, slug)
    reached = _reachable(merged, answers, site)
    checked_sections = stage.table(
        validation.validate(reached, validation.section_rules()), "sections"
    )
    found_sections, _ = validation.split_valid(checked_sections)

    counts = quality.section_counts(found_countries, found_sections)
    country_rows = found_countries.drop("section_count").join(counts, "country_code")
    next_countries = upsert.upsert(
        countries,
        country_rows,
        list(schemas.COUNTRIES.key),
        list(schemas.COUNTRIES.update),
        as_of,
        order_by=["position"],
    )
    section_rows = conform(
        found_sections.withColumn("last_validated_activities_slug", as_of), schemas.SECTIONS
    )
    next_sections = upsert.upsert(
        sections,
        section_rows,
        [slug],
        list(schemas.SECTIONS.update),
        as_of,
        id_column="id",
    )
    # The last visit is that of a section's activities: the queue is ordered by it.
    next_sections = stage.table(next_sections, "next_sections")

    errors = validation.error_rows(checked_countries, "accounts", as_of).unionByName(
        validation.error_rows(checked_sections, "accounts", as_of)
    )
    errors = stage.table(errors, "errors")
    failed = checked_countries.select("is_valid").unionByName(checked_sections.select("is_valid"))
    summary = quality.accounts_gate(
        quality.accounts_run_summary(found_countries, found_sections, failed.filter("NOT is_valid"))
    )
    summary = stage.table(summary, "summary")
    status = run_status(summary, "accounts", as_of)
    # Pages of this run's site whose last landed copy could not be read.
    own = rejected.filter(F.col("url").startswith(site.accounts_url))
    failures = rejected_page_rows(from_latest(own, pages), "accounts", as_of)
    failures = stage.table(failures, "failed_scrapes")
    return AccountsRun(next_countries, next_sections, errors, rejected, failures, summary, status)


def _countries(pages: DataFrame, site: Site) -> DataFrame:
    root = pages.filter(F.regexp_replace("url", "/+$", "") == F.lit(site.accounts_url))
    found = from_latest(extraction.extract_countries(root, site), root)
    rows = found.select(
        "country_code",
        "name",
        "slug",
        F.col("country_url").alias("url"),
        F.lit(0).alias("section_count"),
        "position",
    )
    return upsert.latest_per_key(rows, ["country_code"], ["position"])


def _listing(pages: DataFrame, countries: DataFrame, site: Site) -> DataFrame:
    """Sections of the listed countries' pages, the last link of a section counting."""
    country_pages = pages.filter(F.col("url").startswith(site.accounts_url + site.country_marker))
    code = F.upper(urls.url_tail(F.col("url"), site.country_marker))
    found = from_latest(extraction.extract_sections(country_pages, site, code), country_pages)
    rows = found.withColumnRenamed("section_country", "country_code")
    rows = lookup_join(rows, countries.select("country_code"), "country_code", "left_semi")
    rows = upsert.latest_per_key(rows, ["accounts_platform_slug"], ["url", "position"])
    return rows.drop("url", "position", "page_id")


def _details(pages: DataFrame, site: Site) -> DataFrame:
    marker = site.accounts_url + site.section_marker
    section_pages = pages.filter(F.col("url").startswith(marker))
    found = extraction.extract_section_details(section_pages, site)
    key = urls.url_tail(F.col("url"), site.section_marker)
    rows = found.withColumn("accounts_platform_slug", key)
    # A section page landed twice would double the section.
    rows = upsert.latest_per_key(rows, ["accounts_platform_slug"], ["page_id"])
    return rows.drop("url", "page_id")


def _reachable(sections: DataFrame, answers: DataFrame, site: Site) -> DataFrame:
    slug = "activities_platform_slug"
    pattern = rf"^\Q{site.activities_url}\E/organisation/([^/]+)/activities$"
    probed = answers.select(F.regexp_extract("url", pattern, 1).alias(slug), "status")
    return selection.reachable(sections, probed.filter(F.col(slug) != ""), slug)
