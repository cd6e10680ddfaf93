"""Work queues, lookups, search and pages of results."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.operators.joins import lookup_join


def eligible_sections(sections: DataFrame) -> DataFrame:
    """Sections known to have a reachable activities page; never-checked ones are left out."""
    return sections.filter(F.col("can_scrape_activities"))


def stalest_sections(sections: DataFrame, limit: int | None = None, tie: str = "id") -> DataFrame:
    """Never-visited sections first, then the longest unvisited. ``None`` or 0 means no limit."""
    ordered = sections.orderBy(F.asc_nulls_first("last_scraped"), tie)
    return ordered.limit(limit) if limit else ordered


def scrape_queue(sections: DataFrame, limit: int | None = None, tie: str = "id") -> DataFrame:
    return stalest_sections(eligible_sections(sections), limit, tie)


def section_by_slug(sections: DataFrame, slug: str | Column, tie: str = "id") -> DataFrame:
    """Zero or one row."""
    wanted = F.lit(slug) if isinstance(slug, str) else slug
    return sections.filter(F.col("activities_platform_slug") == wanted).orderBy(tie).limit(1)


def sections_to_verify(crawled: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Crawled sections that are new, or stored without a reachability verdict."""
    verdicts = stored.select(key, "can_scrape_activities").withColumn("_stored", F.lit(True))
    joined = crawled.join(verdicts, key, "left")
    unsure = F.col("_stored").isNull() | F.col("can_scrape_activities").isNull()
    reason = F.when(F.col("_stored").isNull(), "new").otherwise("unverified")
    return joined.filter(unsure).select(*crawled.columns, reason.alias("reason"))


def section_diff(crawled: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Every key of either side with its state: new, gone or kept."""
    now = crawled.select(key).distinct().withColumn("_now", F.lit(True))
    before = stored.select(key).distinct().withColumn("_before", F.lit(True))
    state = (
        F.when(F.col("_before").isNull(), "new").when(F.col("_now").isNull(), "gone").otherwise("kept")
    )
    return now.join(before, key, "full_outer").select(key, state.alias("state"))


def stale_sections(sections: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Sections not visited within ``days``, or never."""
    old = F.col("last_scraped") < as_of - F.make_dt_interval(F.lit(days))
    return sections.filter(F.col("last_scraped").isNull() | old)


def refresh_due(sections: DataFrame, runs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """One row: whether the accounts run must start, and why."""
    done = runs.filter((F.col("scraper_module") == "accounts") & (F.col("status") == "completed"))
    counted = sections.agg(F.count("*").alias("n_sections"))
    with_run = counted.withColumn(
        "last_completed", done.agg(F.max("completed_at").alias("last")).scalar()
    )
    limit = as_of - F.make_dt_interval(F.lit(days))
    reason = (
        F.when(F.col("n_sections") == 0, "no sections")
        .when(F.col("last_completed").isNull(), "never completed")
        .when(F.col("last_completed") < limit, "last run too old")
    )
    return with_run.withColumn("reason", reason).withColumn("due", F.col("reason").isNotNull())


@dataclass(frozen=True)
class ActivitySearch:
    """Optional conditions; those left at ``None`` do not apply."""

    title: str | None = None
    start_date_from: dt.date | None = None
    start_date_to: dt.date | None = None
    city: str | None = None
    country_code: str | None = None
    activity_type: str | None = None
    min_participants: int | None = None
    max_participants: int | None = None
    is_future_event: bool | None = None
    organisers: list[str] | None = None
    causes: list[str] | None = None
    sdgs: list[int] | None = None
    is_valid: bool | None = None

    def conditions(self) -> list[Column]:
        c = F.col
        found = []
        if self.title is not None:
            found.append(F.lower(c("title")).contains(self.title.lower()))
        if self.start_date_from is not None:
            found.append(c("start_date") >= F.lit(self.start_date_from))
        if self.start_date_to is not None:
            found.append(c("start_date") <= F.lit(self.start_date_to))
        if self.min_participants is not None:
            found.append(c("participants") >= self.min_participants)
        if self.max_participants is not None:
            found.append(c("participants") <= self.max_participants)
        for field in ("city", "country_code", "activity_type", "is_future_event", "is_valid"):
            if getattr(self, field) is not None:
                found.append(c(field) == F.lit(getattr(self, field)))
        for field in ("organisers", "causes", "sdgs"):
            if getattr(self, field) is not None:
                wanted = F.array(*(F.lit(x) for x in getattr(self, field)))
                found.append(F.arrays_overlap(c(field), wanted))
        return found


def activity_search(activities: DataFrame, search: ActivitySearch) -> DataFrame:
    """Activities that meet every given condition; the conditions reach the Parquet scan."""
    for condition in search.conditions():
        activities = activities.filter(condition)
    return activities


def section_activities(
    links: DataFrame,
    activities: DataFrame,
    section_id: int | Column,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Activities that one section organises, within an inclusive range of start dates."""
    wanted = F.lit(section_id) if isinstance(section_id, int) else section_id
    own = links.filter(F.col("section_id") == wanted).select("activity_id").distinct()
    if start is not None:
        activities = activities.filter(F.col("start_date") >= F.lit(start))
    if end is not None:
        activities = activities.filter(F.col("start_date") <= F.lit(end))
    return activities.join(own.withColumnRenamed("activity_id", "id"), "id", "left_semi")


def page_of(df: DataFrame, order: list[str], page: int = 1, limit: int = 20) -> DataFrame:
    """One page of results, 1-based, under a total order."""
    return df.orderBy(*order).offset((page - 1) * limit).limit(limit)


def page_after(df: DataFrame, order: list[str], last: list, limit: int = 20) -> DataFrame:
    """The page after the row whose ``order`` values are ``last``: no skipped rows to sort."""
    beyond, equal = F.lit(False), F.lit(True)
    for name, value in zip(order, last):
        beyond = beyond | (equal & (F.col(name) > F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    # The bound on the leading column alone is what a Parquet scan can skip row groups with.
    return df.filter(F.col(order[0]) >= F.lit(last[0])).filter(beyond).orderBy(*order).limit(limit)


def newest(df: DataFrame, stamp: str, tie: str, limit: int = 100) -> DataFrame:
    return df.orderBy(F.desc(stamp), F.desc(tie)).limit(limit)


def country_code_lookup(
    df: DataFrame, codes: DataFrame, name: str, code: str = "country_code", default: str = "XX"
) -> DataFrame:
    """Country code by country name, ``default`` for unknown names."""
    joined = lookup_join(df, codes.select(name, F.col(code).alias("_code")), name, "left")
    return joined.select(*df.columns, F.coalesce("_code", F.lit(default)).alias(code))


def merge_details(base: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Detail fields over listing fields; a missing detail keeps the listing's value."""
    shared = [c for c in details.columns if c != key and c in base.columns]
    extra = [c for c in details.columns if c != key and c not in base.columns]
    renamed = details.select(key, *(F.col(c).alias(f"_{c}") for c in shared), *extra)
    return base.join(renamed, key, "left").select(
        *(F.coalesce(f"_{c}", c).alias(c) if c in shared else F.col(c) for c in base.columns),
        *extra,
    )


def reachable(sections: DataFrame, answers: DataFrame, slug: str) -> DataFrame:
    """Set ``can_scrape_activities``: the slug's page answered 200; an empty slug never does."""
    good = answers.filter(F.col("status") == 200).select(slug).distinct()
    joined = lookup_join(sections, good.withColumn("_ok", F.lit(True)), slug, "left")
    verdict = F.coalesce(F.col("_ok") & (F.col(slug) != ""), F.lit(False))
    kept = [c for c in sections.columns if c != "can_scrape_activities"]
    return joined.select(*kept, verdict.alias("can_scrape_activities"))


def links_by_name(
    owners: DataFrame, owner: str, names: str, lookup: DataFrame, link: str
) -> DataFrame:
    """(owner, link) pairs for an array of names; names the lookup lacks drop out."""
    wanted = owners.select(owner, F.explode(names).alias("name")).distinct()
    known = lookup.select("name", F.col("id").alias(link))
    return lookup_join(wanted, known, "name").select(owner, link).distinct()


def organiser_links(
    activities: DataFrame, sections: DataFrame, normalise, activity: str = "activity_id"
) -> DataFrame:
    """(activity, section) pairs, organiser names matched to section names after ``normalise``.

    Sections that share a name are all linked.
    """
    wanted = activities.select(activity, F.explode("organisers").alias("_name"))
    # Both sides are distinct before they meet, so their pairs are: the links, which grow with the
    # sections of a name, are never shuffled.
    pairs = wanted.join(_name_keys(wanted.select("_name"), normalise), "_name").select(activity, "_key").distinct()
    known = _section_keys(sections, normalise).distinct()
    return pairs.join(known, "_key").select(activity, "section_id")


def _name_keys(names: DataFrame, normalise) -> DataFrame:
    """(organiser name as printed, key). Only distinct names are normalised, never each row."""
    # Never NULL: the join would else test the key for NULL, normalising every name twice.
    key = F.coalesce(normalise(F.col("_name")), F.lit("")).alias("_key")
    return names.distinct().select("_name", key)


def _section_keys(sections: DataFrame, normalise) -> DataFrame:
    """(key, section); the key of a name without letters and digits is NULL and meets none."""
    # A filter on the key would be inferred for the organisers too and normalise the name of every row.
    key = F.nullif(normalise(F.col("name")), F.lit("")).alias("_key")
    return sections.select(key, F.col("id").alias("section_id"))


def unknown_organisers(
    activities: DataFrame, sections: DataFrame, normalise, activity: str = "activity_id"
) -> DataFrame:
    """(activity, organiser) of the names that no section has."""
    wanted = activities.select(activity, F.explode("organisers").alias("_name")).distinct()
    known = _name_keys(wanted.select("_name"), normalise).join(_section_keys(sections, normalise), "_key")
    known = known.select("_name").distinct()
    rest = wanted.join(known, "_name", "left_anti")
    return rest.select(activity, F.col("_name").alias("organiser"))
