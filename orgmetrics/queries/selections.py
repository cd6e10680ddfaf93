"""Work queues, lookups, search and result pages (C, G)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from orgmetrics.functions import dates
from orgmetrics.operators import constraints, selection
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query
from orgmetrics.queries.tables import read_table
from orgmetrics.schemas import ACTIVITIES, COUNTRIES, SECTIONS

_SECTION = ["id", "name", "country_code", "can_scrape_activities", "last_scraped"]
_SECTION_SQL = ", ".join(_SECTION)


@query(f"""WITH {t.SECTIONS} SELECT {_SECTION_SQL} FROM visited WHERE can_scrape_activities
ORDER BY last_scraped ASC NULLS FIRST, id LIMIT 25""")
def scrape_queue(spark, sf):
    return selection.scrape_queue(t.sections(spark, sf).select(*_SECTION), 25)


@query(f"""WITH {t.SECTIONS} SELECT {_SECTION_SQL} FROM visited ORDER BY last_scraped ASC NULLS FIRST, id""")
def stalest_sections(spark, sf):
    """A limit of 0 means no limit."""
    return selection.stalest_sections(t.sections(spark, sf).select(*_SECTION), 0)


@query(f"WITH {t.SECTIONS} SELECT id, name, country_code FROM sections WHERE can_scrape_activities = true")
def eligible_sections(spark, sf):
    rows = t.sections(spark, sf, visits=False)
    return selection.eligible_sections(rows).select("id", "name", "country_code")


@query(f"""WITH {t.SECTIONS} SELECT id, name, activities_platform_slug FROM sections
WHERE activities_platform_slug = (SELECT lower(replace(max(s_name), '#', '-')) FROM supplier)""")
def section_by_slug(spark, sf):
    """The section with the greatest slug."""
    rows = t.sections(spark, sf, visits=False).select("id", "name", "activities_platform_slug")
    greatest = rows.agg(F.max("activities_platform_slug").alias("slug")).scalar()
    return selection.section_by_slug(rows, greatest)


@query(f"""WITH {t.SECTIONS} SELECT id, name, last_scraped FROM visited
WHERE last_scraped IS NULL OR last_scraped < TIMESTAMP '2001-11-01' - INTERVAL 7 DAY""")
def stale_sections(spark, sf):
    rows = t.sections(spark, sf).select("id", "name", "last_scraped")
    return selection.stale_sections(rows, t.as_of_time("2001-11-01 00:00:00"))


@query(f"""WITH {t.SECTIONS}, stored AS (SELECT id, can_scrape_activities FROM sections WHERE s_acctbal < 8000)
SELECT c.id, c.name, CASE WHEN s.id IS NULL THEN 'new' ELSE 'unverified' END AS reason
FROM sections c LEFT JOIN stored s USING (id) WHERE s.id IS NULL OR s.can_scrape_activities IS NULL""")
def sections_to_verify(spark, sf):
    """Sections with a balance from 8000 have not been stored yet."""
    rows = t.sections(spark, sf, visits=False)
    stored = rows.filter("s_acctbal < 8000")
    return selection.sections_to_verify(rows.select("id", "name"), stored, "id")


@query(f"""WITH {t.RUNS}, s AS (SELECT count(*) AS n_sections FROM supplier),
d AS (SELECT max(completed_at) AS last_completed FROM runs WHERE scraper_module = 'accounts' AND status = 'completed'),
j AS (SELECT *, CASE WHEN n_sections = 0 THEN 'no sections' WHEN last_completed IS NULL THEN 'never completed'
      WHEN last_completed < TIMESTAMP '{t.AS_OF_TIME}' - INTERVAL 30 DAY THEN 'last run too old' END AS reason FROM s, d)
SELECT n_sections, last_completed, reason, reason IS NOT NULL AS due FROM j""")
def refresh_due(spark, sf):
    rows = read_table(spark, sf, "supplier")
    return selection.refresh_due(rows, t.runs(spark, sf), t.as_of_time())


_TAGGED = f"""{t.ACTIVITIES}, {t.COUNTRIES},
tagged AS (
  SELECT a.*, country_code, start_date > DATE '{t.AS_OF_DATE}' AS is_future_event, organisers, causes, sdgs
  FROM activities a JOIN customer ON c_custkey = o_custkey JOIN countries ON n_nationkey = c_nationkey
  JOIN (SELECT l_orderkey, list(DISTINCT n.n_name) AS organisers, list(DISTINCT p_brand) AS causes, list(DISTINCT p_size) AS sdgs
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation n ON n.n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey GROUP BY 1) l ON l_orderkey = a.id)"""


def _tagged(spark, sf):
    """Activities with the arrays they carry in flight; their organisers are national bodies."""
    from orgmetrics.operators.joins import lookup_join

    lines = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey")
    )
    hosts = read_table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("host")
    )
    suppliers = read_table(spark, sf, "supplier").join(hosts, "s_nationkey")
    lines = lookup_join(lines, suppliers.select("s_suppkey", "host"), "s_suppkey")
    lines = lookup_join(lines, read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), "p_partkey")
    # Sets per activity are bounded by the vocabularies they are drawn from.
    lists = lines.groupBy("id").agg(
        F.collect_set("host").alias("organisers"),
        F.collect_set("p_brand").alias("causes"),
        F.collect_set("p_size").alias("sdgs"),
    )
    homes = t.countries(spark, sf).select(F.col("n_nationkey").alias("c_nationkey"), "country_code")
    customers = read_table(spark, sf, "customer").join(homes, "c_nationkey")
    customers = customers.select(F.col("c_custkey").alias("o_custkey"), "country_code")
    rows = t.activities(spark, sf).withColumn(
        "is_future_event", dates.is_future_event(F.col("start_date"), t.as_of_date())
    )
    return lookup_join(rows, customers, "o_custkey").join(lists, "id")


@query(f"""WITH {_TAGGED}
SELECT id, title, start_date, country_code, participants FROM tagged
WHERE contains(lower(title), 'customer 1') AND start_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND activity_type = '2-HIGH' AND participants BETWEEN 500 AND 9000 AND is_valid
  AND list_has_any(causes, ['Brand#3', 'Brand#7', 'Brand#12']) AND list_has_any(sdgs, [3, 4, 5, 6, 7, 8, 9])""")
def activity_search(spark, sf):
    search = selection.ActivitySearch(
        title="Customer 1",
        start_date_from=dt.date(1996, 1, 1),
        start_date_to=dt.date(2000, 12, 31),
        activity_type="2-HIGH",
        min_participants=500,
        max_participants=9000,
        is_valid=True,
        causes=["Brand#3", "Brand#7", "Brand#12"],
        sdgs=[3, 4, 5, 6, 7, 8, 9],
    )
    found = selection.activity_search(_tagged(spark, sf), search)
    return found.select("id", "title", "start_date", "country_code", "participants")


@query(f"""WITH {_TAGGED}
SELECT id, country_code, start_date, is_future_event FROM tagged
WHERE country_code = 'AA' AND is_future_event AND list_has_any(organisers, ['NATION_1', 'NATION_2'])""")
def activity_search_by_place(spark, sf):
    search = selection.ActivitySearch(
        country_code="AA",
        is_future_event=True,
        organisers=["NATION_1", "NATION_2"],
    )
    found = selection.activity_search(_tagged(spark, sf), search)
    return found.select("id", "country_code", "start_date", "is_future_event")


@query(f"""WITH {t.ACTIVITIES} SELECT event_slug, title, start_date, participants, activity_type,
start_date > DATE '{t.AS_OF_DATE}' AS is_future_event, true AS is_valid FROM activities""")
def create_projection(spark, sf):
    """New activities: input fields, the computed flag, and defaults."""
    return t.activities(spark, sf).select(
        "event_slug",
        "title",
        "start_date",
        "participants",
        "activity_type",
        dates.is_future_event(F.col("start_date"), t.as_of_date()).alias("is_future_event"),
        F.lit(True).alias("is_valid"),
    )


@query(f"""WITH {t.COUNTRIES} SELECT country_code, name, slug, url, 0 AS section_count FROM countries""")
def create_countries(spark, sf):
    """New countries: the schema's columns that are not generated, with its defaults."""
    return constraints.create_projection(t.countries(spark, sf), COUNTRIES)


@query(f"""WITH {t.SECTIONS} SELECT accounts_platform_slug, country_code, name, activities_platform_slug, can_scrape_activities,
CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS email FROM sections""")
def create_sections(spark, sf):
    made = constraints.create_projection(t.sections(spark, sf, visits=False), SECTIONS)
    shown = ("accounts_platform_slug", "country_code", "name", "activities_platform_slug", "can_scrape_activities", "city", "email")
    return made.select(*shown)


@query(f"""WITH {t.ACTIVITIES} SELECT event_slug, title, start_date, participants, activity_type, CAST(NULL AS VARCHAR) AS description,
start_date > DATE '{t.AS_OF_DATE}' AS is_future_event, coalesce(CASE WHEN is_valid THEN NULL ELSE false END, true) AS is_valid FROM activities""")
def create_activities(spark, sf):
    """The flag follows from the date; a validity that was not given is the schema's default."""
    given = t.activities(spark, sf).withColumn("is_valid", F.when(~F.col("is_valid"), False))
    computed = {"is_future_event": dates.is_future_event(F.col("start_date"), t.as_of_date())}
    made = constraints.create_projection(given, ACTIVITIES, computed)
    shown = ("event_slug", "title", "start_date", "participants", "activity_type", "description", "is_future_event", "is_valid")
    return made.select(*shown)


_BUSIEST = "(SELECT min(l_suppkey) FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem))"


@query(f"""WITH {t.ACTIVITIES}, {t.LINKS}
SELECT id, title, start_date FROM activities
WHERE start_date BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'
  AND id IN (SELECT activity_id FROM links WHERE section_id = {_BUSIEST})
ORDER BY start_date, id LIMIT 20 OFFSET 20""")
def section_activities_page(spark, sf):
    """Second page of the activities of the section that shipped last."""
    lines = read_table(spark, sf, "lineitem")
    latest = lines.agg(F.max("l_shipdate").alias("d")).scalar()
    section = lines.filter(F.col("l_shipdate") == latest).agg(F.min("l_suppkey").alias("s")).scalar()
    found = selection.section_activities(
        t.links(spark, sf),
        t.activities(spark, sf),
        section,
        dt.date(1997, 1, 1),
        dt.date(2000, 12, 31),
    )
    return selection.page_of(found.select("id", "title", "start_date"), ["start_date", "id"], 2, 20)


@query(f"""WITH {t.ACTIVITIES} SELECT id, title, start_date FROM activities
WHERE (start_date, id) > (DATE '1998-06-15', 100) ORDER BY start_date, id LIMIT 20""")
def activities_page_after(spark, sf):
    """Deep pages by position instead of by offset."""
    rows = t.activities(spark, sf).select("id", "title", "start_date")
    return selection.page_after(rows, ["start_date", "id"], [dt.date(1998, 6, 15), 100], 20)


@query(f"""WITH {t.SECTIONS} SELECT id, name, country_code FROM sections WHERE country_code = 'BG'""")
def country_sections(spark, sf):
    rows = t.sections(spark, sf, visits=False).filter(F.col("country_code") == "BG")
    return rows.select("id", "name", "country_code")


@query(f"WITH {t.COUNTRIES} SELECT country_code, name, slug, url FROM countries")
def list_countries(spark, sf):
    return t.countries(spark, sf).select("country_code", "name", "slug", "url")


@query(f"WITH {t.ACTIVITIES} SELECT id, title, start_date FROM activities WHERE is_valid = false")
def invalid_activities(spark, sf):
    return t.activities(spark, sf).filter(~F.col("is_valid")).select("id", "title", "start_date")


@query(f"""WITH {t.ACTIVITIES} SELECT id, start_date, start_date > DATE '{t.AS_OF_DATE}' AS is_future_event FROM activities""")
def future_flag(spark, sf):
    flag = dates.is_future_event(F.col("start_date"), t.as_of_date())
    return t.activities(spark, sf).select("id", "start_date", flag.alias("is_future_event"))


@query(f"""WITH {t.ERROR_LOG} SELECT * FROM error_log ORDER BY created_at DESC NULLS LAST, id DESC LIMIT 100""")
def recent_errors(spark, sf):
    return selection.newest(t.error_log(spark, sf), "created_at", "id", 100)
