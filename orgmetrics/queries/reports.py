"""Reports, run summaries, gates and service levels (E, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orgmetrics.functions.fetch import classify_fetch
from orgmetrics.operators import quality
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query
from orgmetrics.queries.tables import read_table


@query(f"""WITH {t.SECTIONS}, {t.ACTIVITIES}, {t.LINKS}
SELECT s.id, s.name, s.country_code, c.name AS country, count(a.id) AS n_activities,
       count(*) FILTER (is_valid) AS n_valid, CAST(coalesce(sum(participants), 0) AS BIGINT) AS participants,
       count(DISTINCT activity_type) AS n_types, round(avg(participants), 2) AS mean_participants,
       min(start_date) AS first_activity, max(start_date) AS last_activity
FROM sections s JOIN countries c USING (country_code)
LEFT JOIN links l ON l.section_id = s.id LEFT JOIN activities a ON a.id = l.activity_id
GROUP BY ALL""")
def section_report(spark, sf):
    return quality.section_report(
        t.sections(spark, sf, visits=False),
        t.countries(spark, sf),
        t.links(spark, sf),
        t.activities(spark, sf),
    )


@query(f"""WITH {t.SECTIONS}, {t.ACTIVITIES}, {t.LINKS}
SELECT country_code, CAST(date_trunc('quarter', start_date) AS DATE) AS period, count(*) AS n_activities,
       CAST(sum(participants) AS BIGINT) AS participants
FROM (SELECT DISTINCT country_code, activity_id FROM links JOIN sections ON sections.id = section_id)
JOIN activities ON activities.id = activity_id GROUP BY 1, 2""")
def country_trend(spark, sf):
    return quality.country_trend(
        t.sections(spark, sf, visits=False), t.links(spark, sf), t.activities(spark, sf)
    )


def _accounts_summary(spark, sf):
    return quality.accounts_run_summary(
        t.countries(spark, sf), t.sections(spark, sf, visits=False), t.error_log(spark, sf)
    )


_ACCOUNTS = f"""{t.SECTIONS}, {t.ERROR_LOG},
summary AS (SELECT (SELECT count(*) FROM countries) AS countries_processed, count(*) AS sections_processed,
                   count(*) FILTER (can_scrape_activities) AS sections_validated,
                   (SELECT count(*) FROM error_log) AS errors FROM sections)"""


@query(f"WITH {_ACCOUNTS} SELECT * FROM summary")
def accounts_run_summary(spark, sf):
    return _accounts_summary(spark, sf)


@query(f"""WITH {_ACCOUNTS}, r AS (
SELECT *, CASE WHEN sections_processed > 0 THEN sections_validated / sections_processed ELSE 0 END AS validation_rate,
       CASE WHEN countries_processed < 40 THEN 'too few countries' WHEN sections_processed < 400 THEN 'too few sections'
            WHEN sections_processed > 0 AND sections_validated / sections_processed < 0.7 THEN 'low validation rate'
            WHEN errors > sections_processed * 0.1 THEN 'too many errors' END AS reason FROM summary)
SELECT countries_processed, sections_processed, sections_validated, errors, round(validation_rate, 4) AS validation_rate,
       reason, reason IS NULL AS passed FROM r""")
def quality_gate_accounts(spark, sf):
    gate = quality.accounts_gate(_accounts_summary(spark, sf))
    return gate.withColumn("validation_rate", F.round("validation_rate", 4))


def _activity_summary(spark, sf):
    """A run over all sections; error events stand for its failed sections."""
    late = read_table(spark, sf, "events").filter("event_type = 'error'")
    statistics = read_table(spark, sf, "lineitem").select("l_suppkey").distinct()
    return quality.activity_run_summary(
        read_table(spark, sf, "supplier"), t.links(spark, sf), statistics, late
    )


_ACTIVITY = f"""{t.LINKS},
summary AS (SELECT (SELECT count(*) FROM supplier) AS sections_processed, (SELECT count(*) FROM links) AS activities_processed,
                   (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS statistics_processed,
                   (SELECT count(*) FROM events WHERE event_type = 'error') AS errors)"""


@query(f"WITH {_ACTIVITY} SELECT * FROM summary")
def activity_run_summary(spark, sf):
    return _activity_summary(spark, sf)


@query(f"""WITH {_ACTIVITY}, r AS (
SELECT *, coalesce(activities_processed / nullif(sections_processed, 0), 0) AS average_activities,
       CASE WHEN sections_processed = 0 THEN 'no sections'
            WHEN activities_processed / nullif(sections_processed, 0) < 5 THEN 'too few activities'
            WHEN errors > sections_processed * 0.2 THEN 'too many errors' END AS reason FROM summary)
SELECT sections_processed, activities_processed, statistics_processed, errors, round(average_activities, 4) AS average_activities,
       reason, reason IS NULL AS passed FROM r""")
def quality_gate_activities(spark, sf):
    gate = quality.activities_gate(_activity_summary(spark, sf))
    return gate.withColumn("average_activities", F.round("average_activities", 4))


@query(f"""WITH {t.FETCH_LOG}
SELECT count(*) AS requests_made, count(*) FILTER (status = 200) AS requests_successful,
       count(*) FILTER (status IS NULL OR status <> 200) AS requests_failed,
       count(*) FILTER (attempt > 0) AS retries_performed FROM fetch_log""")
def request_counters(spark, sf):
    return quality.request_counters(t.fetch_log(spark, sf))


@query(f"""WITH {t.FETCH_LOG}
SELECT event_type, min(ts) AS started_at, max(ts) AS ended_at,
       CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS duration_seconds
FROM fetch_log GROUP BY 1""")
def run_duration(spark, sf):
    return quality.run_duration(t.fetch_log(spark, sf), "event_type")


@query(f"""WITH {t.FETCH_LOG}, c AS (SELECT count(DISTINCT section_id) AS sections_processed,
       CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS seconds FROM fetch_log)
SELECT sections_processed, seconds, round(sections_processed * 3600.0 / seconds, 4) AS per_hour FROM c""")
def sections_per_hour(spark, sf):
    found = quality.sections_per_hour(t.fetch_log(spark, sf), "section_id")
    return found.withColumn("per_hour", F.round("per_hour", 4))


@query(f"""WITH {t.ACTIVITIES}
SELECT activity_type, count(*) AS processed, count(*) FILTER (is_valid) AS inserted,
       round(count(*) FILTER (is_valid) * 100.0 / count(*), 4) AS quality_score FROM activities GROUP BY 1""")
def quality_score(spark, sf):
    counted = t.activities(spark, sf).groupBy("activity_type").agg(
        F.count("*").alias("processed"), F.count_if("is_valid").alias("inserted")
    )
    score = quality.quality_score(F.col("inserted"), F.col("processed"))
    return counted.withColumn("quality_score", F.round(score, 4))


@query(f"""WITH {t.ACTIVITIES}, {t.FAILED_PAGES}
SELECT (SELECT count(*) FROM activities WHERE is_valid = false) AS invalid_activities,
       (SELECT count(*) FROM failed_pages WHERE last_attempt > TIMESTAMP '2024-01-20' - INTERVAL 1 HOUR) AS recent_errors,
       (SELECT count(*) FROM failed_pages WHERE will_retry) AS pending_retries,
       (SELECT round(avg(participants), 2) FROM activities WHERE participants > 0) AS mean_participants""")
def quality_checks(spark, sf):
    checks = quality.quality_checks(
        t.activities(spark, sf),
        t.error_log(spark, sf),
        t.failed_pages(spark, sf),
        t.as_of_time("2024-01-20 00:00:00"),
    )
    return checks.withColumn("mean_participants", F.round("mean_participants", 2))


def _rates(spark, sf):
    ok = classify_fetch(F.col("status"), F.col("body")) == "ok"
    return quality.success_by_section(t.fetch_log(spark, sf), "section_id", ok)


_RATES = f"""{t.FETCH_LOG},
rates AS (SELECT section_id, count(*) AS requests, count(*) FILTER (status = 200) AS successes,
                 round(count(*) FILTER (status = 200) / count(*), 4) AS success_rate FROM fetch_log GROUP BY 1)"""


@query(f"WITH {_RATES} SELECT * FROM rates")
def success_by_section(spark, sf):
    return _rates(spark, sf).withColumn("success_rate", F.round("success_rate", 4))


@query(f"WITH {_RATES} SELECT section_id, requests, successes FROM rates WHERE successes / requests < 0.8")
def success_alert(spark, sf):
    return quality.success_alert(_rates(spark, sf)).drop("success_rate")


@query(f"""WITH {t.FETCH_LOG}
SELECT CASE WHEN error = 'Malformed JSON' THEN 'parsing' WHEN error = 'Constraint violation' THEN 'database'
            WHEN error IN ('HTTP request failed', 'Timeout while reading') THEN 'http' ELSE 'other' END AS kind,
       count(*) AS n_errors
FROM fetch_log WHERE event_type = 'error' GROUP BY 1""")
def errors_by_kind(spark, sf):
    return quality.errors_by_kind(t.error_log(spark, sf))


@query(f"""WITH {t.SECTIONS}
SELECT count(*) AS n_rows, count(*) FILTER (can_scrape_activities IS NOT NULL AND last_scraped IS NOT NULL) AS n_complete,
       round(avg(CASE WHEN can_scrape_activities IS NOT NULL AND last_scraped IS NOT NULL THEN 1.0 ELSE 0 END), 4) AS coverage,
       round(avg(CASE WHEN can_scrape_activities IS NOT NULL THEN 1.0 ELSE 0 END), 4) AS can_scrape_activities_share,
       round(avg(CASE WHEN last_scraped IS NOT NULL THEN 1.0 ELSE 0 END), 4) AS last_scraped_share
FROM visited""")
def data_coverage(spark, sf):
    rows = t.sections(spark, sf)
    found = quality.data_coverage(rows, ["can_scrape_activities", "last_scraped"])
    shares = ["coverage", "can_scrape_activities_share", "last_scraped_share"]
    return found.select("n_rows", "n_complete", *(F.round(c, 4).alias(c) for c in shares))


@query(f"""WITH {t.SECTIONS}, {t.ACTIVITIES}, {t.FETCH_LOG}, v AS (
SELECT (SELECT avg(CASE WHEN last_scraped IS NOT NULL THEN 1.0 ELSE 0 END) FROM visited) AS coverage,
       (SELECT avg(CASE WHEN is_valid THEN 0 ELSE 1.0 END) FROM activities) AS invalid,
       (SELECT avg(CASE WHEN status = 200 THEN 1.0 ELSE 0 END) FROM fetch_log) AS http)
SELECT 'coverage' AS measure, round(coverage, 4) AS value, CAST(0.95 AS DOUBLE) AS threshold, coverage > 0.95 AS met FROM v
UNION ALL SELECT 'validation_errors', round(invalid, 4), 0.02, invalid < 0.02 FROM v
UNION ALL SELECT 'http_success', round(http, 4), 0.95, http > 0.95 FROM v""")
def sla_report(spark, sf):
    coverage = quality.data_coverage(t.sections(spark, sf), ["last_scraped"])
    invalid = t.activities(spark, sf).agg(F.avg((~F.col("is_valid")).cast("double")).alias("v"))
    requests = quality.request_counters(t.fetch_log(spark, sf)).select(
        quality.share(F.col("requests_successful"), F.col("requests_made")).alias("v")
    )
    row = coverage.select(
        "coverage", invalid.scalar().alias("invalid"), requests.scalar().alias("http")
    )
    report = quality.sla_report(F.col("coverage"), F.col("invalid"), F.col("http"), row)
    return report.withColumn("value", F.round("value", 4))
