"""Fetch outcomes, failure and run logs, retries (A10-A12, I28-I30, K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orgmetrics.functions import fetch
from orgmetrics.operators import runlog
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query

_OUTCOME = """CASE WHEN status = 200 THEN 'ok' WHEN status = 429 THEN 'rate_limit'
  WHEN status = 403 AND lower(body) LIKE '%cloudflare%' THEN 'blocked' WHEN status = 404 THEN 'not_found'
  WHEN status IS NULL THEN 'no_response' ELSE 'other' END"""


@query(f"""WITH {t.FETCH_LOG} SELECT event_id, status, {_OUTCOME} AS outcome,
CASE WHEN {_OUTCOME} NOT IN ('rate_limit', 'blocked', 'no_response') THEN CASE WHEN status = 404 THEN '' ELSE body END END AS body
FROM fetch_log""")
def classify_fetch(spark, sf):
    status, body = F.col("status"), F.col("body")
    return t.fetch_log(spark, sf).select(
        "event_id",
        "status",
        fetch.classify_fetch(status, body).alias("outcome"),
        fetch.kept_body(status, body).alias("body"),
    )


@query(f"""WITH {t.FETCH_LOG}
SELECT url, section_id, 'activities' AS scraper_module, status AS http_status_code, coalesce(error, {_OUTCOME}) AS error_message,
       0 AS retry_count, ts AS last_attempt, true AS will_retry
FROM fetch_log WHERE {_OUTCOME} <> 'ok'""")
def failed_page_rows(spark, sf):
    return runlog.failed_page_rows(t.fetch_log(spark, sf), "activities", F.col("section_id"))


@query(f"""WITH {t.FETCH_LOG}, r AS (
SELECT section_id, min(ts) AS first, CASE WHEN count(*) > 1 THEN max(ts) END AS last, count(*) AS n,
       count(*) FILTER (event_type = 'error') AS f FROM fetch_log GROUP BY 1)
SELECT 'activities' AS scraper_module,
       CASE WHEN f > n / 2 THEN 'failed' WHEN last IS NULL THEN 'running' ELSE 'completed' END AS status,
       first AS started_at, last AS completed_at, n AS sections_processed, f AS sections_failed,
       CASE WHEN f > n / 2 THEN 'more than half failed' END AS error_message,
       '{{"section_id":' || section_id || ',"requests":' || n || '}}' AS metadata
FROM r""")
def run_status_rows(spark, sf):
    """One run per section of the fetch log; a run with a single request is still going on."""
    runs = t.fetch_log(spark, sf).groupBy("section_id").agg(
        F.min("ts").alias("first"),
        F.when(F.count("*") > 1, F.max("ts")).alias("last"),
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "error").alias("failed"),
    )
    bad = F.when(F.col("failed") > F.col("n") / 2, "more than half failed")
    return runlog.run_status_rows(
        runs,
        "activities",
        F.col("first"),
        F.col("last"),
        F.col("n"),
        F.col("failed"),
        bad,
        section_id=F.col("section_id"),
        requests=F.col("n"),
    )


@query(f"WITH {t.FAILED_PAGES} SELECT * FROM failed_pages WHERE retry_count >= 3")
def exhausted_retries(spark, sf):
    return runlog.exhausted_retries(t.failed_pages(spark, sf))


@query(f"WITH {t.FAILED_PAGES} SELECT * FROM failed_pages WHERE will_retry")
def retry_queue(spark, sf):
    return runlog.retry_queue(t.failed_pages(spark, sf))


@query(f"""WITH {t.FAILED_PAGES}
SELECT id, retry_count, last_attempt, last_attempt + to_seconds(CAST(pow(2, retry_count) AS BIGINT)) AS next_attempt FROM failed_pages""")
def retry_schedule(spark, sf):
    found = runlog.retry_schedule(t.failed_pages(spark, sf))
    return found.select("id", "retry_count", "last_attempt", "next_attempt")


@query(f"""WITH {t.FAILED_PAGES}
SELECT id, retry_count, last_attempt + to_seconds(CAST(pow(2, retry_count) AS BIGINT)) AS next_attempt FROM failed_pages
WHERE will_retry AND retry_count < 3 AND last_attempt + to_seconds(CAST(pow(2, retry_count) AS BIGINT)) <= TIMESTAMP '2024-01-10'""")
def retry_due(spark, sf):
    due = runlog.retry_due(t.failed_pages(spark, sf), t.as_of_time("2024-01-10 00:00:00"))
    return due.select("id", "retry_count", "next_attempt")


@query(f"""WITH {t.FETCH_LOG}, k AS (
SELECT event_id, error, CASE WHEN error = 'Malformed JSON' THEN 'parsing' WHEN error = 'Constraint violation' THEN 'database'
       WHEN error IN ('HTTP request failed', 'Timeout while reading') THEN 'http' ELSE 'other' END AS kind
FROM fetch_log WHERE event_type = 'error')
SELECT event_id AS id, kind, CASE kind WHEN 'http' THEN 'failed_scrapes' WHEN 'parsing' THEN 'validation_errors'
       ELSE 'scraper_status' END AS log_table FROM k""")
def error_routes(spark, sf):
    """Kind of every error and the log it belongs to."""
    kind = fetch.error_kind(F.col("error_message"))
    return t.error_log(spark, sf).select(
        "id", kind.alias("kind"), fetch.log_table(kind).alias("log_table")
    )
