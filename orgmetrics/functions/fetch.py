"""Outcome classes, error kinds and retry times of the fetch log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_fetch(status: Column, body: Column) -> Column:
    """Outcome class of one response."""
    return (
        F.when(status == 200, "ok")
        .when(status == 429, "rate_limit")
        .when((status == 403) & F.lower(body).contains("cloudflare"), "blocked")
        .when(status == 404, "not_found")
        .when(status.isNull(), "no_response")
        .otherwise("other")
    )


def kept_body(status: Column, body: Column) -> Column:
    """A page that does not exist has no content; refused requests never reach a parser."""
    refused = classify_fetch(status, body).isin("rate_limit", "blocked", "no_response")
    return F.when(~refused, F.when(status == 404, "").otherwise(body))


def error_kind(error: Column) -> Column:
    """Which part of the system failed, told from the message."""
    low = F.lower(error)
    return (
        F.when(low.rlike("html|selector|json|pars"), "parsing")
        .when(low.rlike("connection pool|constraint|transaction|deadlock|database"), "database")
        .when(low.rlike("http|timeout|rate|404|403|500|network"), "http")
        .otherwise("other")
    )


def log_table(kind: Column) -> Column:
    """Table that takes an error of this kind."""
    return (
        F.when(kind == "http", "failed_scrapes")
        .when(kind == "parsing", "validation_errors")
        .otherwise("scraper_status")
    )


def backoff_seconds(attempt: Column) -> Column:
    return F.pow(F.lit(2.0), attempt).cast("bigint")


def next_attempt(last_attempt: Column, attempt: Column) -> Column:
    seconds = backoff_seconds(attempt)
    return last_attempt + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
