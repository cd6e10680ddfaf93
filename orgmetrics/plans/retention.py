"""The clean-up run: expire old rows of four tables and what depends on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession

from orgmetrics import schemas
from orgmetrics.operators import retention
from orgmetrics.sources.versions import VersionedTable, day_of, expire

_JUNCTIONS = (
    schemas.ORGANISERS,
    schemas.ACTIVITY_CAUSES,
    schemas.ACTIVITY_SDGS,
    schemas.ACTIVITY_OBJECTIVES,
)


def retention_run(
    stored: dict[str, DataFrame], as_of: Column, days: int = retention.RETENTION_DAYS
) -> dict[str, DataFrame]:
    """Next versions of the tables that lose rows; write each to a fresh folder."""
    activities = retention.retain_activities(stored["activities"], as_of, days)
    result = {
        "activities": activities,
        "validation_errors": retention.retain_errors(stored["validation_errors"], as_of, days),
        "failed_scrapes": retention.retain_failed(stored["failed_scrapes"], as_of, days),
        "scraper_status": retention.retain_runs(stored["scraper_status"], as_of, days),
    }
    for table in _JUNCTIONS:
        if table.name in stored:
            result[table.name] = retention.retain_links(stored[table.name], activities)
    return result


def log_table(root: str, table: schemas.Table) -> VersionedTable:
    """A log of ``schemas`` kept by the day of its stamp, at ``root``."""
    return VersionedTable(root, table.ddl, day_of(table.partition_by[0]))


def expire_logs(
    spark: SparkSession, logs: dict[str, VersionedTable], as_of: str, token: str, days: int = retention.RETENTION_DAYS
) -> None:
    """Retention of logs kept by day: only the day that the limit falls into is read and written.

    ``as_of`` is a time as ``yyyy-MM-dd HH:mm:ss``; ``logs`` are tables of ``schemas`` by name.
    """
    limit = dt.datetime.fromisoformat(as_of) - dt.timedelta(days=days)
    for name, log in logs.items():
        stamp = schemas.TABLES[name].partition_by[0]
        expire(log, spark, token, stamp, limit)
