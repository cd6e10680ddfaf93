"""Expiry of old rows. A row whose stamp is NULL is never expired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.operators.integrity import on_delete_cascade

RETENTION_DAYS = 30


def keep_recent(
    df: DataFrame, stamp: str, as_of: Column, days: int = RETENTION_DAYS, only: Column | None = None
) -> DataFrame:
    """Rows that survive; with ``only``, rows outside that condition always do."""
    expired = F.col(stamp) < as_of - F.make_dt_interval(F.lit(days))
    if only is not None:
        expired = expired & only
    return df.filter(~F.coalesce(expired, F.lit(False)))


def retain_activities(activities: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return keep_recent(activities, "updated_at", as_of, days, only=~F.col("is_valid"))


def retain_errors(errors: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return keep_recent(errors, "created_at", as_of, days)


def retain_failed(failed: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return keep_recent(failed, "last_attempt", as_of, days)


def retain_runs(runs: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return keep_recent(runs, "completed_at", as_of, days)


def retain_links(links: DataFrame, activities: DataFrame) -> DataFrame:
    """Links of the activities that survive."""
    return on_delete_cascade(links, activities, "activity_id", "id")
