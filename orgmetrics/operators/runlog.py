"""Rows of the run, error and failure logs, and what to retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.functions.fetch import classify_fetch, next_attempt

MAX_RETRIES = 3


def failed_page_rows(
    log: DataFrame, module: str, section_id: Column | None = None
) -> DataFrame:
    """Failure-log rows of the fetches that did not succeed."""
    outcome = classify_fetch(F.col("status"), F.col("body"))
    owner = F.lit(None) if section_id is None else section_id
    return log.filter(outcome != "ok").select(
        "url",
        owner.cast("bigint").alias("section_id"),
        F.lit(module).alias("scraper_module"),
        F.col("status").alias("http_status_code"),
        F.coalesce("error", outcome).alias("error_message"),
        F.lit(0).alias("retry_count"),
        F.col("ts").alias("last_attempt"),
        F.lit(True).alias("will_retry"),
    )


def rejected_page_rows(rejected: DataFrame, module: str, as_of: Column) -> DataFrame:
    """Failure-log rows of landed pages that could not be read: one per address, with its reason."""
    reasons = rejected.groupBy("url").agg(F.max("error_message").alias("error_message"))
    return reasons.select(
        "url",
        F.lit(None).cast("bigint").alias("section_id"),
        F.lit(module).alias("scraper_module"),
        F.lit(None).cast("int").alias("http_status_code"),
        "error_message",
        F.lit(0).alias("retry_count"),
        as_of.cast("timestamp_ntz").alias("last_attempt"),
        F.lit(True).alias("will_retry"),
    )


def run_status_rows(
    runs: DataFrame,
    module: str,
    started: Column,
    completed: Column,
    processed: Column,
    failed: Column,
    error: Column,
    **metadata: Column,
) -> DataFrame:
    """Run-log rows: running until a completion time is known, failed when an error is."""
    status = (
        F.when(error.isNotNull(), "failed").when(completed.isNull(), "running").otherwise("completed")
    )
    extra = F.to_json(F.struct(*(v.alias(k) for k, v in metadata.items())))
    return runs.select(
        F.lit(module).alias("scraper_module"),
        status.alias("status"),
        started.alias("started_at"),
        completed.alias("completed_at"),
        processed.cast("bigint").alias("sections_processed"),
        failed.cast("bigint").alias("sections_failed"),
        error.alias("error_message"),
        extra.alias("metadata"),
    )


def exhausted_retries(failed: DataFrame) -> DataFrame:
    return failed.filter(F.col("retry_count") >= MAX_RETRIES)


def retry_queue(failed: DataFrame) -> DataFrame:
    return failed.filter(F.col("will_retry"))


def retry_schedule(failed: DataFrame) -> DataFrame:
    """Time of the next attempt, doubling with every retry."""
    due = next_attempt(F.col("last_attempt"), F.col("retry_count"))
    return failed.withColumn("next_attempt", due)


def retry_due(failed: DataFrame, as_of: Column) -> DataFrame:
    """Pending failures whose waiting time is over."""
    open_rows = retry_queue(failed).filter(F.col("retry_count") < MAX_RETRIES)
    return retry_schedule(open_rows).filter(F.col("next_attempt") <= as_of)
