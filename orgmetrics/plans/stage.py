"""Intermediate tables of one run, written to the shared folder.

A run reads its extracted rows several times (upsert, counts, error log). Writing them once keeps
the pages from being parsed again, and cuts the lineage with something that outlives executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmetrics.operators.runlog import run_status_rows
from orgmetrics.session import shared_dir
from orgmetrics.sources.tables import write_snapshot


class Stage:
    def __init__(self, spark: SparkSession, run: str):
        self.folder = f"{shared_dir(spark)}/{run}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        return write_snapshot(df, f"{self.folder}/{name}")


def run_status(summary: DataFrame, module: str, as_of: Column) -> DataFrame:
    """Run-log row of a finished run. A failed quality gate is a warning: it goes to metadata."""
    return run_status_rows(
        summary,
        module,
        as_of,
        as_of,
        F.col("sections_processed"),
        F.col("errors"),
        F.lit(None).cast("string"),
        passed=F.col("passed"),
        reason=F.col("reason"),
    )
