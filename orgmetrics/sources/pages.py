"""Landed pages and the gate every page passes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmetrics.operators.joins import lookup_join
from orgmetrics.schemas import PAGE_DDL


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_DDL).parquet(path)


def has_html_element(html: Column) -> Column:
    return F.coalesce(html.rlike(r"(?i)<html[\s>/]"), F.lit(False))


def page_gate(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages to parse, rejected pages with the reason)."""
    good = has_html_element(F.col("html"))
    rejected = pages.filter(~good).select(
        *(c for c in pages.columns if c != "html"), F.lit("no html element").alias("error_message")
    )
    return pages.filter(good), rejected


def only_wanted(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pages whose ``url`` is in a short list, such as that of a run with a limit."""
    return pages.join(wanted.select("url").distinct(), "url", "left_semi")


def from_latest(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows parsed from the last landed copy of each address.

    ``rows`` carry ``url`` and ``page_id`` of their page; the copies are compared by these two
    alone, so no text is shuffled.
    """
    latest = pages.groupBy("url").agg(F.max("page_id").alias("page_id"))
    return lookup_join(rows, latest, ["url", "page_id"], "left_semi")
