"""Key and foreign-key rules, which Parquet tables do not enforce themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmetrics.operators.joins import lookup_join, salted_join


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def _parents(parent: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """The parents' keys as they are: a semi or anti join needs no distinct ones, and AQE can split
    the partitions of a hot child key only where this side is not aggregated."""
    return parent.select(F.col(parent_key).alias(child_key))


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    referring = child.filter(F.col(child_key).isNotNull())
    return lookup_join(referring, _parents(parent, parent_key, child_key), child_key, "left_anti")


def on_delete_set_null(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """References without a parent become NULL."""
    known = _parents(parent, parent_key, child_key).distinct().withColumn("_known", F.lit(True))
    return (
        salted_join(child, known, child_key, "left")
        .withColumn(child_key, F.when(F.col("_known"), F.col(child_key)))
        .select(*child.columns)
    )


def on_update_cascade(child: DataFrame, renames: DataFrame, child_key: str) -> DataFrame:
    """Follow renamed keys; ``renames`` holds one ``old_key, new_key`` row per renamed parent."""
    fresh = renames.select(F.col("old_key").alias(child_key), F.col("new_key").alias("_new_key"))
    return (
        lookup_join(child, fresh, child_key, "left")
        .withColumn(child_key, F.coalesce("_new_key", child_key))
        .select(*child.columns)
    )


def on_delete_cascade(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Child rows whose parent survives."""
    return lookup_join(child, _parents(parent, parent_key, child_key), child_key, "left_semi")
