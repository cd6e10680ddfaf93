"""Parquet tables and their snapshots."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgmetrics.schemas import Table


def read_table(
    spark: SparkSession, folder: str, name: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """Table ``name``; with its schema given, planning reads no file footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def empty_table(spark: SparkSession, table: Table) -> DataFrame:
    return spark.createDataFrame([], table.schema)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns in order and type; columns the frame lacks become NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        )
    )


def write_snapshot(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write a new version of a table into its own folder and read it back.

    Inputs of the new version are never overwritten, so a job that dies half-way can be run again.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Bulk insert: the named columns of every row, added to the table at ``path``."""
    (df.select(*columns) if columns else df).write.mode("append").parquet(path)


def bulk_insert(
    df: DataFrame, path: str, token: str, columns: list[str] | None = None, rows_per_file: int | None = None
) -> DataFrame:
    """Add the named columns of every row to the table at ``path``, once per ``token``; the whole table.

    The rows go to a folder named by the token, which a repeated run overwrites: inserting the same
    batch again changes nothing. Files get the session's advisory partition size, large partitions
    are split and small ones joined; ``rows_per_file`` also bounds their rows. ``token`` is made of
    letters, digits, hyphens and underscores.
    """
    if not re.fullmatch(r"[\w-]+", token):
        raise ValueError(f"not a token: {token}")
    rows = (df.select(*columns) if columns else df).hint("rebalance")
    writer = rows.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(f"{path}/batch={token}")
    spark = df.sparkSession
    return spark.read.schema(rows.schema).option("basePath", path).parquet(f"{path}/batch=*").select(*rows.columns)
