"""Weekly re-ingest as an incremental job: only newly landed page files are read.

Every micro-batch writes the rows it extracted into a folder named by its batch id. A batch that
runs again after a failure overwrites its own folder, so replay changes nothing. The current
table is the last row per key over all batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmetrics.operators.upsert import latest_per_key
from orgmetrics.operators.validation import Ruleset, validate
from orgmetrics.schemas import PAGE_DDL
from orgmetrics.sources.pages import page_gate
from orgmetrics.sources.versions import VersionedTable


def ingest_available(
    spark: SparkSession,
    landed: str,
    state: str,
    extract: Callable[[DataFrame], DataFrame],
    rules: Ruleset,
    files_per_batch: int | None = None,
    columns: str = PAGE_DDL,
) -> None:
    """Process every page file under ``landed`` not seen before, then stop.

    ``state`` is a folder all executors share; it holds the checkpoint and two tables by batch:
    checked (extracted rows with ``is_valid`` and their errors) and rejected (pages without
    content). Pages are parsed once; valid and invalid rows are told apart when read.
    """

    _run(spark, landed, state, _checked_writer(state, extract, rules), files_per_batch, columns)


def _checked_writer(state: str, extract: Callable, rules: Ruleset) -> Callable[[DataFrame, int], None]:
    def store(pages: DataFrame, batch_id: int) -> None:
        good, rejected = page_gate(pages)
        for name, rows in (("checked", validate(extract(good), rules)), ("rejected", rejected)):
            rows.write.mode("overwrite").parquet(f"{state}/{name}/batch={batch_id}")

    return store


def _run(
    spark: SparkSession,
    landed: str,
    state: str,
    store: Callable[[DataFrame, int], None],
    files_per_batch: int | None,
    columns: str,
) -> None:
    reader = spark.readStream.schema(columns)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    job = (
        reader.parquet(landed)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


def ingest_upserts(
    spark: SparkSession,
    landed: str,
    state: str,
    extract: Callable[[DataFrame], DataFrame],
    rules: Ruleset,
    table: VersionedTable,
    keys: list[str],
    update: list[str],
    order_by: list[str],
    as_of: Column,
    id_column: str | None = None,
    files_per_batch: int | None = None,
    columns: str = PAGE_DDL,
) -> None:
    """As ``ingest_available``, and every batch is upserted into ``table``, whose parts are buckets of the keys.

    A batch commits one version under its id. One that runs again, wherever it died, commits nothing
    twice: the version is listed last, and its token is remembered. Only the buckets that hold keys of
    the batch are read and written, and ``table.read`` opens no batch at all. Several rows of a key
    in one batch count in the order of ``order_by``; later batches win over earlier ones.
    """
    write = _checked_writer(state, extract, rules)

    def store(pages: DataFrame, batch_id: int) -> None:
        write(pages, batch_id)
        checked = pages.sparkSession.read.parquet(f"{state}/checked/batch={batch_id}")
        valid = checked.filter("is_valid").drop("errors")
        table.upsert(valid, f"batch-{batch_id}", keys, update, as_of, order_by, id_column)

    _run(spark, landed, state, store, files_per_batch, columns)


def batches(spark: SparkSession, state: str, name: str) -> DataFrame:
    """All rows one of the two tables ever got, with their ``batch``."""
    return spark.read.option("basePath", f"{state}/{name}").parquet(f"{state}/{name}/batch=*")


def current_rows(spark: SparkSession, state: str, key: list[str], order: list[str]) -> DataFrame:
    """The table after all batches: later batches replace earlier rows of the same key."""
    changes = batches(spark, state, "checked").filter("is_valid").drop("errors")
    return latest_per_key(changes, key, ["batch", *order]).drop("batch")


def compact(spark: SparkSession, state: str, key: list[str], order: list[str], into: str) -> None:
    """Write the current table as the first batch of a new state folder."""
    none = F.array().cast("array<struct<field_name:string,error_message:string>>")
    rows = current_rows(spark, state, key, order).withColumn("errors", none)
    rows.write.parquet(f"{into}/checked/batch=-1")
