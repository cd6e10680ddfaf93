"""Keyed writes. Parquet has no MERGE, so every operator returns the table's next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orgmetrics.operators.joins import lookup_join

BUCKETS_PER_PARTITION = 16


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the last by ``order_by``, as if the rows were written one after another.

    An aggregation, not a window: each task keeps one row per key before the shuffle, so a key
    that holds most of the rows costs no more than any other.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    last = F.max_by(F.struct(*others), F.struct(*order_by))
    return (
        df.groupBy(*keys)
        .agg(last.alias("_last"))
        .select(*(c if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns))
    )


def assign_ids(
    new: DataFrame, keys: list[str], after: Column, id_column: str = "id", buckets: int | None = None
) -> DataFrame:
    """Number rows with unique keys ``after + 1, after + 2, ...`` without gaps.

    Ranks within hash buckets plus the bucket's offset: no task sees more than its bucket, and
    the same input always gets the same ids for one number of buckets. By default that number is a
    multiple of the session's shuffle partitions, which are set for the size of the data. Offsets
    are one row per bucket, hence the broadcast.
    """
    if buckets is None:
        partitions = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = BUCKETS_PER_PARTITION * partitions
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    spread = new.withColumn("_bucket", bucket)
    sizes = spread.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    return (
        spread.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(id_column, (F.coalesce(after, F.lit(0)) + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .select(*(c for c in new.columns if c != id_column), id_column)
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    as_of: Column,
    order_by: list[str] | None = None,
    created: str | None = "created_at",
    touched: str | None = "updated_at",
    id_column: str | None = None,
) -> DataFrame:
    """Next version of ``target`` after inserting ``source`` with overwrite on equal keys.

    Matched rows take ``update`` from the source, NULLs included, and a fresh ``touched`` stamp;
    every other column keeps its value. New rows get both stamps and, if asked, the next ids.
    Without ``order_by`` the source must already hold one row per key. The source is read more than
    once: stage a batch that is costly to compute.
    """
    if order_by:
        source = latest_per_key(source, keys, order_by)
    source = source.select(*keys, *update)
    kept = _overwrite_matches(target, source, keys, update, as_of, touched)
    new = _without_match(source, target, keys)
    return kept.unionByName(_as_new_rows(new, target, keys, as_of, created, touched, id_column))


def upsert_marked(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    as_of: Column,
    created: str | None = "created_at",
    touched: str | None = "updated_at",
    id_column: str | None = None,
    last_id: Column | None = None,
) -> DataFrame:
    """The next version of ``target`` with ``action``: inserted, updated, or NULL for untouched rows.

    As ``upsert``; the source holds one row per key. ``last_id`` is the largest id given out, where
    that is known without the target. Written once, it yields the version and what changed in it.
    """
    source = source.select(*keys, *update)
    joined = target.join(_fresh(source, keys, update), keys, "left")
    kept = joined.select(
        *(_next_value(c, update, as_of, touched) for c in target.columns),
        F.when(F.col("_hit"), "updated").alias("action"),
    )
    new = _without_match(source, target, keys)
    new = _as_new_rows(new, target, keys, as_of, created, touched, id_column, last_id)
    return kept.unionByName(new.withColumn("action", F.lit("inserted")))


def upsert_returning(
    target: DataFrame, source: DataFrame, keys: list[str], update: list[str], as_of: Column, into: str, **options
) -> tuple[DataFrame, DataFrame]:
    """(next version, rows written with their ids, stamps and ``action``), both from one assignment.

    ``into`` is a fresh folder that gets the next version; options are those of ``upsert_marked``.
    """
    marked = upsert_marked(target, source, keys, update, as_of, **options)
    marked.write.parquet(into)
    written = target.sparkSession.read.schema(marked.schema).parquet(into)
    return written.drop("action"), written.filter(F.col("action").isNotNull())


def upsert_affected(
    target: DataFrame, source: DataFrame, keys: list[str], update: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """The rows an upsert writes, with ``action`` = inserted or updated."""
    if order_by:
        source = latest_per_key(source, keys, order_by)
    source = source.select(*keys, *update)
    # Only the matched keys come back from the target, never more than the batch.
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    hit = source.join(known.withColumn("_hit", F.lit(True)), keys, "left")
    action = F.when(F.col("_hit"), "updated").otherwise("inserted")
    return hit.select(*keys, *update, action.alias("action"))


def _fresh(source, keys, update) -> DataFrame:
    values = F.struct(*update) if update else F.lit(None)
    return source.select(*keys, values.alias("_new"), F.lit(True).alias("_hit"))


def _overwrite_matches(target, source, keys, update, as_of, touched) -> DataFrame:
    joined = target.join(_fresh(source, keys, update), keys, "left")
    return joined.select(*(_next_value(c, update, as_of, touched) for c in target.columns))


def _next_value(name, update, as_of, touched) -> Column:
    value = F.col(name)
    if name in update:
        value = F.when(F.col("_hit"), F.col(f"_new.{name}")).otherwise(value)
    elif name == touched:
        value = F.when(F.col("_hit"), as_of).otherwise(value)
    return value.alias(name)


def _without_match(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` whose key the target lacks.

    The keys of the target are first cut down to those of the batch: where Catalyst broadcasts the
    batch, the target is not shuffled, and what comes back is no larger than the batch.
    """
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    return source.join(known, keys, "left_anti")


def _as_new_rows(new, target, keys, as_of, created, touched, id_column, last_id=None) -> DataFrame:
    stamps = {c for c in (created, touched) if c}
    have = set(new.columns)
    rows = new.select(
        *(
            F.col(f.name)
            if f.name in have
            else (as_of if f.name in stamps else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        )
    )
    if id_column:
        last_id = target.agg(F.max(id_column)).scalar() if last_id is None else last_id
        rows = assign_ids(rows, keys, last_id, id_column)
    return rows.select(*target.columns)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that an insert with "do nothing on conflict" adds; union them to the target."""
    rows = source.select(*target.columns)
    rows = rows.distinct() if set(keys) == set(rows.columns) else rows.dropDuplicates(keys)
    return _without_match(rows, target, keys).select(*target.columns)


def replace_links(
    target: DataFrame, owners: DataFrame, links: DataFrame, owner: str
) -> DataFrame:
    """Drop every link of the touched owners, then add their new links."""
    touched = owners.select(owner).distinct()
    kept = lookup_join(target, touched, owner, "left_anti").select(*target.columns)
    return kept.unionByName(links.select(*target.columns).distinct())


def touch(target: DataFrame, hits: DataFrame, key: str, column: str, as_of: Column) -> DataFrame:
    """Set ``column`` to ``as_of`` for the keys in ``hits``."""
    marked = hits.select(key).distinct().withColumn("_hit", F.lit(True))
    value = F.when(F.col("_hit"), as_of).otherwise(F.col(column))
    return (
        target.join(marked, key, "left")
        .withColumn(column, value)
        .select(*target.columns)
    )


def set_from(
    target: DataFrame, values: DataFrame, key: str, column: str, as_of: Column, touched: str
) -> DataFrame:
    """Set ``column`` from ``values(key, column)`` where the key is present, and the touch stamp."""
    fresh = values.select(key, F.col(column).alias("_value"), F.lit(True).alias("_hit"))
    return (
        target.join(fresh, key, "left")
        .withColumn(column, F.when(F.col("_hit"), F.col("_value")).otherwise(F.col(column)))
        .withColumn(touched, F.when(F.col("_hit"), as_of).otherwise(F.col(touched)))
        .select(*target.columns)
    )


def partial_update(target: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """Apply a patch with one row per key: only its non-NULL fields replace."""
    fields = [c for c in patch.columns if c not in keys]
    given = patch.select(*keys, *(F.col(c).alias(f"_{c}") for c in fields))
    return target.join(given, keys, "left").select(
        *(
            F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in fields else F.col(c)
            for c in target.columns
        )
    )
