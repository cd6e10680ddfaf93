"""Tables that change by whole parts: every commit is a new version, and a reader sees one version.

A version lists, for every part of the table, the folder that holds it. A commit writes the parts it
changes into a folder of its own and then one small file with the new list: whoever reads before
that file is there reads the version before. Parts that a commit leaves alone are neither read nor
written. A part is a bucket of keys, a day, or any other value of ``part``.

One job writes at a time. Commits carry a token (a batch id, a run's name): a token that was committed
is not committed again, so a job that died anywhere can be run again.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmetrics.operators.upsert import latest_per_key, upsert_marked

PART = "part"
TOKENS_KEPT = 1000  # commits whose tokens are remembered; only a late replay is older
_LIST_DDL = "part string, folder string, last_id bigint, token string, at bigint"
_VERSION = re.compile(r"/versions/v=(\d+)/")


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Part of a table that is kept by key: keys of one bucket stand together."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def day_of(stamp: str) -> Column:
    """Part of a log that is kept by day; rows without a stamp are a part of their own."""
    return F.coalesce(F.date_format(stamp, "yyyy-MM-dd"), F.lit("none"))


@dataclass(frozen=True)
class Version:
    """What one commit left: folder by part, the largest id given out, tokens with their version."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    last_id: int = 0
    tokens: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class VersionedTable:
    """A table at ``root``, a folder that all executors share.

    ``columns`` is its DDL; ``part`` gives the part of a row. The number of parts is bounded by the
    caller (buckets, days kept), for the list of parts goes through the driver; rows never do.
    """

    root: str
    columns: str
    part: Column

    def _lists(self, spark: SparkSession) -> DataFrame | None:
        try:
            lists = spark.read.schema(_LIST_DDL).parquet(f"{self.root}/versions")
            return lists if lists.inputFiles() else None
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """The newest version, or an earlier one that is still listed."""
        lists = self._lists(spark)
        if lists is None:
            return Version()
        known = [int(_VERSION.search(f).group(1)) for f in lists.inputFiles()]
        number = max(known) if number is None else number
        rows = spark.read.schema(_LIST_DDL).parquet(f"{self.root}/versions/v={number}").collect()
        return Version(
            number,
            {r["part"]: r["folder"] for r in rows if r["part"] is not None},
            max((r["last_id"] or 0 for r in rows), default=0),
            {r["token"]: r["at"] for r in rows if r["token"] is not None},
        )

    def read(self, spark: SparkSession, parts: list[str] | None = None, number: int | None = None) -> DataFrame:
        """The rows of one version; of some of its parts alone, if named. ``part`` is a column.

        Filters on ``part`` prune folders; no folder of another version is opened.
        """
        folders = self.version(spark, number).folders
        chosen = [p for p in folders if parts is None or p in parts]
        ddl = f"{self.columns}, {PART} string"
        if not chosen:
            return spark.createDataFrame([], ddl)
        paths = [f"{self.root}/data/{folders[p]}/{PART}={p}" for p in sorted(chosen)]
        rows = spark.read.schema(ddl).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*spark.createDataFrame([], ddl).columns)

    def commit(
        self,
        spark: SparkSession,
        token: str,
        rows: DataFrame | None,
        drop: Iterable[str] = (),
        id_column: str | None = None,
    ) -> bool:
        """Replace the parts that ``rows`` hold, take away those in ``drop``; False if done before.

        A part that ``rows`` hold is replaced as a whole. Its folder is new, so nothing that a
        version lists is ever written again, and what a dead job left behind is never listed.
        """
        now = self.version(spark)
        if token in now.tokens:
            return False
        dropped = set(drop)
        folders = {p: f for p, f in now.folders.items() if p not in dropped}
        last_id = now.last_id
        if rows is not None:
            folder = f"commit={now.number + 1}-{uuid.uuid4().hex}"
            names = spark.createDataFrame([], self.columns).columns
            shaped = rows.select(*names).withColumn(PART, self.part)
            # Rows of a part meet, in files of a size that the session's advisory partition size sets.
            shaped.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.root}/data/{folder}")
            written = spark.read.schema(f"{self.columns}, {PART} string").parquet(f"{self.root}/data/{folder}")
            largest = F.max(id_column) if id_column else F.lit(0)
            for r in written.groupBy(PART).agg(largest.cast("bigint").alias("last")).collect():
                folders[r[PART]] = folder
                last_id = max(last_id, r["last"] or 0)
        number = now.number + 1
        tokens = {**now.tokens, token: number}
        listed = [(p, f, last_id, None, None) for p, f in folders.items()]
        listed += [(None, None, last_id, t, at) for t, at in tokens.items() if at > number - TOKENS_KEPT]
        # One file, moved to its place in one step.
        spark.createDataFrame(listed, _LIST_DDL).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/versions/v={number}"
        )
        return True

    def upsert(
        self,
        source: DataFrame,
        token: str,
        keys: list[str],
        update: list[str],
        as_of: Column,
        order_by: list[str] | None = None,
        id_column: str | None = None,
        created: str | None = "created_at",
        touched: str | None = "updated_at",
    ) -> bool:
        """Commit the table after inserting ``source`` with overwrite on equal keys.

        Parts must be buckets of the keys. Only the parts that hold a key of the source are read and
        written. Ids go on from the largest that any version gave out.
        """
        spark = source.sparkSession
        now = self.version(spark)
        if token in now.tokens:
            return False
        if order_by:
            source = latest_per_key(source, keys, order_by)
        hit = [r[0] for r in source.select(self.part.alias(PART)).distinct().collect()]
        target = self.read(spark, hit).drop(PART)
        marked = upsert_marked(
            target, source, keys, update, as_of, created, touched, id_column, F.lit(now.last_id)
        )
        return self.commit(spark, token, marked.drop("action"), id_column=id_column)

    def unlisted(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Folders that the newest ``keep`` versions do not list, to be removed by housekeeping."""
        lists = self._lists(spark)
        known = sorted({int(_VERSION.search(f).group(1)) for f in lists.inputFiles()}) if lists else []
        live = {f for n in known[-keep:] for f in self.version(spark, n).folders.values()}
        every = {f for n in known for f in self.version(spark, n).folders.values()}
        return sorted(f"{self.root}/data/{f}" for f in every - live)


def compact(table: VersionedTable, spark: SparkSession, token: str) -> bool:
    """Commit the same rows from one folder, in files of an even size."""
    return table.commit(spark, token, table.read(spark).drop(PART))


def expire(table: VersionedTable, spark: SparkSession, token: str, stamp: str, limit: dt.datetime) -> bool:
    """Retention of a log kept by day: days before that of ``limit`` go from the list unread.

    The day of ``limit`` is read and rewritten without its older rows, no other part is touched. Rows
    without a stamp stay.
    """
    day = f"{limit:%Y-%m-%d}"
    parts = table.version(spark).folders
    older = [p for p in parts if p != "none" and p < day]
    if day not in parts:
        return table.commit(spark, token, None, drop=older)
    kept = F.col(stamp) >= F.lit(limit).cast("timestamp_ntz")
    # The day goes from the list, and comes back if it has rows left.
    return table.commit(spark, token, table.read(spark, [day]).drop(PART).filter(kept), drop=[*older, day])
