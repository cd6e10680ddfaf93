"""Upserts, links and retention (sources A, D7-D10, H)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from orgmetrics.operators import integrity, quality, retention, upsert
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query
from orgmetrics.queries.tables import read_table
from orgmetrics.session import shared_dir
from orgmetrics.sources import tables as sources
from orgmetrics.sources.versions import VersionedTable, day_of, expire

_NOW = t.as_of_time


def _old():
    """Stamp of the rows that are stored already."""
    return t.as_of_time("1995-01-01 00:00:00")


@query(f"""WITH {t.SECTIONS},
target AS (SELECT country_code, upper(name) AS name, slug, url, 0 AS section_count,
                  TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' AS updated_at
           FROM countries WHERE n_regionkey <> 4),
source AS (SELECT c.country_code, c.name, c.slug,
                  CASE WHEN c.n_regionkey <> 0 THEN c.url END AS url,
                  CAST(count(s.id) AS INTEGER) AS section_count
           FROM countries c LEFT JOIN sections s USING (country_code)
           WHERE c.n_regionkey <> 1 GROUP BY ALL)
SELECT country_code, t.name, t.slug, t.url, t.section_count, t.created_at, t.updated_at
FROM target t WHERE country_code NOT IN (SELECT country_code FROM source)
UNION ALL
SELECT country_code, s.name, s.slug, s.url, s.section_count,
       coalesce(t.created_at, TIMESTAMP '{t.AS_OF_TIME}'), TIMESTAMP '{t.AS_OF_TIME}'
FROM source s LEFT JOIN target t USING (country_code)""")
def upsert_countries(spark, sf):
    """Region 4 is new, region 1 is not crawled, and region 0 loses its url: NULLs overwrite."""
    base = t.countries(spark, sf)
    target = base.filter("n_regionkey <> 4").select(
        "country_code",
        F.upper("name").alias("name"),
        "slug",
        "url",
        F.lit(0).alias("section_count"),
        _old().alias("created_at"),
        _old().alias("updated_at"),
    )
    counts = quality.section_counts(base, t.sections(spark, sf, visits=False))
    source = base.filter("n_regionkey <> 1").withColumn(
        "url", F.when(F.col("n_regionkey") != 0, F.col("url"))
    )
    source = source.join(counts, "country_code")
    update = ["name", "slug", "url", "section_count"]
    return upsert.upsert(target, source, ["country_code"], update, _NOW())


@query(f"""WITH {t.SECTIONS},
target AS (SELECT accounts_platform_slug, name, country_code, 'old' AS city, 'http://old.example.org' AS website,
                  last_scraped, TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' AS updated_at
           FROM visited WHERE s_acctbal >= 0),
seen AS (SELECT lower(replace(s_name, '#', '-')) AS accounts_platform_slug,
                s_name || ' ' || l_linestatus AS name,
                chr(65 + n_regionkey) || chr(65 + n_nationkey) AS country_code,
                l_returnflag AS city,
                CASE WHEN l_linenumber <> 3 THEN 'http://part' || l_partkey || '.example.org' END AS website,
                row_number() OVER (PARTITION BY l_suppkey
                                   ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS r
         FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
source AS (SELECT * FROM seen WHERE r = 1)
SELECT coalesce(s.accounts_platform_slug, t.accounts_platform_slug) AS accounts_platform_slug,
       CASE WHEN s.r = 1 THEN s.name ELSE t.name END AS name,
       CASE WHEN s.r = 1 THEN s.country_code ELSE t.country_code END AS country_code,
       CASE WHEN s.r = 1 THEN s.city ELSE t.city END AS city,
       CASE WHEN s.r = 1 THEN s.website ELSE t.website END AS website,
       t.last_scraped,
       CASE WHEN t.accounts_platform_slug IS NULL THEN TIMESTAMP '{t.AS_OF_TIME}' ELSE t.created_at END AS created_at,
       CASE WHEN s.r = 1 THEN TIMESTAMP '{t.AS_OF_TIME}' ELSE t.updated_at END AS updated_at
FROM target t FULL JOIN source s ON s.accounts_platform_slug = t.accounts_platform_slug""")
def upsert_sections(spark, sf):
    """Every line item is one observation of its supplier; the last one is stored."""
    target = (
        t.sections(spark, sf)
        .filter("s_acctbal >= 0")
        .select(
            "accounts_platform_slug",
            "name",
            "country_code",
            F.lit("old").alias("city"),
            F.lit("http://old.example.org").alias("website"),
            "last_scraped",
            _old().alias("created_at"),
            _old().alias("updated_at"),
        )
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    seen = read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        F.col("l_returnflag").alias("city"),
        F.when(
            F.col("l_linenumber") != 3,
            F.concat(F.lit("http://part"), F.col("l_partkey"), F.lit(".example.org")),
        ).alias("website"),
        F.col("l_linestatus").alias("_status"),
        *order,
    )
    # One row per section is left before the section's own fields are looked up.
    last = upsert.latest_per_key(seen, ["id"], order)
    own = t.sections(spark, sf, visits=False)
    source = last.join(own, "id").withColumn("name", F.concat_ws(" ", "name", "_status"))
    update = ["name", "country_code", "city", "website"]
    return upsert.upsert(target, source, ["accounts_platform_slug"], update, _NOW())


_ACTIVITY_COLUMNS = ["title", "start_date", "participants", "activity_type", "is_valid"]

_ACTIVITY_SIDES = f"""{t.ACTIVITIES},
target AS (SELECT event_slug, title, start_date, participants, activity_type, is_valid,
                  TIMESTAMP '1995-01-01' AS created_at, updated_at
           FROM activities WHERE start_date < DATE '2000-01-01'),
source AS (SELECT event_slug, title, start_date,
                  CASE WHEN is_valid THEN participants * 2 END AS participants, activity_type, is_valid
           FROM activities WHERE start_date >= DATE '1998-01-01')"""


def _activity_sides(spark, sf):
    """An older snapshot and a newer crawl that overlap by two years."""
    rows = t.activities(spark, sf)
    target = rows.filter("start_date < DATE '2000-01-01'").select(
        "event_slug", *_ACTIVITY_COLUMNS, _old().alias("created_at"), "updated_at"
    )
    source = rows.filter("start_date >= DATE '1998-01-01'").withColumn(
        "participants", F.when(F.col("is_valid"), F.col("participants") * 2)
    )
    return target, source.select("event_slug", *_ACTIVITY_COLUMNS)


@query(f"""WITH {_ACTIVITY_SIDES}
SELECT event_slug, t.title, t.start_date, t.participants, t.activity_type, t.is_valid, t.created_at, t.updated_at
FROM target t ANTI JOIN source s USING (event_slug)
UNION ALL
SELECT event_slug, s.title, s.start_date, s.participants, s.activity_type, s.is_valid,
       coalesce(t.created_at, TIMESTAMP '{t.AS_OF_TIME}'), TIMESTAMP '{t.AS_OF_TIME}'
FROM source s LEFT JOIN target t USING (event_slug)""")
def upsert_activities(spark, sf):
    target, source = _activity_sides(spark, sf)
    return upsert.upsert(target, source, ["event_slug"], _ACTIVITY_COLUMNS, _NOW())


@query(f"""WITH {_ACTIVITY_SIDES}
SELECT event_slug, s.participants, CASE WHEN t.event_slug IS NULL THEN 'inserted' ELSE 'updated' END AS action
FROM source s LEFT JOIN target t USING (event_slug)""")
def upsert_affected(spark, sf):
    target, source = _activity_sides(spark, sf)
    return upsert.upsert_affected(target, source, ["event_slug"], ["participants"])


@query(f"""WITH {_ACTIVITY_SIDES},
known AS (SELECT t.*, CAST(substr(event_slug, 10) AS BIGINT) AS id FROM target t)
SELECT event_slug, s.participants, CASE WHEN t.event_slug IS NULL THEN 'inserted' ELSE 'updated' END AS action,
       t.id AS known_id, t.event_slug IS NULL AS new_id, coalesce(t.created_at, TIMESTAMP '{t.AS_OF_TIME}') AS created_at,
       TIMESTAMP '{t.AS_OF_TIME}' AS updated_at
FROM source s LEFT JOIN known t USING (event_slug)""")
def upsert_returning(spark, sf):
    """What an upsert wrote, with ids and stamps; ids of new rows begin after the largest one."""
    target, source = _activity_sides(spark, sf)
    target = target.withColumn("id", F.expr("CAST(substr(event_slug, 10) AS BIGINT)"))
    last = target.agg(F.max("id")).scalar()
    into = f"{shared_dir(spark)}/upsert-{uuid.uuid4().hex}"
    _, written = upsert.upsert_returning(
        target, source, ["event_slug"], _ACTIVITY_COLUMNS, _NOW(), into, id_column="id"
    )
    fresh = F.col("action") == "inserted"
    return written.select(
        "event_slug",
        "participants",
        "action",
        F.when(~fresh, F.col("id")).alias("known_id"),
        (fresh & (F.col("id") > last)).alias("new_id"),
        "created_at",
        "updated_at",
    )


@query("""SELECT l_suppkey AS section_id, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1""")
def bulk_insert(spark, sf):
    """Line items in two batches, one of them inserted twice: it counts once."""
    rows = read_table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_linenumber")
    path = f"{shared_dir(spark)}/bulk-{uuid.uuid4().hex}"
    odd = F.col("l_linenumber") % 2 == 1
    for token, batch in (("odd", odd), ("even", ~odd), ("odd", odd)):
        table = sources.bulk_insert(rows.filter(batch), path, token, ["l_suppkey", "l_quantity"])
    return table.groupBy(F.col("l_suppkey").alias("section_id")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


_STATISTICS_KEYS = {
    "overall": "'all'",
    "causes": "p_brand",
    "types": "o_orderpriority",
    "participants": "l_returnflag",
}


def _statistics_sql(where: str) -> str:
    parts = [
        f"SELECT '{k}' AS table_name, l_suppkey AS section_id, {e} AS name, "
        "count(*) FILTER (l_linestatus <> 'O') AS physical_count, "
        "count(*) FILTER (l_linestatus = 'O') AS online_count "
        f"FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE {where} GROUP BY ALL"
        for k, e in _STATISTICS_KEYS.items()
    ]
    return " UNION ALL ".join(parts)


@query(f"""WITH old AS ({_statistics_sql("l_shipdate < TIMESTAMP '1999-01-01'")}),
new AS ({_statistics_sql("l_shipdate >= TIMESTAMP '1997-01-01'")})
SELECT table_name, section_id, name,
       CASE WHEN new.section_id IS NULL THEN old.physical_count ELSE new.physical_count END AS physical_count,
       CASE WHEN new.section_id IS NULL THEN old.online_count ELSE new.online_count END AS online_count,
       CASE WHEN new.section_id IS NULL THEN TIMESTAMP '1995-01-01' ELSE TIMESTAMP '{t.AS_OF_TIME}' END AS scraped_at
FROM old FULL JOIN new USING (table_name, section_id, name)""")
def upsert_section_stats(spark, sf):
    """The four statistics tables under one key that starts with the table's name."""
    from orgmetrics.queries.statistics import activity_rows

    key = ["table_name", "section_id", "name"]
    names = {"causes": "cause", "types": "type", "participants": "participant"}
    facets = F.array(
        F.struct(F.lit("overall").alias("table_name"), F.lit("all").alias("name")),
        *(F.struct(F.lit(k).alias("table_name"), F.col(v).alias("name")) for k, v in names.items()),
    )
    shipped = F.col("l_shipdate")
    is_old = shipped < F.lit("1999-01-01").cast("timestamp_ntz")
    is_new = shipped >= F.lit("1997-01-01").cast("timestamp_ntz")
    # One pass over the lines counts both sides for every combination; the four tables share it.
    counted = activity_rows(spark, sf).groupBy("section_id", *names.values(), "online").agg(
        F.count_if(is_old).alias("old"), F.count_if(is_new).alias("new")
    )
    sums = {
        f"{side}_{kind}": F.sum(F.when(F.col("online") == (kind == "online"), F.col(side)).otherwise(0))
        for side in ("old", "new")
        for kind in ("physical", "online")
    }
    long = counted.select("section_id", "online", "old", "new", F.inline(facets))
    per_name = long.groupBy(*key).agg(*(v.alias(k) for k, v in sums.items()))

    def side(name, stamp):
        physical, online = F.col(f"{name}_physical"), F.col(f"{name}_online")
        return per_name.filter(physical + online > 0).select(
            *key, physical.alias("physical_count"), online.alias("online_count"), stamp.alias("scraped_at")
        )

    update = ["physical_count", "online_count", "scraped_at"]
    return upsert.upsert(
        side("old", _old()), side("new", _NOW()), key, update, _NOW(), created=None, touched=None
    )


@query("""SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS r FROM lineitem)
WHERE r = 1""")
def latest_per_key(spark, sf):
    rows = read_table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_quantity"
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"]
    return upsert.latest_per_key(rows, ["l_partkey"], order)


@query("""SELECT DISTINCT l_orderkey AS activity_id, l_suppkey AS section_id FROM lineitem
EXCEPT SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'""")
def insert_ignore_links(spark, sf):
    """Rows actually added when all links meet those known before 1998."""
    target = t.links(spark, sf, F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return upsert.insert_ignore(target, t.links(spark, sf), ["activity_id", "section_id"])


@query("""WITH owners AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
SELECT DISTINCT l_orderkey AS activity_id, l_suppkey AS section_id FROM lineitem
WHERE l_linestatus = 'F' AND l_orderkey NOT IN (SELECT o_orderkey FROM owners)
UNION ALL
SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
WHERE l_linestatus = 'O' AND l_orderkey IN (SELECT o_orderkey FROM owners)""")
def replace_links(spark, sf):
    """Open orders lose their old links and get the ones of their open lines."""
    old = t.links(spark, sf, F.col("l_linestatus") == "F")
    owners = read_table(spark, sf, "orders").filter("o_orderstatus = 'O'")
    owners = owners.select(F.col("o_orderkey").alias("activity_id"))
    new = t.links(spark, sf, F.col("l_linestatus") == "O").join(owners, "activity_id", "left_semi")
    return upsert.replace_links(old, owners, new, "activity_id")


@query(f"""WITH {t.SECTIONS}
SELECT id, name, CASE WHEN id IN (SELECT doc_id FROM labels)
       THEN TIMESTAMP '{t.AS_OF_TIME}' ELSE last_scraped END AS last_scraped
FROM visited""")
def touch_last_scraped(spark, sf):
    """Sections whose number has a label count as processed."""
    done = read_table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    target = t.sections(spark, sf).select("id", "name", "last_scraped")
    return upsert.touch(target, done, "id", "last_scraped", _NOW())


@query(f"""WITH {t.SECTIONS}
SELECT c.country_code, c.name, CAST(count(s.id) AS INTEGER) AS section_count,
       TIMESTAMP '{t.AS_OF_TIME}' AS updated_at
FROM countries c LEFT JOIN sections s USING (country_code) GROUP BY ALL""")
def update_section_count(spark, sf):
    """Counts include countries whose sections are gone: they are set to 0."""
    base = t.countries(spark, sf)
    target = base.select(
        "country_code", "name", F.lit(-1).alias("section_count"), _old().alias("updated_at")
    )
    counts = quality.section_counts(base, t.sections(spark, sf, visits=False))
    return upsert.set_from(target, counts, "country_code", "section_count", _NOW(), "updated_at")


@query(f"""WITH {t.ACTIVITIES},
patch AS (SELECT l_orderkey AS id, CAST(max(l_quantity) AS INTEGER) AS participants,
                 CASE WHEN max(l_returnflag) = 'R' THEN 'Returned' END AS activity_type
          FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT id, a.title, coalesce(p.participants, a.participants) AS participants,
       coalesce(p.activity_type, a.activity_type) AS activity_type
FROM activities a LEFT JOIN patch p USING (id)""")
def partial_update(spark, sf):
    """A patch with some fields NULL: those keep their value."""
    patch = (
        read_table(spark, sf, "lineitem")
        .filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.max("l_quantity").cast("int").alias("participants"),
            F.when(F.max("l_returnflag") == "R", "Returned").alias("activity_type"),
        )
    )
    target = t.activities(spark, sf).select("id", "title", "participants", "activity_type")
    return upsert.partial_update(target, patch, ["id"])


@query(f"""WITH {t.ACTIVITIES}
SELECT id, updated_at, is_valid FROM activities
WHERE NOT coalesce(NOT is_valid AND updated_at < TIMESTAMP '{t.AS_OF_DATE}' - INTERVAL 30 DAY, false)""")
def retention_activities(spark, sf):
    rows = t.activities(spark, sf).select("id", "updated_at", "is_valid")
    return retention.retain_activities(rows, t.as_of_time(t.AS_OF_DATE))


@query(f"""WITH {t.ACTIVITIES}, {t.LINKS}
SELECT activity_id, section_id FROM links WHERE activity_id IN (
  SELECT id FROM activities
  WHERE NOT coalesce(NOT is_valid AND updated_at < TIMESTAMP '{t.AS_OF_DATE}' - INTERVAL 30 DAY, false))""")
def retention_links(spark, sf):
    """Expired activities take their links with them."""
    return retention.retain_links(t.links(spark, sf), retention_activities(spark, sf))


@query(f"""WITH {t.ERROR_LOG} SELECT * FROM error_log
WHERE created_at IS NULL OR created_at >= TIMESTAMP '{t.AS_OF_TIME}' - INTERVAL 30 DAY""")
def retention_errors(spark, sf):
    return retention.retain_errors(t.error_log(spark, sf), t.as_of_time())


@query(f"""WITH {t.ERROR_LOG} SELECT * FROM error_log
WHERE created_at IS NULL OR created_at >= TIMESTAMP '{t.AS_OF_TIME}' - INTERVAL 30 DAY""")
def retention_by_day(spark, sf):
    """The error log kept by day: older days go unread, the day of the limit is rewritten."""
    columns = "id bigint, section_id bigint, error_message string, created_at timestamp_ntz"
    log = VersionedTable(f"{shared_dir(spark)}/log-{uuid.uuid4().hex}", columns, day_of("created_at"))
    log.commit(spark, "landed", t.error_log(spark, sf))
    limit = dt.datetime.fromisoformat(t.AS_OF_TIME) - dt.timedelta(days=retention.RETENTION_DAYS)
    expire(log, spark, "retention", "created_at", limit)
    return log.read(spark).drop("part")


@query(f"""WITH {t.FAILED_PAGES} SELECT * FROM failed_pages
WHERE last_attempt IS NULL OR last_attempt >= TIMESTAMP '{t.AS_OF_TIME}' - INTERVAL 30 DAY""")
def retention_failed(spark, sf):
    return retention.retain_failed(t.failed_pages(spark, sf), t.as_of_time())


@query(f"""WITH {t.RUNS} SELECT * FROM runs
WHERE completed_at IS NULL OR completed_at >= TIMESTAMP '{t.AS_OF_TIME}' - INTERVAL 30 DAY""")
def retention_runs(spark, sf):
    return retention.retain_runs(t.runs(spark, sf), t.as_of_time())


@query("""SELECT l_orderkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return integrity.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem ANTI JOIN
(SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 2) p ON s_suppkey = l_suppkey""")
def fk_orphans(spark, sf):
    """Line items left without a supplier when region 2 leaves the network."""
    gone = t.countries(spark, sf).filter("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    parents = read_table(spark, sf, "supplier").join(gone, "s_nationkey", "left_anti")
    child = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return integrity.fk_orphans(child, parents, "l_suppkey", "s_suppkey")


@query("""SELECT c_custkey, c_name, CASE WHEN n_regionkey <> 2 THEN c_nationkey END AS c_nationkey
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def fk_set_null(spark, sf):
    parents = t.countries(spark, sf).filter("n_regionkey <> 2")
    child = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return integrity.on_delete_set_null(child, parents, "c_nationkey", "n_nationkey")


@query(f"""WITH {t.SECTIONS}
SELECT s.id, s.name, CASE WHEN n_regionkey = 3 THEN lower(s.country_code) || '-new' ELSE s.country_code END AS country_code
FROM sections s JOIN countries c USING (country_code)""")
def fk_update_cascade(spark, sf):
    """The countries of region 3 get new codes."""
    code = F.col("country_code")
    renames = t.countries(spark, sf).filter("n_regionkey = 3")
    renames = renames.select(code.alias("old_key"), F.concat(F.lower(code), F.lit("-new")).alias("new_key"))
    child = t.sections(spark, sf, visits=False).select("id", "name", "country_code")
    return integrity.on_update_cascade(child, renames, "country_code")


@query(f"""WITH {t.LINKS}
SELECT activity_id, section_id FROM links WHERE activity_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def fk_delete_cascade(spark, sf):
    parents = read_table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return integrity.on_delete_cascade(t.links(spark, sf), parents, "activity_id", "o_orderkey")


@query("""SELECT l_orderkey AS id, 'returned' AS part, l_quantity AS amount FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, 'open', l_quantity FROM lineitem WHERE l_linestatus = 'O'""")
def union_chunks(spark, sf):
    """Partial results one after another; rows in both stay twice."""
    rows = read_table(spark, sf, "lineitem")

    def part(name, where):
        return rows.filter(where).select(
            F.col("l_orderkey").alias("id"), F.lit(name).alias("part"), F.col("l_quantity").alias("amount")
        )

    return part("returned", "l_returnflag = 'R'").unionByName(part("open", "l_linestatus = 'O'"))


@query("""WITH stored AS (SELECT DISTINCT doc_id FROM labels), crawled AS (SELECT DISTINCT vec_id FROM embeddings)
SELECT coalesce(doc_id, vec_id) AS id,
       CASE WHEN doc_id IS NULL THEN 'new' WHEN vec_id IS NULL THEN 'gone' ELSE 'kept' END AS state
FROM stored FULL JOIN crawled ON doc_id = vec_id""")
def section_diff(spark, sf):
    """Labels stand for the stored sections, embeddings for the crawled ones."""
    from orgmetrics.operators.selection import section_diff as diff

    stored = read_table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return diff(read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id")), stored, "id")
