"""The sample tables seen as the tables of a network, in Spark and as SQL common tables.

nation = countries, supplier = sections, orders = activities, (order, supplier) pairs of lineitem
= organiser links, part brands = causes, events = fetch, error and run logs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmetrics.functions.slugs import activities_slug
from orgmetrics.sources import tables as sources

PREFIX = "supplier"
BASE = "https://accounts.example.org"
AS_OF_DATE = "1998-06-15"
AS_OF_TIME = "2024-02-15 00:00:00"


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return sources.read_table(spark, sf, name, SCHEMAS[name])


def as_of_date() -> Column:
    return F.lit(AS_OF_DATE).cast("date")


def as_of_time(text: str = AS_OF_TIME) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def countries(spark: SparkSession, sf: str) -> DataFrame:
    code = F.concat(F.char(F.col("n_regionkey") + 65), F.char(F.col("n_nationkey") + 65))
    return read_table(spark, sf, "nation").select(
        "n_nationkey",
        "n_regionkey",
        code.alias("country_code"),
        F.col("n_name").alias("name"),
        F.lower("n_name").alias("slug"),
        F.concat(F.lit(BASE + "/country/"), F.lower(code)).alias("url"),
    )


COUNTRIES = f"""countries AS (
  SELECT n_nationkey, n_regionkey, chr(65 + n_regionkey) || chr(65 + n_nationkey) AS country_code,
         n_name AS name, lower(n_name) AS slug,
         '{BASE}/country/' || lower(chr(65 + n_regionkey) || chr(65 + n_nationkey)) AS url
  FROM nation)"""


def sections(spark: SparkSession, sf: str, visits: bool = True) -> DataFrame:
    """Suppliers; ``visits`` adds the last visit, taken from their line items."""
    homes = countries(spark, sf).select(F.col("n_nationkey").alias("s_nationkey"), "country_code")
    verdict = F.when(F.col("s_acctbal") >= 1000, True).when(F.col("s_acctbal") < 0, False)
    base = (
        read_table(spark, sf, "supplier")
        .join(homes, "s_nationkey")
        .select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            "country_code",
            F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))).alias(
                "accounts_platform_slug"
            ),
            activities_slug(F.col("s_name"), PREFIX).alias("activities_platform_slug"),
            verdict.alias("can_scrape_activities"),
            "s_acctbal",
        )
    )
    if not visits:
        return base
    last = (
        read_table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("id"))
        .agg(F.max("l_shipdate").alias("_last"))
    )
    never = F.col("s_acctbal").between(3000, 4000)
    return base.join(last, "id", "left").select(
        *base.columns, F.when(~never, F.col("_last")).alias("last_scraped")
    )


SECTIONS = f"""{COUNTRIES},
sections AS (
  SELECT s_suppkey AS id, s_name AS name, country_code,
         lower(replace(s_name, '#', '-')) AS accounts_platform_slug,
         lower(replace(s_name, '#', '-')) AS activities_platform_slug,
         CASE WHEN s_acctbal >= 1000 THEN true WHEN s_acctbal < 0 THEN false END
           AS can_scrape_activities,
         s_acctbal
  FROM supplier JOIN countries ON n_nationkey = s_nationkey),
visited AS (
  SELECT sections.*,
         CASE WHEN s_acctbal NOT BETWEEN 3000 AND 4000 THEN last END AS last_scraped
  FROM sections LEFT JOIN (SELECT l_suppkey, max(l_shipdate) AS last FROM lineitem GROUP BY 1) v
    ON v.l_suppkey = sections.id)"""


def activities(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("activity-"), F.col("o_orderkey")).alias("event_slug"),
        F.concat_ws(" ", F.lit("Activity of customer"), "o_custkey").alias("title"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.floor(F.col("o_totalprice") / 40).cast("int").alias("participants"),
        F.col("o_orderpriority").alias("activity_type"),
        (F.col("o_orderstatus") != "P").alias("is_valid"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("updated_at"),
        "o_custkey",
    )


ACTIVITIES = """activities AS (
  SELECT o_orderkey AS id, 'activity-' || o_orderkey AS event_slug,
         'Activity of customer ' || o_custkey AS title,
         CAST(o_orderdate AS DATE) AS start_date,
         CAST(floor(o_totalprice / 40) AS INTEGER) AS participants,
         o_orderpriority AS activity_type, o_orderstatus <> 'P' AS is_valid,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS updated_at, o_custkey
  FROM orders)"""


def links(spark: SparkSession, sf: str, where: Column | None = None) -> DataFrame:
    rows = read_table(spark, sf, "lineitem")
    rows = rows if where is None else rows.filter(where)
    return rows.select(
        F.col("l_orderkey").alias("activity_id"), F.col("l_suppkey").alias("section_id")
    ).distinct()


LINKS = """links AS (
  SELECT DISTINCT l_orderkey AS activity_id, l_suppkey AS section_id FROM lineitem)"""


def causes(spark: SparkSession, sf: str) -> DataFrame:
    brand = F.col("p_brand")
    return (
        read_table(spark, sf, "part")
        .select(brand.alias("name"), F.substring(brand, 7, 10).cast("bigint").alias("id"))
        .distinct()
    )


CAUSES = """causes AS (
  SELECT DISTINCT p_brand AS name, CAST(substr(p_brand, 7) AS BIGINT) AS id FROM part)"""


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def fetch_log(spark: SparkSession, sf: str) -> DataFrame:
    value, failed = F.col("value"), F.col("event_type") == "error"
    return read_table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("https://activities.example.org/page/"), F.col("event_id")).alias("url"),
        F.when(~failed, 200)
        .when(value < 10, 404)
        .when(value < 20, 429)
        .when(value < 30, 403)
        .when(value < 60, 500)
        .alias("status"),
        F.when(value < 25, "Blocked by Cloudflare").otherwise(F.concat(F.lit("page "), F.col("props"))).alias(
            "body"
        ),
        F.when(
            failed,
            F.when(value < 30, "HTTP request failed")
            .when(value < 40, "Timeout while reading")
            .when(value < 50, "Malformed JSON")
            .when(value < 60, "Constraint violation")
            .otherwise("Unexpected"),
        ).alias("error"),
        F.floor(_k() / 25).cast("int").alias("attempt"),
        "ts",
        F.col("user_id").alias("section_id"),
        "event_type",
        "value",
    )


FETCH_LOG = """fetch_log AS (
  SELECT event_id, 'https://activities.example.org/page/' || event_id AS url,
         CASE WHEN event_type <> 'error' THEN 200 WHEN value < 10 THEN 404 WHEN value < 20 THEN 429
              WHEN value < 30 THEN 403 WHEN value < 60 THEN 500 END AS status,
         CASE WHEN value < 25 THEN 'Blocked by Cloudflare' ELSE 'page ' || props END AS body,
         CASE WHEN event_type = 'error' THEN
           CASE WHEN value < 30 THEN 'HTTP request failed' WHEN value < 40 THEN 'Timeout while reading'
                WHEN value < 50 THEN 'Malformed JSON' WHEN value < 60 THEN 'Constraint violation'
                ELSE 'Unexpected' END END AS error,
         CAST(floor(CAST(json_extract(props, '$.k') AS INTEGER) / 25) AS INTEGER) AS attempt,
         ts, user_id AS section_id, event_type, value
  FROM events)"""


def failed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return (
        fetch_log(spark, sf)
        .filter("event_type = 'error'")
        .select(
            F.col("event_id").alias("id"),
            "url",
            "section_id",
            F.col("status").alias("http_status_code"),
            F.col("error").alias("error_message"),
            F.col("attempt").alias("retry_count"),
            F.when(F.col("value") >= 2, F.col("ts")).alias("last_attempt"),
            (F.col("value") < 60).alias("will_retry"),
        )
    )


FAILED_PAGES = f"""{FETCH_LOG},
failed_pages AS (
  SELECT event_id AS id, url, section_id, status AS http_status_code, error AS error_message,
         attempt AS retry_count, CASE WHEN value >= 2 THEN ts END AS last_attempt,
         value < 60 AS will_retry
  FROM fetch_log WHERE event_type = 'error')"""


def error_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every error event as a stored validation error; some have lost their time."""
    return (
        fetch_log(spark, sf)
        .filter("event_type = 'error'")
        .select(
            F.col("event_id").alias("id"),
            "section_id",
            F.col("error").alias("error_message"),
            F.when(F.col("value") >= 2, F.col("ts")).alias("created_at"),
        )
    )


ERROR_LOG = f"""{FETCH_LOG},
error_log AS (
  SELECT event_id AS id, section_id, error AS error_message,
         CASE WHEN value >= 2 THEN ts END AS created_at
  FROM fetch_log WHERE event_type = 'error')"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a run of one module: a run with a small value has not ended yet."""
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value"))
    ended = F.when(F.col("value") >= 5, F.col("ts") + seconds)
    return read_table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type").isin("view", "click"), "activities")
        .otherwise("accounts")
        .alias("scraper_module"),
        F.when(F.col("event_type") == "error", "failed")
        .when(ended.isNull(), "running")
        .otherwise("completed")
        .alias("status"),
        F.col("ts").alias("started_at"),
        ended.alias("completed_at"),
    )


RUNS = """runs AS (
  SELECT event_id AS id,
         CASE WHEN event_type IN ('view', 'click') THEN 'activities' ELSE 'accounts' END
           AS scraper_module,
         CASE WHEN event_type = 'error' THEN 'failed' WHEN value < 5 THEN 'running'
              ELSE 'completed' END AS status,
         ts AS started_at,
         CASE WHEN value >= 5 THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS completed_at
  FROM events)"""
