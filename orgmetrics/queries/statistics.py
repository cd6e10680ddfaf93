"""Statistics documents: built from line items, landed as pages, parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from orgmetrics.operators import quality, statistics
from orgmetrics.operators.joins import lookup_join
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query
from orgmetrics.sources.settings_json import page_statistics
from orgmetrics.queries.tables import read_table

_NAMES = {"causes": "cause", "types": "type", "participants": "participant"}


def activity_rows(spark, sf):
    """Line items as activities of a section: cause, type, participant kind, online or not."""
    lines = read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("section_id"),
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_returnflag").alias("participant"),
        (F.col("l_linestatus") == "O").alias("online"),
        "l_shipdate",
    )
    brands = read_table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("cause"))
    kinds = read_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("type")
    )
    return lookup_join(lookup_join(lines, brands, "p_partkey"), kinds, "o_orderkey")


def statistics_pages(spark, sf):
    """One landed statistics page per section, the JSON document inside its script element."""
    counted = activity_rows(spark, sf).groupBy("section_id", *_NAMES.values(), "online").agg(
        F.count("*").alias("n")
    )
    facets = F.array(
        *(F.struct(F.lit(c).alias("category"), F.col(n).alias("name")) for c, n in _NAMES.items()),
        F.struct(
            F.lit("activities").alias("category"),
            F.when(F.col("online"), "2 online").otherwise("1 physical").alias("name"),
        ),
    )
    long = counted.select("section_id", "online", "n", F.inline(facets))
    per_name = long.groupBy("section_id", "category", "name").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(~F.col("online"), F.col("n"))).alias("physical"),
        F.sum(F.when(F.col("online"), F.col("n"))).alias("online"),
    )
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in statistics.KINDS))
    entries = per_name.select("section_id", "category", "name", F.inline(kinds)).filter("n IS NOT NULL")
    # A list is as long as the vocabulary it counts, whatever the number of activities.
    lists = entries.groupBy(
        "section_id", F.concat_ws("_", "kind", "category").alias("key")
    ).agg(F.array_sort(F.collect_list(F.array("name", F.col("n").cast("string")))).alias("values"))
    documents = lists.groupBy("section_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct("values")))).alias(
            "activities_statistics"
        )
    )
    body = F.to_json(F.struct("activities_statistics"))
    head = '<html><body><script type="application/json" data-drupal-selector="drupal-settings-json">'
    return documents.select(
        "section_id", F.concat(F.lit(head), body, F.lit("</script></body></html>")).alias("html")
    )


def _parsed(spark, sf):
    return statistics_pages(spark, sf).select("section_id", page_statistics(F.col("html")).alias("stats"))


_ROWS = """rows AS (
  SELECT l_suppkey AS section_id, p_brand AS cause, o_orderpriority AS type, l_returnflag AS participant,
         l_linestatus = 'O' AS online
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey)"""


def _detail_sql(name: str, alias: str, total: bool) -> str:
    first = "count(*) AS total_count, " if total else ""
    return f"""WITH {_ROWS}
SELECT section_id, {name} AS {alias}, {first}count(*) FILTER (NOT online) AS physical_count,
       count(*) FILTER (online) AS online_count
FROM rows GROUP BY 1, 2"""


@query(f"""WITH {_ROWS}, lists AS (
  SELECT section_id, 'causes' AS category, cause AS name, online FROM rows
  UNION ALL SELECT section_id, 'types', type, online FROM rows
  UNION ALL SELECT section_id, 'participants', participant, online FROM rows
  UNION ALL SELECT section_id, 'activities', CASE WHEN online THEN '2' ELSE '1' END, online FROM rows),
kinds AS (
  SELECT section_id, category, name, 'total' AS kind FROM lists
  UNION SELECT section_id, category, name, 'physical' FROM lists WHERE NOT online
  UNION SELECT section_id, category, name, 'online' FROM lists WHERE online)
SELECT section_id, kind || '_' || category AS key, CAST(count(DISTINCT name) AS INTEGER) AS n_items
FROM kinds GROUP BY ALL""")
def stats_json_source(spark, sf):
    """Lists of the JSON block of every statistics page, with their lengths."""
    found = _parsed(spark, sf).select("section_id", F.explode("stats").alias("key", "list"))
    return found.select("section_id", "key", F.size("list.values").alias("n_items"))


@query(f"""WITH {_ROWS}, parts AS (SELECT section_id, participant, count(*) AS n,
         row_number() OVER (PARTITION BY section_id ORDER BY participant) AS position
       FROM rows GROUP BY 1, 2),
kinds AS (SELECT section_id, online, count(*) AS n,
         row_number() OVER (PARTITION BY section_id ORDER BY online) AS position FROM rows GROUP BY 1, 2)
SELECT section_id,
       coalesce((SELECT n FROM kinds k WHERE k.section_id = s.section_id AND position = 1), 0) AS physical_activities,
       coalesce((SELECT n FROM kinds k WHERE k.section_id = s.section_id AND position = 2), 0) AS online_activities,
       coalesce((SELECT n FROM parts p WHERE p.section_id = s.section_id AND position = 1), 0) AS total_local_students,
       coalesce((SELECT n FROM parts p WHERE p.section_id = s.section_id AND position = 2), 0) AS total_international_students,
       coalesce((SELECT n FROM parts p WHERE p.section_id = s.section_id AND position = 3), 0) AS total_coordinators,
       true AS has_statistics
FROM (SELECT DISTINCT section_id FROM rows) s""")
def stats_overall(spark, sf):
    return statistics.overall_statistics(_parsed(spark, sf))


@query(_detail_sql("cause", "cause_name", True))
def stats_causes(spark, sf):
    return statistics.category_statistics(_parsed(spark, sf), "section_id", "causes")


@query(_detail_sql("type", "activity_type", False))
def stats_types(spark, sf):
    return statistics.category_statistics(_parsed(spark, sf), "section_id", "types")


@query(_detail_sql("participant", "participant_type", False))
def stats_participants(spark, sf):
    return statistics.category_statistics(_parsed(spark, sf), "section_id", "participants")


_ASSEMBLED = f"""{_ROWS},
listed AS (
  SELECT section_id, 'causes' AS category, cause AS name, count(*) AS n, count(*) FILTER (online) AS o FROM rows GROUP BY 1, 3
  UNION ALL SELECT section_id, 'types', type, count(*), count(*) FILTER (online) FROM rows GROUP BY 1, 3
  UNION ALL SELECT section_id, 'participants', participant, count(*), count(*) FILTER (online) FROM rows GROUP BY 1, 3),
texts AS (
  SELECT section_id, category, string_agg(name || ':' || n || ':' || (n - o) || ':' || o, ',' ORDER BY name) AS list
  FROM listed GROUP BY 1, 2),
assembled AS (
  SELECT section_id, max(list) FILTER (category = 'causes') AS causes, max(list) FILTER (category = 'types') AS types,
         max(list) FILTER (category = 'participants') AS participants
  FROM texts GROUP BY 1)"""


def _shown(assembled):
    def text(name):
        item = F.transform(
            name,
            lambda x: F.concat_ws(":", x["name"], x["total_count"], x["physical_count"], x["online_count"]),
        )
        return F.array_join(item, ",").alias(name)

    return assembled.select("section_id", *(text(c) for c in statistics.CATEGORIES), "is_complete")


@query(f"WITH {_ASSEMBLED} SELECT section_id, causes, types, participants, true AS is_complete FROM assembled")
def stats_assembled(spark, sf):
    return _shown(statistics.assembled_statistics(_parsed(spark, sf), "section_id"))


@query(f"""WITH {_ASSEMBLED}, one AS (SELECT max(s_suppkey) AS id FROM supplier)
SELECT section_id, causes, types, participants, true AS is_complete FROM assembled JOIN one ON id = section_id""")
def section_statistics(spark, sf):
    """Assembled statistics of one section, the one registered last; its document is built alone."""
    last = read_table(spark, sf, "supplier").agg(F.max("s_suppkey").alias("id")).scalar()
    parsed = _parsed(spark, sf).filter(F.col("section_id") == last)
    return _shown(statistics.assembled_statistics(parsed, "section_id"))


@query("""SELECT l_suppkey AS section_id, o_orderpriority AS type, count(*) AS total_count,
       count(*) FILTER (l_linestatus <> 'O') AS physical_count, count(*) FILTER (l_linestatus = 'O') AS online_count
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def stats_recomputed(spark, sf):
    """Type statistics from the activities themselves."""
    kinds = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("type")
    )
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("section_id"), (F.col("l_linestatus") == "O").alias("online")
    )
    rows = lookup_join(lines, kinds, "l_orderkey")
    return statistics.recomputed_statistics(rows, "section_id", "type", F.col("online"))


# Documents stand for sections and labels, which some lack, for their statistics.
def _labelled(spark, sf):
    zero = F.lit(0).cast("bigint")
    return (
        read_table(spark, sf, "labels")
        .groupBy(F.col("doc_id").alias("section_id"))
        .agg(
            F.sum("quality").alias("physical_activities"),
            F.sum("toxic").alias("online_activities"),
        )
        .select(
            "*",
            zero.alias("total_local_students"),
            zero.alias("total_international_students"),
            zero.alias("total_coordinators"),
        )
    )


_LABELLED = """labelled AS (
  SELECT doc_id AS section_id, sum(quality)::BIGINT AS physical_activities, sum(toxic)::BIGINT AS online_activities
  FROM labels GROUP BY 1)"""


@query(f"""WITH {_LABELLED}
SELECT doc_id AS id, source AS name FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT section_id FROM labelled)""")
def missing_statistics(spark, sf):
    rows = read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("name"), (F.col("lang") == "en").alias("can_scrape_activities")
    )
    return quality.missing_statistics(rows, _labelled(spark, sf)).select("id", "name")


@query(f"""WITH {_LABELLED}
SELECT doc_id AS section_id, coalesce(physical_activities, 0) AS physical_activities,
       coalesce(online_activities, 0) AS online_activities, 0::BIGINT AS total_local_students,
       0::BIGINT AS total_international_students, 0::BIGINT AS total_coordinators, section_id IS NOT NULL AS has_statistics
FROM documents LEFT JOIN labelled ON section_id = doc_id""")
def stats_zero_fill(spark, sf):
    rows = read_table(spark, sf, "documents").select(F.col("doc_id").alias("section_id"))
    return statistics.zero_filled(rows, _labelled(spark, sf), "section_id")
