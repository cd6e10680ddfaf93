"""Validation rules on whole tables (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orgmetrics.operators import constraints, validation
from orgmetrics.plans.revalidation import revalidation_run
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query
from orgmetrics.queries.tables import read_table
from orgmetrics.schemas import TABLES, Table

c = F.col


def _errors(validated, key):
    """(key, field, message) of every failing field."""
    return validation.exploded_errors(validated, key)


_KNOWN_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def _raw_activities(spark, sf):
    """Orders as crawled activities, with faults that depend on their values."""
    last = read_table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").cast("date").alias("shipped"), F.collect_set("l_quantity").alias("quantities")
    )
    price = c("o_totalprice")
    return (
        read_table(spark, sf, "orders")
        .join(last, "o_orderkey", "left")
        .select(
            c("o_orderkey").alias("id"),
            F.when(price < 20000, F.concat(F.lit("bad slug "), c("o_orderkey")))
            .otherwise(F.concat(F.lit(" Activity-"), c("o_orderkey")))
            .alias("event_slug"),
            F.when(price > 450000, "ftp://x").otherwise("https://activities.example.org/a").alias("url"),
            F.when(price.between(30000, 40000), "  ").otherwise(F.concat(F.lit("Title "), c("o_custkey"))).alias("title"),
            F.when(price.between(50000, 60000), " too   short").otherwise("A description that is long enough").alias("description"),
            c("o_orderdate").cast("date").alias("start_date"),
            F.when(c("o_orderstatus") == "F", F.date_sub(c("shipped"), 20)).alias("end_date"),
            F.when(c("o_orderstatus") == "P", "x1").otherwise("tr").alias("country_code"),
            (F.floor(price / 40) - 600).cast("int").alias("participants"),
            c("o_orderpriority").alias("activity_type"),
            F.lit(None).cast("string").alias("city"),
            F.transform("quantities", lambda q: q.cast("int").cast("string")).alias("sdgs"),
            F.array(F.lit(" a "), F.lit("a"), F.lit("")).alias("organisers"),
            F.array().cast("array<string>").alias("causes"),
            F.lit(None).cast("array<string>").alias("objectives"),
        )
    )


_RAW = """raw AS (
  SELECT o_orderkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS start_date, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN CAST(s AS DATE) - 20 END AS end_date, CAST(floor(o_totalprice / 40) - 600 AS INTEGER) AS participants, q
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS s, max(CAST(l_quantity AS INTEGER)) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
found AS (
  SELECT id, 'event_slug' AS field_name, 'only letters, digits, hyphens and underscores are allowed' AS error_message FROM raw WHERE price < 20000
  UNION ALL SELECT id, 'url', 'not an http url' FROM raw WHERE price > 450000
  UNION ALL SELECT id, 'title', 'shorter than 1' FROM raw WHERE price BETWEEN 30000 AND 40000
  UNION ALL SELECT id, 'description', 'shorter than 10' FROM raw WHERE price BETWEEN 50000 AND 60000
  UNION ALL SELECT id, 'end_date', 'before start date' FROM raw WHERE end_date < start_date
  UNION ALL SELECT id, 'country_code', 'not 2-3 letters' FROM raw WHERE o_orderstatus = 'P'
  UNION ALL SELECT id, 'participants', CASE WHEN participants < 0 THEN 'negative' ELSE 'over 10000' END FROM raw WHERE participants NOT BETWEEN 0 AND 10000
  UNION ALL SELECT id, 'activity_type', 'unknown type' FROM raw WHERE o_orderpriority = '5-LOW'
  UNION ALL SELECT id, 'sdgs', 'not between 1 and 17' FROM raw WHERE q > 17)"""


def _checked_activities(spark, sf):
    return validation.validate_activities(_raw_activities(spark, sf), t.as_of_date(), _KNOWN_TYPES)


@query(f"WITH {_RAW} SELECT * FROM found")
def validate_activities(spark, sf):
    return _errors(_checked_activities(spark, sf), "id")


@query(f"""WITH {_RAW}
SELECT (SELECT count(*) FROM raw WHERE id NOT IN (SELECT id FROM found)) AS n_valid, (SELECT count(*) FROM raw) AS n_rows""")
def validation_summary(spark, sf):
    return validation.validation_summary(_checked_activities(spark, sf))


@query(f"""WITH {_RAW}
SELECT id, CAST(NULL AS BIGINT) AS section_id, CASE WHEN price < 20000 THEN 'bad slug ' || id ELSE 'activity-' || id END AS activity_event_slug,
       field_name, error_message, 'activities' AS scraper_module, TIMESTAMP '{t.AS_OF_TIME}' AS created_at, participants AS raw_participants
FROM found JOIN raw USING (id)""")
def validation_error_rows(spark, sf):
    """Error-log rows; the logged row itself is JSON, shown here by one of its fields."""
    rows = validation.error_rows(_checked_activities(spark, sf), "activities", t.as_of_time(), event_slug=c("event_slug"))
    raw = c("raw_data")
    return rows.select(
        F.get_json_object(raw, "$.id").cast("bigint").alias("id"),
        "section_id",
        "activity_event_slug",
        "field_name",
        "error_message",
        "scraper_module",
        "created_at",
        F.get_json_object(raw, "$.participants").cast("int").alias("raw_participants"),
    )


@query(f"""WITH {t.SECTIONS}, n AS (
  SELECT country_code, CAST(count(s.id) AS INTEGER) AS k, any_value(c.n_regionkey) AS r FROM countries c LEFT JOIN sections s USING (country_code) GROUP BY 1)
SELECT CASE WHEN r = 0 THEN country_code || '1' ELSE country_code END AS country_code, 'country_code' AS field_name, 'not two letters' AS error_message FROM n WHERE r = 0
UNION ALL SELECT country_code, 'name', 'shorter than 1' FROM n WHERE r = 1
UNION ALL SELECT country_code, 'slug', 'only letters, digits, hyphens and underscores are allowed' FROM n WHERE r = 2
UNION ALL SELECT country_code, 'url', 'missing' FROM n WHERE r = 3
UNION ALL SELECT CASE WHEN r = 0 THEN country_code || '1' ELSE country_code END, 'section_count', 'negative' FROM n WHERE k - 4 < 0""")
def validate_countries(spark, sf):
    """One fault per region, and too small a section count."""
    from orgmetrics.operators.quality import section_counts

    base = t.countries(spark, sf)
    counts = section_counts(base, t.sections(spark, sf, visits=False))
    region = c("n_regionkey")
    rows = base.join(counts, "country_code").select(
        F.lower(F.when(region == 0, F.concat("country_code", F.lit("1"))).otherwise(c("country_code"))).alias("country_code"),
        F.when(region == 1, " ").otherwise(c("name")).alias("name"),
        F.when(region == 2, "--").otherwise(c("slug")).alias("slug"),
        F.when(region != 3, c("url")).alias("url"),
        (c("section_count") - 4).alias("section_count"),
    )
    return _errors(validation.validate(rows, validation.country_rules()), "country_code")


@query("""WITH s AS (SELECT s_suppkey AS id, s_acctbal AS b FROM supplier)
SELECT id, 'name' AS field_name, 'missing' AS error_message FROM s WHERE b < 0
UNION ALL SELECT id, 'accounts_platform_slug', 'only letters, digits, hyphens and underscores are allowed' FROM s WHERE b BETWEEN 0 AND 1000
UNION ALL SELECT id, 'city', 'longer than 100' FROM s WHERE b BETWEEN 1000 AND 2000
UNION ALL SELECT id, 'email', 'not an e-mail address' FROM s WHERE b BETWEEN 2000 AND 3000
UNION ALL SELECT id, 'website', 'not an http url' FROM s WHERE b BETWEEN 3000 AND 4000
UNION ALL SELECT id, 'latitude', CASE WHEN b < 4500 THEN 'not a number of nine digits' ELSE 'not between -90 and 90' END FROM s WHERE b BETWEEN 4000 AND 5000
UNION ALL SELECT id, 'longitude', 'not between -180 and 180' FROM s WHERE b BETWEEN 5000 AND 6000
UNION ALL SELECT id, 'social_media', 'values must be texts' FROM s WHERE b BETWEEN 6000 AND 7000
UNION ALL SELECT id, 'activities_platform_slug', 'only letters, digits, hyphens and underscores are allowed' FROM s WHERE b BETWEEN 7000 AND 8000""")
def validate_sections(spark, sf):
    """One fault per band of the balance."""
    b = c("s_acctbal")
    name = F.lower(F.replace(c("s_name"), F.lit("#"), F.lit("_")))
    rows = read_table(spark, sf, "supplier").select(
        c("s_suppkey").alias("id"),
        F.lit(" tr ").alias("country_code"),
        F.when(b >= 0, c("s_name")).alias("name"),
        F.when(b.between(0, 1000), c("s_name")).otherwise(name).alias("accounts_platform_slug"),
        F.when(b.between(7000, 8000), "a b").otherwise(name).alias("activities_platform_slug"),
        F.lit("https://accounts.example.org/section/x").alias("accounts_url"),
        F.lit(None).cast("string").alias("activities_url"),
        F.when(b.between(1000, 2000), F.repeat(F.lit("c"), 101)).otherwise("city").alias("city"),
        F.lit("A university").alias("university_name"),
        F.when(b.between(2000, 3000), "nobody@nowhere").otherwise("a.b@c.example.org").alias("email"),
        F.when(b.between(3000, 4000), "www.example.org").otherwise("http://example.org").alias("website"),
        F.when(b.between(4000, 4499.99), "1234.5").when(b.between(4500, 5000), "90.5").otherwise("50.609753").alias("latitude"),
        F.when(b.between(5000, 6000), "-180.5").otherwise("3.140041").alias("longitude"),
        F.create_map(
            F.lit("site"), F.when(~b.between(6000, 7000), "https://site.example.org/x")
        ).alias("social_media"),
    )
    return _errors(validation.validate(rows, validation.section_rules()), "id")


@query("""WITH s AS (SELECT l_suppkey AS section_id, CAST(count(*) FILTER (l_returnflag = 'R') - 200 AS INTEGER) AS physical_activities,
       CAST(count(*) FILTER (l_linestatus = 'O') - 300 AS INTEGER) AS online_activities, count(*) FILTER (l_quantity = 50 AND l_discount = 0) AS n FROM lineitem GROUP BY 1)
SELECT section_id, 'physical_activities' AS field_name, 'negative' AS error_message FROM s WHERE physical_activities < 0
UNION ALL SELECT section_id, 'online_activities', 'negative' FROM s WHERE online_activities < 0
UNION ALL SELECT section_id, 'causes', 'empty' FROM s WHERE n = 0""")
def validate_statistics(spark, sf):
    """Counts against a quota may be negative; a section without full free lines has no causes."""
    full = (c("l_quantity") == 50) & (c("l_discount") == 0)
    rows = read_table(spark, sf, "lineitem").groupBy(c("l_suppkey").alias("section_id")).agg(
        (F.count_if(c("l_returnflag") == "R") - 200).alias("physical_activities"),
        (F.count_if(c("l_linestatus") == "O") - 300).alias("online_activities"),
        F.collect_set(F.when(full, c("l_returnflag"))).alias("causes"),
    )
    rules = validation.count_rules(["physical_activities", "online_activities"], ["causes"])
    return _errors(validation.validate(rows, rules), "section_id")


@query("""SELECT doc_id AS id, 'name' AS field_name, CASE WHEN length(text) = 0 THEN 'shorter than 1' ELSE 'longer than 200' END AS error_message
FROM documents WHERE length(text) NOT BETWEEN 1 AND 200
UNION ALL SELECT -1 - p_partkey, 'name', 'longer than 100' FROM part WHERE length(p_name) > 100""")
def validate_lookups(spark, sf):
    """Document texts as objectives, part names as causes."""
    texts = read_table(spark, sf, "documents").select(c("doc_id").alias("id"), c("text").alias("name"))
    names = read_table(spark, sf, "part").select((-1 - c("p_partkey")).alias("id"), c("p_name").alias("name"))
    objectives = _errors(validation.validate(texts, validation.lookup_rules(200)), "id")
    return objectives.unionByName(_errors(validation.validate(names, validation.lookup_rules(100)), "id"))


@query(f"""WITH {_RAW}, bad AS (SELECT DISTINCT id FROM found),
again AS (SELECT DISTINCT id FROM found WHERE field_name NOT IN ('country_code', 'activity_type', 'sdgs'))
SELECT id, id NOT IN (SELECT id FROM again) AS is_valid FROM bad""")
def revalidate(spark, sf):
    """Flagged activities after a repair of their country, type and goals."""
    flagged = _checked_activities(spark, sf).drop("errors")
    repaired = (
        flagged.withColumn("country_code", F.lit("TR"))
        .withColumn("activity_type", F.lit("2-HIGH"))
        .withColumn("sdgs", F.array().cast("array<int>"))
    )
    return validation.revalidate(repaired, validation.activity_rules(_KNOWN_TYPES)).select("id", "is_valid")


@query("""SELECT 'o_orderstatus' AS rule, count(*) FILTER (o_orderstatus IS NULL) AS n_bad, count(*) AS n_rows FROM orders
UNION ALL SELECT 'participants', count(*) FILTER (o_totalprice / 40 - 600 < 0), count(*) FROM orders
UNION ALL SELECT 'end_date', count(*) FILTER (l_orderkey IS NULL), count(*) FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey""")
def table_constraints(spark, sf):
    """NOT NULL, CHECK and reference rules declared for the orders: how many rows break each."""
    orders = Table(
        "orders", "o_orderkey bigint", ("o_orderkey",), not_null=("o_orderstatus",),
        checks=(("participants", "o_totalprice / 40 - 600 >= 0"),), references=(("o_orderkey", "lineitem", "l_orderkey"),),
    )
    given = {"orders": read_table(spark, sf, "orders"), "lineitem": read_table(spark, sf, "lineitem").select("l_orderkey")}
    known = {"orders": orders, "lineitem": Table("lineitem", "l_orderkey bigint", ())}
    names = {"o_orderstatus NOT NULL": "o_orderstatus", "CHECK participants": "participants", "o_orderkey REFERENCES lineitem (l_orderkey)": "end_date"}
    shown = F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), c("rule"))
    found = constraints.constraint_report(given, known).filter(c("rule").isin(*names))
    return found.select(shown.alias("rule"), "n_bad", "n_rows")


# Views with faults: the columns that each stored table gets here, in SQL.
_STORED = f"""{t.SECTIONS}, {t.ACTIVITIES}, {t.CAUSES}, {t.LINKS}, {t.RUNS}, {t.FAILED_PAGES}, {t.ERROR_LOG.removeprefix(t.FETCH_LOG).lstrip(",")},
s_countries AS (SELECT country_code, name, left(slug, 1) AS slug, CASE WHEN n_regionkey <> 0 THEN url END AS url FROM countries),
s_sections AS (SELECT id, accounts_platform_slug, CASE WHEN s_acctbal >= 0 THEN name END AS name,
                      CASE WHEN s_acctbal < 1000 THEN 'ZZ' ELSE country_code END AS country_code FROM sections),
s_activities AS (SELECT id, event_slug, repeat(title, 1 + id % 15) AS title, start_date, participants - 600 AS participants FROM activities WHERE is_valid),
s_activity_causes AS (SELECT id, name FROM causes),
s_activity_section_organisers AS (SELECT activity_id, section_id FROM links),
s_section_overall_statistics AS (SELECT l_suppkey AS id, l_suppkey % 1000 AS section_id FROM (SELECT DISTINCT l_suppkey FROM lineitem)),
s_scraper_status AS (SELECT id, scraper_module, status, started_at FROM runs),
s_validation_errors AS (SELECT id, section_id, error_message FROM error_log),
s_failed_scrapes AS (SELECT id, url, section_id FROM failed_pages)"""

_STORED_COLUMNS = {
    "countries": "country_code name slug url",
    "sections": "id accounts_platform_slug name country_code",
    "activities": "id event_slug title start_date participants",
    "activity_causes": "id name",
    "activity_section_organisers": "activity_id section_id",
    "section_overall_statistics": "id section_id",
    "scraper_status": "id scraper_module status started_at",
    "validation_errors": "id section_id error_message",
    "failed_scrapes": "id url section_id",
}


def _report_sql():
    """One SELECT per declared rule on the columns above."""
    parts = []
    for name, columns in _STORED_COLUMNS.items():
        table, have = TABLES[name], columns.split()
        counted = [(f"{x} NOT NULL", f"{x} IS NULL") for x in dict.fromkeys(table.key + table.not_null) if x in have]
        counted += [(f"{x} AT MOST {n}", f"length({x}) > {n}") for x, n in table.longest if x in have]
        counted += [(f"CHECK {n}", f"NOT ({e})") for n, e in table.checks]
        for x, other, key in table.references:
            if other in _STORED_COLUMNS and x in have:
                counted.append((f"{x} REFERENCES {other} ({key})", f"{x} NOT IN (SELECT {key} FROM s_{other} WHERE {key} IS NOT NULL)"))
        parts += [f"SELECT '{name}' AS table_name, '{n}' AS rule, count(*) FILTER ({e}) AS n_bad, count(*) AS n_rows FROM s_{name}" for n, e in counted]
        for u in dict.fromkeys((table.key, *table.unique)):
            if set(u) <= set(have):
                given = " AND ".join(f"{x} IS NOT NULL" for x in u)
                parts.append(
                    f"SELECT '{name}', 'UNIQUE ({', '.join(u)})', count(*) FILTER ({given}) - (SELECT count(*) FROM "
                    f"(SELECT DISTINCT {', '.join(u)} FROM s_{name} WHERE {given})), count(*) FROM s_{name}"
                )
    return f"WITH {_STORED} " + " UNION ALL ".join(parts)


@query(_report_sql())
def constraint_report(spark, sf):
    """Every declared rule of nine stored tables, whose rows are the samples' with faults."""
    links = t.links(spark, sf)
    views = {
        "countries": t.countries(spark, sf).withColumns(
            {"slug": F.left("slug", F.lit(1)), "url": F.when(c("n_regionkey") != 0, c("url"))}
        ),
        "sections": t.sections(spark, sf, visits=False).withColumns(
            {"name": F.when(c("s_acctbal") >= 0, c("name")), "country_code": F.when(c("s_acctbal") < 1000, "ZZ").otherwise(c("country_code"))}
        ),
        "activities": t.activities(spark, sf).filter("is_valid").withColumns(
            {"title": F.repeat("title", (1 + c("id") % 15).cast("int")), "participants": c("participants") - 600}
        ),
        "activity_causes": t.causes(spark, sf),
        "activity_section_organisers": links,
        "section_overall_statistics": read_table(spark, sf, "lineitem").select(c("l_suppkey").alias("id")).distinct().withColumn("section_id", c("id") % 1000),
        "scraper_status": t.runs(spark, sf),
        "validation_errors": t.error_log(spark, sf),
        "failed_scrapes": t.failed_pages(spark, sf),
    }
    given = {n: views[n].select(*columns.split()) for n, columns in _STORED_COLUMNS.items()}
    return constraints.constraint_report(given, TABLES)


@query("""SELECT o_orderkey, array_to_string(list_filter([
  CASE WHEN o_orderstatus IS NULL THEN 'o_orderstatus NOT NULL' END, CASE WHEN length(o_orderpriority) > 6 THEN 'o_orderpriority AT MOST 6' END,
  CASE WHEN NOT (o_totalprice / 40 - 600 >= 0) THEN 'CHECK participants' END], lambda x: x IS NOT NULL), '; ') AS broken
FROM orders WHERE o_orderstatus IS NULL OR length(o_orderpriority) > 6 OR o_totalprice / 40 - 600 < 0""")
def constraint_violations(spark, sf):
    """The rows that break a rule of their own, with the names of the rules."""
    orders = Table(
        "orders", "o_orderkey bigint", (), not_null=("o_orderstatus",), longest=(("o_orderpriority", 6),),
        checks=(("participants", "o_totalprice / 40 - 600 >= 0"),),
    )
    found = constraints.violations(read_table(spark, sf, "orders"), orders)
    return found.select("o_orderkey", F.array_join("broken", "; ").alias("broken"))


@query(f"""WITH {_RAW}, bad AS (SELECT DISTINCT id FROM found)
SELECT id, field_name, error_message, CASE WHEN field_name IN ('country_code', 'activity_type', 'sdgs') THEN 'cleared' ELSE 'kept' END AS change FROM found
UNION ALL SELECT id, 'city', 'longer than 100', 'new' FROM bad WHERE id % 7 = 0""")
def revalidation_changes(spark, sf):
    """Flagged activities after a repair of three fields that broke the city of some: errors cleared, kept and new."""
    checked = _checked_activities(spark, sf)
    stored = (
        checked.drop("errors")
        .withColumn("country_code", F.lit("TR"))
        .withColumn("activity_type", F.lit("2-HIGH"))
        .withColumn("sdgs", F.array().cast("array<int>"))
        .withColumn("city", F.when(c("id") % 7 == 0, F.repeat(F.lit("c"), 101)))
    )
    rules = validation.activity_rules(_KNOWN_TYPES)
    return revalidation_run(stored, _errors(checked, "id"), rules, "id", t.as_of_time(), ["title"]).changes
