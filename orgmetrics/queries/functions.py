"""Column functions over whole tables and whole texts (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orgmetrics.functions import dates, geo, slugs, text, urls
from orgmetrics.queries import tables as t
from orgmetrics.queries.registry import query
from orgmetrics.queries.tables import read_table

c = F.col


def _documents(spark, sf):
    return read_table(spark, sf, "documents")


# RE2 spelling of the blanks that a Unicode-aware split knows.
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _folded(expression: str) -> str:
    """Accents of the sample texts, folded in SQL."""
    return f"replace(strip_accents(lower({expression})), 'ß', 'ss')"


def _slug_sql(expression: str) -> str:
    return f"trim(regexp_replace({_folded(expression)}, '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"""SELECT doc_id AS id, 'document' AS kind, {_slug_sql("'net ' || lower(translate(lang || ' ' || source, ',', ' ')) || ' ' || substr(md5(text), 1, 8)")} AS slug FROM documents
UNION ALL SELECT s_suppkey, 'supplier', {_slug_sql("'net ' || s_name")} FROM supplier
UNION ALL SELECT p_partkey, 'part', {_slug_sql("'net ' || p_name || ' ' || p_brand")} FROM part""")
def slug_activities(spark, sf):
    """Names of suppliers and parts, and document names closed by a digest of their text."""
    docs = _documents(spark, sf).select(
        c("doc_id").alias("id"),
        F.lit("document").alias("kind"),
        F.concat_ws(" ", "lang", "source", F.substring(F.md5(c("text")), 1, 8)).alias("name"),
    )
    suppliers = read_table(spark, sf, "supplier").select(
        c("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), c("s_name").alias("name")
    )
    parts = read_table(spark, sf, "part").select(
        c("p_partkey").alias("id"),
        F.lit("part").alias("kind"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
    )
    names = docs.unionByName(suppliers).unionByName(parts)
    return names.select("id", "kind", slugs.activities_slug(c("name"), "net").alias("slug"))


@query(f"""WITH {t.COUNTRIES}
SELECT p_partkey, lower(country_code) || '-' || substr(split_part(p_name, ' ', 1), 1, 4) || '-' || substr(split_part(p_name, ' ', 2), 1, 3) AS slug,
       lower(country_code) || '-brand-' || substr(p_brand, 7) AS one_word
FROM part JOIN countries ON n_nationkey = (p_size - 1) // 2""")
def slug_accounts(spark, sf):
    """Parts as sections: colour and thing as city and university, size as country."""
    homes = t.countries(spark, sf).select(c("n_nationkey").alias("_n"), "country_code")
    rows = read_table(spark, sf, "part").withColumn("_n", F.floor((c("p_size") - 1) / 2).cast("int"))
    rows = rows.join(homes, "_n")
    return rows.select(
        "p_partkey",
        slugs.accounts_slug(F.concat(F.lit("Net "), c("p_name")), c("country_code"), "net").alias("slug"),
        slugs.accounts_slug(c("p_brand"), c("country_code"), "net").alias("one_word"),
    )


@query("""SELECT c_custkey, slug, regexp_full_match(slug, '[a-z0-9-]+') AND starts_with(slug, 'customer-') AND length(slug) >= 10 AS valid
FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN lower(c_name) WHEN 'MACHINERY' THEN 'customer-'
             WHEN 'FURNITURE' THEN replace(c_name, '#', '-') ELSE lower(replace(c_name, '#', '-')) END AS slug FROM customer)""")
def slug_activities_valid(spark, sf):
    slug = (
        F.when(c("c_mktsegment") == "BUILDING", F.lower("c_name"))
        .when(c("c_mktsegment") == "MACHINERY", "customer-")
        .when(c("c_mktsegment") == "FURNITURE", F.replace(c("c_name"), F.lit("#"), F.lit("-")))
        .otherwise(F.lower(F.replace(c("c_name"), F.lit("#"), F.lit("-"))))
    )
    rows = read_table(spark, sf, "customer").select("c_custkey", slug.alias("slug"))
    return rows.withColumn("valid", slugs.activities_slug_valid(c("slug"), "customer"))


_ACCOUNT_SLUGS = """SELECT c_custkey, n_name, CASE c_mktsegment WHEN 'BUILDING' THEN lower(n_name) || '-' || c_custkey
  WHEN 'MACHINERY' THEN replace(lower(n_name), '_', '-') || '-' || c_custkey WHEN 'FURNITURE' THEN 'nation-x-' || c_custkey
  ELSE 'other-place-' || c_custkey END AS slug FROM customer JOIN nation ON n_nationkey = c_nationkey"""


@query(f"""SELECT c_custkey, slug, regexp_full_match(slug, '[a-z0-9-]+') AND len(string_split(slug, '-')) >= 3 AS valid,
regexp_full_match(slug, '[a-z0-9-]+') AND len(string_split(slug, '-')) >= 3 AND starts_with(slug, lower(substr(n_name, 1, 2))) AS valid_for_country
FROM ({_ACCOUNT_SLUGS})""")
def slug_accounts_valid(spark, sf):
    names = read_table(spark, sf, "nation").select(c("n_nationkey").alias("c_nationkey"), "n_name")
    low, key = F.lower("n_name"), c("c_custkey")
    slug = (
        F.when(c("c_mktsegment") == "BUILDING", F.concat_ws("-", low, key))
        .when(c("c_mktsegment") == "MACHINERY", F.concat_ws("-", F.replace(low, F.lit("_"), F.lit("-")), key))
        .when(c("c_mktsegment") == "FURNITURE", F.concat(F.lit("nation-x-"), key))
        .otherwise(F.concat(F.lit("other-place-"), key))
    )
    rows = read_table(spark, sf, "customer").join(names, "c_nationkey").withColumn("slug", slug)
    country = F.substring("n_name", 1, 2)
    return rows.select(
        "c_custkey",
        "slug",
        slugs.accounts_slug_valid(c("slug")).alias("valid"),
        slugs.accounts_slug_valid(c("slug"), country).alias("valid_for_country"),
    )


@query(rf"""WITH words AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '{_BLANK}+', ' ', 'g'), ' ')) AS word FROM documents)
SELECT doc_id, count(*) AS n_words, count(*) FILTER (regexp_full_match(replace(replace(lower(word), '-', ''), '_', ''), '[\p{{L}}\p{{N}}]+')) AS n_valid
FROM words GROUP BY 1""")
def slug_lenient_valid(spark, sf):
    """Every word of every document as a slug."""
    words = _documents(spark, sf).select(
        "doc_id", F.explode(F.split(F.regexp_replace("text", f"{text.BLANK}+", " "), " ")).alias("word")
    )
    valid = slugs.lenient_slug_valid(c("word"))
    return words.groupBy("doc_id").agg(
        F.count("*").alias("n_words"), F.count_if(valid).alias("n_valid")
    )


@query(rf"SELECT doc_id, trim(regexp_replace(text, '{_BLANK}+', ' ', 'g')) AS text FROM documents")
def normalize_text(spark, sf):
    rows = _documents(spark, sf)
    return rows.select("doc_id", text.normalize_text(c("text")).alias("text"))


@query("""SELECT doc_id, upper(code) AS code, regexp_full_match(upper(code), '\\p{L}{2,3}') AS valid, regexp_full_match(upper(code), '\\p{L}{2}') AS valid_two
FROM (SELECT doc_id, CASE WHEN n_chars < 500 THEN lang WHEN n_chars < 2000 THEN source ELSE lang || substr(source, 4, 1) END AS code FROM documents)""")
def normalize_country_code(spark, sf):
    code = (
        F.when(c("n_chars") < 500, c("lang"))
        .when(c("n_chars") < 2000, c("source"))
        .otherwise(F.concat("lang", F.substring("source", 4, 1)))
    )
    padded = F.concat(F.lit(" "), code, F.lit("\t"))
    rows = _documents(spark, sf)
    return rows.select(
        "doc_id",
        text.normalize_country_code(padded).alias("code"),
        text.country_code_valid(padded).alias("valid"),
        text.country_code_valid(padded, 2).alias("valid_two"),
    )


@query("""SELECT page_id, regexp_extract(regexp_replace(url, '/$', ''), '([^/]*)$', 1) AS last_step,
CASE WHEN contains(url, '/en/') THEN trim(regexp_extract(url, '^.*/en/(.*)$', 1), '/') END AS after_en FROM pages""")
def url_tail(spark, sf):
    url = c("url")
    stripped = F.regexp_replace(url, "/$", "")
    return read_table(spark, sf, "pages").select(
        "page_id",
        urls.url_tail(stripped, "/").alias("last_step"),
        urls.url_tail(url, "/en/").alias("after_en"),
    )


_HREFS = """SELECT page_id, url, unnest(['/root/' || page_id, 'near/' || page_id, '?page=' || page_id, '#s' || page_id,
  '//cdn.example.org/' || page_id, 'https://other.example.org/' || page_id, 'up/../' || page_id]) AS href FROM pages"""


@query(f"""WITH h AS ({_HREFS}), p AS (
  SELECT *, regexp_extract(url, '^(https?):', 1) AS scheme, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root,
         regexp_replace(url, '[?#].*$', '') AS page FROM h)
SELECT page_id, href, CASE
  WHEN href LIKE 'https:%' THEN href
  WHEN href LIKE '//%' THEN scheme || ':' || href
  WHEN href LIKE '/%' THEN root || href
  WHEN href LIKE '?%' THEN page || href
  WHEN href LIKE '#%' THEN regexp_replace(url, '#.*$', '') || href
  ELSE regexp_replace(page, '[^/]*$', '') || replace(href, 'up/../', '') END AS resolved
FROM p""")
def url_resolve(spark, sf):
    """Seven shapes of links on every page, resolved against the page's own address."""
    key = c("page_id").cast("string")
    shapes = ("/root/", "near/", "?page=", "#s", "//cdn.example.org/", "https://other.example.org/", "up/../")
    hrefs = F.explode(F.array(*(F.concat(F.lit(s), key) for s in shapes)))
    rows = read_table(spark, sf, "pages").select("page_id", "url", hrefs.alias("href"))
    return rows.select("page_id", "href", urls.resolve_url(c("url"), c("href")).alias("resolved"))


@query("""SELECT doc_id, CASE WHEN d = '' THEN 0 ELSE coalesce(TRY_CAST(d AS INTEGER), 2147483647) END AS n
FROM (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '[^0-9]', '', 'g') AS d FROM documents)""")
def digits_to_int(spark, sf):
    """Every line of every document."""
    lines = _documents(spark, sf).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.select("doc_id", text.digits_to_int(c("line")).alias("n"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey, CAST(l_quantity AS INTEGER) AS q FROM lineitem)
SELECT l_orderkey AS id, string_agg(q, ',' ORDER BY q) FILTER (q BETWEEN 1 AND 17) AS sdgs FROM l GROUP BY 1""")
def sdg_numbers(spark, sf):
    """Quantities of an order's lines printed as goal texts, read back as goal numbers."""
    quantity = c("l_quantity").cast("int").cast("string")
    label = (
        F.when(c("l_returnflag") == "A", F.concat(F.lit("Goal "), quantity, F.lit(": icon")))
        .when(c("l_returnflag") == "N", F.concat(F.lit("sdg  "), quantity))
        .otherwise(F.concat(F.lit("Icon of SDG "), quantity, F.lit(" and SDG 1")))
    )
    rows = read_table(spark, sf, "lineitem").select("l_orderkey", label.alias("alt"))
    texts = rows.groupBy(c("l_orderkey").alias("id")).agg(F.collect_set("alt").alias("alts"))
    return texts.select("id", text.nonempty(F.array_join(text.sdg_numbers(c("alts")), ",")).alias("sdgs"))


@query("""SELECT l_orderkey AS id, count(DISTINCT CAST(l_quantity AS INTEGER)) AS n_goals,
bool_and(CAST(l_quantity AS INTEGER) BETWEEN 1 AND 17 AND l_linenumber < 7) AS valid FROM lineitem GROUP BY 1""")
def sdg_list_valid(spark, sf):
    """Quantities as goal numbers; the seventh line of an order has none."""
    quantity = c("l_quantity").cast("int").cast("string")
    rows = read_table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("id"), F.when(c("l_linenumber") < 7, quantity).otherwise("none").alias("goal"), quantity.alias("q")
    )
    lists = rows.groupBy("id").agg(F.collect_set("goal").alias("goals"), F.collect_set("q").alias("qs"))
    return lists.select(
        "id",
        F.size(text.sdg_list(c("qs"))).cast("bigint").alias("n_goals"),
        text.sdg_list_valid(c("goals")).alias("valid"),
    )


@query(rf"""WITH l AS (SELECT doc_id, line, row_number() OVER () AS r FROM (
  SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^{_BLANK}+|{_BLANK}+$', '', 'g') AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))
SELECT doc_id, coalesce((SELECT array_to_string(list_filter(list_transform(string_split(d.text, chr(10)),
       lambda x: regexp_replace(x, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda x: x <> ''), ', ')), '') AS joined FROM documents d""")
def join_nonempty(spark, sf):
    """The non-empty lines of every document on one line."""
    rows = _documents(spark, sf)
    return rows.select("doc_id", text.join_nonempty(F.split("text", "\n"), ", ").alias("joined"))


@query(rf"""WITH w AS (SELECT doc_id, i, regexp_replace(word, '^{_BLANK}+|{_BLANK}+$', '', 'g') AS word FROM (
    SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents)),
f AS (SELECT doc_id, word, min(i) AS i FROM w WHERE word <> '' GROUP BY 1, 2)
SELECT d.doc_id, count(word) AS n_items, md5(coalesce(string_agg(word, ' ' ORDER BY i), '')) AS digest
FROM documents d LEFT JOIN f USING (doc_id) GROUP BY 1""")
def clean_list(spark, sf):
    """Words of every document as a list: trimmed, distinct, first of equals kept."""
    rows = _documents(spark, sf)
    cleaned = text.clean_list(F.split("text", " "))
    listed = rows.select("doc_id", cleaned.alias("items"))
    return listed.select(
        "doc_id",
        F.size("items").cast("bigint").alias("n_items"),
        F.md5(F.array_join("items", " ")).alias("digest"),
    )


@query("""WITH p AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS lat,
                            CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(CAST(json_extract(props, '$.k') AS INTEGER) * 2.5 AS VARCHAR) END AS lng FROM events),
n AS (SELECT event_id, TRY_CAST(lat AS DECIMAL(9,6)) AS la, TRY_CAST(lng AS DECIMAL(9,6)) AS ln FROM p)
SELECT event_id, CASE WHEN ln IS NOT NULL THEN la END AS latitude, CASE WHEN la IS NOT NULL THEN ln END AS longitude,
       la IS NULL OR ln IS NULL OR la BETWEEN -90 AND 90 AS latitude_valid,
       la IS NULL OR ln IS NULL OR ln BETWEEN -180 AND 180 AS longitude_valid FROM n""")
def coordinates(spark, sf):
    """Event values and payload numbers printed as coordinates; some lack one of the two."""
    k = F.get_json_object("props", "$.k").cast("int")
    lat = F.when(c("event_type") == "error", "n/a").otherwise(F.concat(F.lit(" "), c("value").cast("string")))
    lng = F.when(c("event_type") != "signup", (k * 2.5).cast("string"))
    place = geo.coordinates(lat, lng)
    rows = read_table(spark, sf, "events").select("event_id", place.alias("p"))
    return rows.select(
        "event_id",
        "p.latitude",
        "p.longitude",
        geo.latitude_valid(c("p.latitude")).alias("latitude_valid"),
        geo.longitude_valid(c("p.longitude")).alias("longitude_valid"),
    )


@query("""SELECT event_id, CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS k,
'{"type":"' || event_type || '","k":"' || CAST(json_extract(props, '$.k') AS INTEGER) || '"}' AS json FROM events""")
def map_json(spark, sf):
    """Payloads to maps and back, with the type added."""
    rows = read_table(spark, sf, "events").withColumn("m", text.json_to_map(c("props")))
    full = F.map_concat(F.create_map(F.lit("type"), c("event_type")), c("m"))
    return rows.select("event_id", c("m")["k"].alias("k"), text.map_to_json(full).alias("json"))


@query("""SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS platform FROM events""")
def social_platform(spark, sf):
    """Event types as link titles; views have a title that names no profile."""
    title = F.when(c("event_type") == "view", "Website").otherwise(F.concat(F.initcap("event_type"), F.lit(" profile")))
    return read_table(spark, sf, "events").select("event_id", text.social_platform(title).alias("platform"))


@query(r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \n\t\r]+')) AS word FROM documents)
SELECT doc_id, count(*) FILTER (regexp_matches(word, '^(?i:https?)://[^\s/?#]+([/?#].*)?$')) AS n_urls,
       count(*) FILTER (regexp_matches(word, '^[\p{L}\p{N}!#$%&''*+/=?^_`{|}~-]+(\.[\p{L}\p{N}!#$%&''*+/=?^_`{|}~-]+)*@[\p{L}\p{N}]([\p{L}\p{N}-]*[\p{L}\p{N}])?(\.[\p{L}\p{N}]([\p{L}\p{N}-]*[\p{L}\p{N}])?)+$')) AS n_emails
FROM w GROUP BY 1 UNION ALL
SELECT -1 - page_id, CASE WHEN regexp_matches(url, '^https?://[^\s/?#]+([/?#].*)?$') THEN 1 ELSE 0 END, 0 FROM pages""")
def email_url_valid(spark, sf):
    """Every word of every document, and every page address."""
    words = _documents(spark, sf).select("doc_id", F.explode(F.split("text", "[ \n\t\r]+")).alias("word"))
    words = words.filter("word <> ''")
    counted = words.groupBy("doc_id").agg(
        F.count_if(urls.http_url_valid(c("word"))).alias("n_urls"), F.count_if(urls.email_valid(c("word"))).alias("n_emails")
    )
    pages = read_table(spark, sf, "pages").select(
        (-1 - c("page_id")).alias("doc_id"),
        urls.http_url_valid(c("url")).cast("bigint").alias("n_urls"),
        F.lit(0).cast("bigint").alias("n_emails"),
    )
    return counted.unionByName(pages)


@query(r"""SELECT doc_id AS id, sha256(source) AS owner, regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', '[email]', 'g') AS text FROM documents
UNION ALL SELECT -1 - c_custkey, sha256(c_name), NULL FROM customer""")
def mask_personal(spark, sf):
    """Addresses inside texts, and names as digests."""
    docs = _documents(spark, sf).select(
        c("doc_id").alias("id"), text.mask_identity(c("source")).alias("owner"), text.mask_emails(c("text")).alias("text")
    )
    people = read_table(spark, sf, "customer").select(
        (-1 - c("c_custkey")).alias("id"),
        text.mask_identity(c("c_name")).alias("owner"),
        F.lit(None).cast("string").alias("text"),
    )
    return docs.unionByName(people)


_PRINTED = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE
  WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
  WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%d %b %Y')
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d-%m-%Y')
  WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%B %d, %Y')
  ELSE '31/02/' || strftime(o_orderdate, '%Y') END AS printed FROM orders"""


def _printed(spark, sf):
    """Order dates in the six accepted shapes; some open low-priority ones on a day that never was."""
    day, kind, status = c("o_orderdate"), c("o_orderpriority"), c("o_orderstatus")
    printed = (
        F.when(kind == "1-URGENT", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "2-HIGH", F.date_format(day, "dd/MM/yyyy"))
        .when(kind == "3-MEDIUM", F.date_format(day, "dd MMM yyyy"))
        .when(kind == "4-NOT SPECIFIED", F.date_format(day, "dd-MM-yyyy"))
        .when(status == "F", F.date_format(day, "yyyy-MM-dd"))
        .when(status == "O", F.date_format(day, "MMMM dd, yyyy"))
        .otherwise(F.concat(F.lit("31/02/"), F.date_format(day, "yyyy")))
    )
    return read_table(spark, sf, "orders").select(
        "o_orderkey", day.cast("date").alias("day"), printed.alias("printed")
    )


_TRY_DATE = """CAST(try_strptime({0}, ['%Y-%m-%dT%H:%M:%SZ', '%d/%m/%Y', '%d %b %Y', '%d-%m-%Y', '%Y-%m-%d', '%B %d, %Y']) AS DATE)"""


@query(f"""SELECT o_orderkey, {_TRY_DATE.format('printed')} AS day,
CASE WHEN {_TRY_DATE.format('printed')} IS NULL THEN 'not a date' END AS error FROM ({_PRINTED})""")
def parse_event_date_strict(spark, sf):
    parsed = _printed(spark, sf).select("o_orderkey", dates.parse_event_date_strict(c("printed")).alias("d"))
    return parsed.select("o_orderkey", c("d.value").alias("day"), "d.error")


@query(f"SELECT o_orderkey, printed, {_TRY_DATE.format('printed')} AS day FROM ({_PRINTED})")
def parse_event_date(spark, sf):
    return _printed(spark, sf).select("o_orderkey", "printed", dates.parse_event_date(c("printed")).alias("day"))


@query(f"""WITH p AS ({_PRINTED}), l AS (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS shipped, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, printed, {_TRY_DATE.format('printed')} AS s, shipped, last, o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice < 100000) AS swapped
      FROM p JOIN l ON l_orderkey = o_orderkey),
e AS (SELECT o_orderkey, CASE WHEN swapped THEN last ELSE s END AS a, CASE WHEN swapped THEN s ELSE last END AS b FROM j),
f AS (SELECT *, CASE WHEN a IS NULL THEN 'unreadable start date' WHEN b IS NULL THEN 'unreadable end date' WHEN b < a THEN 'end before start' END AS error FROM e)
SELECT o_orderkey, CASE WHEN error IS NULL THEN a END AS start_date, CASE WHEN error IS NULL THEN b END AS end_date, error FROM f""")
def parse_date_range(spark, sf):
    """Order date to last shipping date; cheap orders are printed the wrong way round."""
    last = read_table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("_last")
    )
    cheap = read_table(spark, sf, "orders").select("o_orderkey", (c("o_totalprice") < 100000).alias("_swapped"))
    rows = _printed(spark, sf).join(last, "o_orderkey").join(cheap, "o_orderkey")
    shipped = F.date_format("_last", "dd/MM/yyyy")
    pair = F.when(c("_swapped"), F.concat_ws(" - ", shipped, "printed")).otherwise(F.concat_ws(" - ", "printed", shipped))
    rows = rows.select("o_orderkey", pair.alias("pair"))
    parsed = rows.select("o_orderkey", dates.parse_date_range(c("pair")).alias("r"))
    return parsed.select("o_orderkey", "r.start_date", "r.end_date", "r.error")


@query(f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) >= DATE '{t.AS_OF_DATE}' AS upcoming FROM orders""")
def is_upcoming(spark, sf):
    flag = dates.is_upcoming(c("o_orderdate").cast("date"), t.as_of_date())
    return read_table(spark, sf, "orders").select("o_orderkey", flag.alias("upcoming"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def format_date(spark, sf):
    day = dates.format_date(c("o_orderdate").cast("date"))
    return read_table(spark, sf, "orders").select("o_orderkey", day.alias("day"))


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN date_trunc('second', ts) - INTERVAL 3 HOUR
  WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN date_trunc('second', ts) + INTERVAL 90 MINUTE
  ELSE date_trunc('second', ts) END AS ts FROM events""")
def parse_timestamp(spark, sf):
    """Event times printed with Z, with offsets, without a zone, and unreadable."""
    shown = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    printed = (
        F.when(c("event_type") == "click", F.concat(shown, F.lit("+03:00")))
        .when(c("event_type") == "signup", F.concat(shown, F.lit("-0130")))
        .when(c("event_type") == "view", F.concat(shown, F.lit("Z")))
        .when(c("event_type") == "error", "soon")
        .otherwise(shown)
    )
    return read_table(spark, sf, "events").select("event_id", dates.parse_timestamp(printed).alias("ts"))
