"""Extraction from the landed pages (A1, A2, B1-B8), plain and with platform markup added."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from orgmetrics.functions import urls
from orgmetrics.operators import extraction
from orgmetrics.operators.validation import Ruleset, activity_rules
from orgmetrics.queries import tables as t
from orgmetrics.queries.functions import _slug_sql
from orgmetrics.queries.registry import query
from orgmetrics.session import shared_dir
from orgmetrics.sources.pages import has_html_element
from orgmetrics.sources.versions import VersionedTable, bucket_of
from orgmetrics.streaming.incremental import ingest_upserts
from orgmetrics.queries.tables import read_table

c = F.col

CARD_BUCKETS = 16  # of the stored cards; a larger network takes more

# The sample pages link through a menu, so menu links stand for country, section and activity links.
PLAIN = extraction.Site(
    accounts_url=t.BASE,
    activities_url="https://activities.example.org",
    prefix="net",
    account_selectors={
        **extraction.ACCOUNT_SELECTORS,
        "country_link": "nav a[href]",
        "section_link": 'nav li a[href*="/"]',
    },
    activity_selectors={
        **extraction.ACTIVITY_SELECTORS,
        "card": "nav li",
        "card_link": "ul a",
    },
    country_marker="/",
    section_marker="/",
    activity_marker="/",
)

# The platforms' own selectors, for pages that carry the platforms' markup.
PLATFORM = extraction.Site(t.BASE, "https://activities.example.org", "net")


def _dealt(spark, site):
    """The sample's page file is one row group: its pages are dealt over the session's partitions."""
    return replace(site, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


_LINKS = """links AS (
  SELECT page_id, url, generate_subscripts(m, 1) - 1 AS position, unnest(m) AS link
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS m FROM pages)),
parts AS (
  SELECT page_id, url, CAST(position AS INTEGER) AS position, regexp_extract(link, 'href="([^"]*)"', 1) AS href,
         trim(regexp_extract(link, '>([^<]*)<', 1)) AS label
  FROM links)"""

_ROOT = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"


def _pages(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", "url", "html")


@query("SELECT page_id, url, length(html) AS n_chars, md5(html) AS digest FROM pages")
def page_scan(spark, sf):
    return _pages(spark, sf).select(
        "page_id", "url", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("digest")
    )


@query("""SELECT page_id AS id, regexp_matches(html, '(?i)<html[\\s>/]') AS accepted FROM pages
UNION ALL SELECT -1 - doc_id, regexp_matches(text, '(?i)<html[\\s>/]') FROM documents""")
def page_gate(spark, sf):
    """Pages pass; plain documents landed by mistake do not."""
    docs = read_table(spark, sf, "documents").select((-1 - c("doc_id")).alias("id"), c("text").alias("html"))
    landed = _pages(spark, sf).select(c("page_id").alias("id"), "html").unionByName(docs)
    return landed.select("id", has_html_element(c("html")).alias("accepted"))


@query(f"""WITH {_LINKS}
SELECT page_id, position, upper(replace(trim(href, '/'), 'ß', 'ss')) AS country_code, label AS name, lower(trim(href, '/')) AS slug, {_ROOT} || href AS country_url
FROM parts WHERE length(trim(href, '/')) = 2 AND label <> ''""")
def extract_countries(spark, sf):
    """Menu links whose target is two characters long."""
    found = extraction.extract_countries(_pages(spark, sf), _dealt(spark, PLAIN), base=c("url"))
    return found.select("page_id", "position", "country_code", "name", "slug", "country_url")


@query(f"""WITH {_LINKS},
s AS (SELECT *, upper(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1)) AS country_code, trim(href, '/') AS slug FROM parts)
SELECT page_id, position, country_code, label AS name, slug AS accounts_platform_slug, n AS activities_platform_slug, {_ROOT} || href AS accounts_url,
       'https://activities.example.org/organisation/' || n AS activities_url
FROM (SELECT *, {_slug_sql("CASE WHEN lower(label) LIKE 'net%' THEN label ELSE 'net ' || label END")} AS n FROM s) WHERE slug <> '' AND label <> ''""")
def extract_sections(spark, sf):
    """Menu links as sections of the country that the page's path names."""
    country = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    found = extraction.extract_sections(_pages(spark, sf), _dealt(spark, PLAIN), country, base=c("url"))
    return found.select(
        "page_id",
        "position",
        c("section_country").alias("country_code"),
        "name",
        "accounts_platform_slug",
        "activities_platform_slug",
        "accounts_url",
        "activities_url",
    )


@query(f"""WITH {_LINKS}
SELECT page_id, position, {_ROOT} || href AS activity_url, trim(href, '/') AS event_slug FROM parts WHERE href LIKE '%/%'""")
def extract_activity_links(spark, sf):
    """Menu items as activity cards."""
    found = extraction.extract_activity_links(_pages(spark, sf), _dealt(spark, PLAIN), base=c("url"))
    return found.select("page_id", "position", "activity_url", "event_slug")


def _number():
    return F.regexp_extract("url", r"^https?://[^/]+/[a-z]+/(\d+)", 1)


_NUMBER = r"regexp_extract(url, '^https?://[^/]+/[a-z]+/(\d+)', 1)"


def _with_markup(spark, sf, *parts):
    """The landed pages with platform markup added before their footer."""
    block = F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit("<footer>"))
    return _pages(spark, sf).withColumn("html", F.replace(c("html"), F.lit("<footer>"), block))


def _field(name, value):
    return (
        f'<div class="field--name-field-{name}"><div class="label">x</div><div class="field--item"> ',
        value,
        " </div></div>",
    )


@query(f"""SELECT page_id, 'mail' || page_id || '@example.org' AS email, 'http://site' || page_id || '.example.org' AS website,
'University ' || {_NUMBER} AS university_name, 'Street ' || page_id || ', ' || {_NUMBER} || ' Town' AS address,
CASE WHEN url LIKE 'https:%' THEN CAST(least(page_id / 1000, 89.5) AS DECIMAL(9,6)) END AS latitude, CASE WHEN url LIKE 'https:%' THEN 3.140041::DECIMAL(9,6) END AS longitude,
{_ROOT} || '/logo/' || page_id || '.png' AS logo_url, 'City ' || {_NUMBER} AS city,
'{{"facebook":"https://new.example.org/' || page_id || '","x":"https://x.example.org"}}' AS social_media FROM pages""")
def extract_section_details(spark, sf):
    """Every landed page as a section page: detail fields next to its own menu and article."""
    key = c("page_id").cast("string")
    north = F.least(c("page_id") / 1000, F.lit(89.5)).cast("decimal(9,6)")
    pages = _with_markup(
        spark,
        sf,
        *_field("email", F.concat(F.lit("mail"), key, F.lit("@example.org"))),
        '<a title="Website of the organisation" href="http://site',
        key,
        '.example.org">site</a>',
        *_field("university-name", F.concat(F.lit("University "), _number())),
        '<div class="field--name-field-address"><div class="field--item"><p class="address"><span>Street ',
        key,
        "</span><br><span> </span><span>",
        _number(),
        " Town</span></p></div></div><span>outside</span>",
        '<span class="geolocation-location" data-lat="',
        F.when(c("url").startswith("https:"), north.cast("string")).otherwise("north"),
        '" data-lng="3.1400411"></span><img class="center-block big img-responsive" alt="Logo of it" src="/logo/',
        key,
        '.png">',
        *_field("city", F.concat(F.lit("City "), _number())),
        '<a title="Facebook profile" href="https://old.example.org">f</a><a title="X profile" href="https://x.example.org">x</a>'
        '<a title="facebook profile" href="https://new.example.org/',
        key,
        '">f</a>',
    )
    found = extraction.extract_section_details(pages, _dealt(spark, PLATFORM), base=c("url"))
    return found.drop("url").withColumn("social_media", F.to_json("social_media"))


_TITLE = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"


def _unescaped(expression: str) -> str:
    # Titles may be cut off inside an entity: the closing semicolon is optional in HTML.
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        expression = f"regexp_replace({expression}, '&{entity};?', '{char}', 'g')"
    return expression


@query(f"""WITH p AS (SELECT *, CAST({_NUMBER} AS INTEGER) AS n FROM pages)
SELECT page_id, trim({_unescaped(_TITLE)}) AS title,
       'About ' || trim({_unescaped("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")}) AS description,
       CASE WHEN n < 600 THEN DATE '1998-01-01' + n ELSE DATE '{t.AS_OF_DATE}' END AS start_date,
       CASE WHEN n < 600 THEN DATE '1998-01-01' + n + CASE WHEN n >= 300 THEN 2 ELSE 0 END ELSE DATE '{t.AS_OF_DATE}' END AS end_date,
       n < 600 AND DATE '1998-01-01' + n > DATE '{t.AS_OF_DATE}' AS is_future_event,
       'City ' || n AS city, CASE WHEN url LIKE 'https:%' THEN 'TR' ELSE 'XX' END AS country_code,
       n * 1000 + 7 AS participants, CASE WHEN n >= 500 THEN 'Type ' || n // 100 END AS activity_type,
       'Org ' || page_id || ',Net ' || n AS organisers, CASE WHEN n >= 500 THEN 'Culture,Health' ELSE 'Culture' END AS causes,
       CASE WHEN n // 50 BETWEEN 1 AND 17 AND n // 50 <> 3 THEN least(n // 50, 3) || ',' || greatest(n // 50, 3) ELSE '3' END AS sdgs,
       'Goal of ' || page_id AS objectives, CASE WHEN n >= 500 THEN 'one ' || n || chr(10) || 'two' ELSE 'plain ' || n END AS activity_goal
FROM p""")
def extract_activities(spark, sf):
    """Every landed page as an activity page: platform fields next to its own text and menu."""
    n, key = _number(), c("page_id").cast("string")
    number = n.cast("int")
    start = F.date_add(F.lit("1998-01-01").cast("date"), number)
    big, dated = number >= 500, number < 600
    shown_start = F.when(number < 300, F.date_format(start, "dd/MM/yyyy")).otherwise(F.date_format(start, "dd MMM yyyy"))
    end = F.when(number >= 300, F.concat(F.lit("<span>"), F.date_format(F.date_add(start, 2), "yyyy-MM-dd"), F.lit("</span>")))
    ad = F.regexp_extract("html", '<div class="ad">([^<]*)</div>', 1)
    pages = _with_markup(
        spark,
        sf,
        '<div class="ct-physical-activity__field-ct-act-description"><div class="field__item"> About <i> ',
        ad,
        " </i></div></div>",
        F.when(
            dated,
            F.concat(
                F.lit('<div class="highlight-dates-single"><span>'), shown_start, F.lit("</span>"), F.coalesce(end, F.lit("")), F.lit("</div>")
            ),
        ).otherwise(""),
        '<div class="field-top-wrapper activity__field-ct-act-location x"><div class="highlight-data-text"><span>City ',
        n,
        "</span><span>",
        F.when(c("url").startswith("https:"), "Türkiye").otherwise("Atlantis"),
        '</span></div></div><div class="highlight-data-number"><span class="highlight-data-text-big">',
        F.concat(n, F.lit(".007 people")),
        "</span></div>",
        F.when(
            big,
            F.concat(
                F.lit('<div class="activity-types"><span class="activity-type"><a> Type '), F.floor(number / 100).cast("string"), F.lit("</a></span></div>")
            ),
        ).otherwise(""),
        '<div class="pseudo__organisers"><div class="pseudo__organiser"><a>Org ',
        key,
        '</a><a> </a></div><div class="pseudo__organiser"><a>Net ',
        n,
        '</a></div></div><div class="activity-cause"><a>',
        F.when(big, "Health").otherwise("Culture"),
        "</a><a>Culture</a></div>",
        '<div class="field-sdgs-wrapper"><img alt="SDG 3"><img alt="icon goal ',
        F.floor(number / 50).cast("string"),
        '"><img></div><div class="activity__objectives"><div class="field__item"><span>Goal of ',
        key,
        '</span></div></div><div class="ct-online-activity__field-ct-act-goal-activity"><div class="field__item">',
        F.when(big, F.concat(F.lit("<ul><li>one "), n, F.lit("</li><li> two</li></ul>"))).otherwise(F.concat(F.lit("plain "), n)),
        "</div></div>",
    )
    found = extraction.extract_activities(pages, _dealt(spark, PLATFORM), t.as_of_date()).drop("url")
    lists = {x: F.array_join(c(x).cast("array<string>"), ",") for x in ("organisers", "causes", "sdgs", "objectives")}
    return found.withColumns(lists)


def _listing_pages(spark, sf):
    return _with_markup(
        spark, sf, F.concat(F.lit('<a title="Go to last page" href="?tag=x&amp;page='), _number(), F.lit('">Last</a>'))
    )


@query(f"SELECT page_id, CAST({_NUMBER} AS INTEGER) AS last_page FROM pages")
def last_page_number(spark, sf):
    """Every landed page as the first listing page of a section."""
    return extraction.last_page_number(_listing_pages(spark, sf), _dealt(spark, PLATFORM)).drop("url")


@query(f"""WITH l AS (SELECT page_id, CAST({_NUMBER} AS INTEGER) AS last_page FROM pages),
r AS (SELECT page_id, last_page, CAST(unnest(range(0, last_page + 1, 5)) AS INTEGER) AS first_page FROM l)
SELECT page_id, last_page, first_page, least(first_page + 4, last_page) AS final_page FROM r""")
def page_chunks(spark, sf):
    return extraction.page_chunks(last_page_number(spark, sf))


def _landed_listing(spark, sf):
    """Landed pages as listing pages: language as section slug, number as page number."""
    slug = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    number = _number().cast("int")
    return read_table(spark, sf, "pages").select(
        "page_id", slug.alias("slug"), number.alias("number"), urls.listing_page_url(PLATFORM.activities_url, slug, number).alias("url")
    )


@query(rf"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS slug, CAST({_NUMBER} AS INTEGER) AS n FROM pages),
w AS (SELECT slug, CAST(unnest(range(0, max(n) + 1)) AS INTEGER) AS page FROM p GROUP BY 1)
SELECT w.slug AS activities_platform_slug, page, p.page_id, p.page_id IS NOT NULL AS landed
FROM w LEFT JOIN p ON p.slug = w.slug AND p.n = w.page""")
def page_fanout(spark, sf):
    """Sections times their page ranges, met with what has landed."""
    listing = _landed_listing(spark, sf)
    last = listing.groupBy(c("slug").alias("activities_platform_slug")).agg(F.max("number").alias("last_page"))
    sections = last.select("activities_platform_slug")
    landed, missing = extraction.page_fanout(sections, listing.select("page_id", "url"), PLATFORM, last)
    shown = ["activities_platform_slug", "page"]
    return landed.select(*shown, "page_id", F.lit(True).alias("landed")).unionByName(
        missing.select(*shown, F.lit(None).cast("bigint").alias("page_id"), F.lit(False).alias("landed"))
    )


@query(f"""WITH {_LINKS},
e AS (SELECT page_id, position, {_ROOT} || href AS activity_url, trim(href, '/') AS event_slug FROM parts WHERE href LIKE '%/%'),
v AS (SELECT *, lower(event_slug) AS slug FROM e
      WHERE event_slug <> '' AND regexp_full_match(replace(replace(lower(event_slug), '-', ''), '_', ''), '[\\p{{L}}\\p{{N}}]+'))
SELECT slug AS event_slug, arg_max(activity_url, (page_id, position)) AS url, max(page_id) AS page_id
FROM v GROUP BY 1""")
def incremental_ingest(spark, sf):
    """The landed pages as a stream of files: cards extracted, checked and kept up to date."""
    state = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"

    def extract(pages):
        cards = extraction.extract_activity_links(pages, PLAIN, base=c("url"))
        return cards.select("event_slug", c("activity_url").alias("url"), "page_id", "position")

    columns = "event_slug string, url string, page_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
    keys = ["event_slug"]
    table = VersionedTable(f"{state}/table", columns, bucket_of(keys, CARD_BUCKETS))
    # A pattern fits a single file as well as a folder of files.
    ingest_upserts(
        spark, f"{sf}/pages*.parquet", state, extract, _card_rules(), table, keys, ["url", "page_id"],
        ["page_id", "position"], t.as_of_time(),
    )
    return table.read(spark).select("event_slug", "url", "page_id")


def _card_rules():
    """The rules of an activity that a card already has the fields for."""
    rules = activity_rules()
    wanted = ("event_slug", "url")
    return Ruleset(rules.clean, [(f, checks) for f, checks in rules.checks if f in wanted])
