"""Typed rows out of landed pages: countries, sections, section details, activities.

Selectors say where a field is; everything else is column expressions on the matched elements.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.functions import dates, geo, slugs, text, urls
from orgmetrics.operators.joins import lookup_join
from orgmetrics.sources.html import all_of, first_of, inside, match_nodes, node_text, nodes_of

# Where the account pages keep their fields.
ACCOUNT_SELECTORS = {
    "country_link": 'a[href*="/country/"]',
    "section_link": '.views-view-grid a[href*="/section/"]',
    "email": ".field--name-field-email .field--item",
    "website": 'a[title="Website of the organisation"]',
    "university_name": ".field--name-field-university-name .field--item",
    "address": ".field--name-field-address .field--item .address",
    "address_part": ".field--name-field-address .field--item .address span",
    "coordinates": ".geolocation-location[data-lat]",
    "logo": '.center-block.img-responsive[alt*="Logo"]',
    "social": 'a[title*="profile"]',
    "city": ".field--name-field-city .field--item",
}

# Where the activity pages keep their fields, alternatives numbered by preference.
ACTIVITY_SELECTORS = {
    "card": "article.activities-mini-preview",
    "card_link": ".eg-c-card-title a",
    "last_page": "a[title='Go to last page']",
    "title_1": ".block--eg-activities-theme-page-title h1 span",
    "title_2": "h1",
    "description_1": ".ct-physical-activity__field-ct-act-description .field__item",
    "description_2": ".activity__field-ct-act-description .field__item",
    "date_1": ".field-top-wrapper.ct-physical-activity__field-ct-act-dates .highlight-data-text span",
    "date_2": ".highlight-dates-single span",
    "place_1": ".field-top-wrapper.ct-physical-activity__field-ct-act-location .highlight-data-text span",
    "place_2": ".field-top-wrapper.activity__field-ct-act-location .highlight-data-text span",
    "place_3": ".highlight-data-text span",
    "participants_1": ".highlight-data-text-big",
    "participants_2": ".highlight-data-number .highlight-data-text-big",
    "type_1": ".ct-physical-activity__field-ct-act-types .field__item a",
    "type_2": ".activity-types .activity-type a",
    "organiser_1": ".pseudo__items.pseudo__organisers a",
    "organiser_2": ".pseudo__organisers .pseudo__organiser a",
    "cause_1": ".activity-cause a",
    "cause_2": ".activity-causes .activity-label a",
    "sdg": ".field-sdgs-wrapper img",
    "objective": ".activity__objectives .field__item span",
    "goal_1": ".ct-physical-activity__field-ct-act-goal-activity .field__item",
    "goal_2": ".activity__field-ct-act-goal-activity .field__item",
    "goal_3": ".ct-online-activity__field-ct-act-goal-activity .field__item",
    "goal_item_1": ".ct-physical-activity__field-ct-act-goal-activity .field__item li",
    "goal_item_2": ".activity__field-ct-act-goal-activity .field__item li",
    "goal_item_3": ".ct-online-activity__field-ct-act-goal-activity .field__item li",
}

# Country names as the activity pages print them.
COUNTRY_CODES = {
    "Albania": "AL", "Armenia": "AM", "Austria": "AT", "Azerbaijan": "AZ", "Belgium": "BE",
    "Bosnia and Herzegovina": "BA", "Bulgaria": "BG", "Croatia": "HR", "Cyprus": "CY",
    "Czech Republic": "CZ", "Denmark": "DK", "Estonia": "EE", "Finland": "FI", "France": "FR",
    "Georgia": "GE", "Germany": "DE", "Greece": "GR", "Hungary": "HU", "Iceland": "IS",
    "Ireland": "IE", "Italy": "IT", "Jordan": "JO", "Kazakhstan": "KZ", "Latvia": "LV",
    "Liechtenstein": "LI", "Lithuania": "LT", "Luxembourg": "LU", "Malta": "MT",
    "Moldova": "MD", "Montenegro": "ME", "North Macedonia": "MK", "Norway": "NO",
    "Poland": "PL", "Portugal": "PT", "Romania": "RO", "Russia": "RU", "Serbia": "RS",
    "Slovakia": "SK", "Slovenia": "SI", "Spain": "ES", "Sweden": "SE", "Switzerland": "CH",
    "the Netherlands": "NL", "Türkiye": "TR", "UK": "GB", "Ukraine": "UA",
}
UNKNOWN_COUNTRY = "XX"


@dataclass(frozen=True)
class Site:
    """The two sites of a network, and the prefix its section slugs carry.

    ``partitions`` deals the pages over so many tasks before they are parsed. Parsing costs far more
    than moving a page, so it pays where the landed files have fewer or less even row groups than
    there are cores; without it pages are parsed where they are read.
    """

    accounts_url: str
    activities_url: str
    prefix: str
    account_selectors: dict[str, str] = field(default_factory=lambda: dict(ACCOUNT_SELECTORS))
    activity_selectors: dict[str, str] = field(default_factory=lambda: dict(ACTIVITY_SELECTORS))
    country_marker: str = "/country/"
    section_marker: str = "/section/"
    activity_marker: str = "/activity/"
    partitions: int | None = None


def _only(selectors: dict[str, str], *labels: str) -> dict[str, str]:
    return {k: v for k, v in selectors.items() if k.rstrip("_0123456789") in labels or k in labels}


def _links(pages: DataFrame, selectors: dict[str, str], label: str, site: Site) -> DataFrame:
    """One row per matching link: the page's columns, ``position``, ``href``, ``link_text``."""
    keep = [c for c in pages.columns if c != "html"]
    found = match_nodes(pages, _only(selectors, label), partitions=site.partitions)
    links = F.transform(
        nodes_of(label),
        lambda n: F.struct(F.coalesce(n["href"], F.lit("")).alias("href"), node_text(n).alias("link_text")),
    )
    exploded = found.select(*keep, F.posexplode(links).alias("position", "link"))
    return exploded.select(*keep, "position", "link.href", "link.link_text")


def extract_countries(pages: DataFrame, site: Site, base: Column | None = None) -> DataFrame:
    """Countries linked from listing pages: two-letter codes with a name."""
    base = F.lit(site.accounts_url + "/") if base is None else base
    links = _links(pages, site.account_selectors, "country_link", site)
    code = urls.url_tail(F.col("href"), site.country_marker)
    return (
        links.withColumn("_code", code)
        .filter((F.length("_code") == 2) & (F.col("link_text") != ""))
        .select(
            *(c for c in pages.columns if c != "html"),
            "position",
            F.upper("_code").alias("country_code"),
            F.col("link_text").alias("name"),
            F.lower("_code").alias("slug"),
            urls.resolve_url(base, F.col("href")).alias("url_of_country"),
        )
        .withColumnRenamed("url_of_country", "country_url")
    )


def extract_sections(
    pages: DataFrame, site: Site, country_code: Column, base: Column | None = None
) -> DataFrame:
    """Sections linked from country pages; a link that cannot be read costs only itself."""
    base = F.lit(site.accounts_url + "/") if base is None else base
    links = _links(pages, site.account_selectors, "section_link", site)
    slug = urls.url_tail(F.col("href"), site.section_marker)
    name = F.col("link_text")
    own = slugs.activities_slug(name, site.prefix)
    return (
        links.withColumn("accounts_platform_slug", slug)
        .filter((F.col("accounts_platform_slug") != "") & (name != ""))
        .withColumn("activities_platform_slug", own)
        .select(
            *(c for c in pages.columns if c != "html"),
            "position",
            F.upper(country_code).alias("section_country"),
            name.alias("name"),
            "accounts_platform_slug",
            "activities_platform_slug",
            urls.resolve_url(base, F.col("href")).alias("accounts_url"),
            F.concat(
                F.lit(site.activities_url + "/organisation/"), F.col("activities_platform_slug")
            ).alias("activities_url"),
        )
    )


def extract_section_details(
    pages: DataFrame, site: Site, base: Column | None = None
) -> DataFrame:
    """Contact, place and social fields of section pages; NULL where the page lacks them."""
    base = F.lit(site.accounts_url + "/") if base is None else base
    labels = ("email", "website", "university_name", "address", "address_part")
    labels += ("coordinates", "logo", "social", "city")
    found = match_nodes(pages, _only(site.account_selectors, *labels), partitions=site.partitions)
    address = first_of("address")
    parts = _inside_of("address_part", address)
    point, logo = first_of("coordinates"), first_of("logo")
    place = geo.coordinates(point["data_lat"], point["data_lng"])
    profiles = F.filter(
        F.transform(
            nodes_of("social"),
            lambda n: F.struct(text.social_platform(n["title"]).alias("key"), n["href"].alias("value")),
        ),
        lambda e: e["key"].isNotNull(),
    )
    return found.select(
        *(c for c in pages.columns if c != "html"),
        node_text(first_of("email")).alias("email"),
        first_of("website")["href"].alias("website"),
        node_text(first_of("university_name")).alias("university_name"),
        F.when(
            address.isNotNull(), text.join_nonempty(F.transform(parts, lambda n: node_text(n)), ", ")
        ).alias("address"),
        place["latitude"].alias("latitude"),
        place["longitude"].alias("longitude"),
        F.when(logo.isNotNull(), urls.resolve_url(base, logo["src"])).alias("logo_url"),
        node_text(first_of("city")).alias("city"),
        _last_wins_map(profiles).alias("social_media"),
    )


def _last_wins_map(entries: Column) -> Column:
    """Map of (key, value) structs where a later key replaces an earlier one; empty gives NULL."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    values = F.transform(
        keys,
        lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"],
    )
    return F.when(F.size(keys) > 0, F.map_from_arrays(keys, values))


def last_page_number(pages: DataFrame, site: Site) -> DataFrame:
    """Highest listing page per first page; 0 without a readable link."""
    found = match_nodes(pages, _only(site.activity_selectors, "last_page"), partitions=site.partitions)
    number = urls.query_page_number(first_of("last_page")["href"])
    return found.select(*(c for c in pages.columns if c != "html"), number.alias("last_page"))


MOST_PAGES = 100_000  # of one listing; a page that claims more is not believed


def page_chunks(
    df: DataFrame, last_page: str = "last_page", size: int = urls.CHUNK_SIZE, most: int = MOST_PAGES
) -> DataFrame:
    """Ranges of listing pages, 0 to ``last_page`` inclusive, ``size`` pages each.

    Of a listing that claims more than ``most`` pages only the first page and the claimed last one
    are ranges: if that one has not landed it is logged like any other gap.
    """
    last = F.col(last_page)
    starts = F.when(last < most, F.sequence(F.lit(0), last, F.lit(size))).otherwise(F.array(F.lit(0), last))
    chunked = df.filter(last >= 0).withColumn("first_page", F.explode(starts))
    end = F.when(last < most, F.least(F.col("first_page") + size - 1, last)).otherwise(F.col("first_page"))
    return chunked.withColumn("final_page", end)


def extract_activity_links(pages: DataFrame, site: Site, base: Column | None = None) -> DataFrame:
    """One row per activity card of listing pages: the first title link inside the card."""
    return listed_cards(extract_listing(pages, site), site, base)


def extract_listing(pages: DataFrame, site: Site) -> DataFrame:
    """One row per listing page: ``last_page`` and the title link of each card, all in one reading."""
    keep = [c for c in pages.columns if c != "html"]
    wanted = _only(site.activity_selectors, "card", "card_link", "last_page")
    found = match_nodes(pages, wanted, partitions=site.partitions)
    # The card has to be in scope of the lambda, so links are looked up card by card in the row.
    links = F.transform(
        nodes_of("card"),
        lambda card: F.try_element_at(
            F.filter(nodes_of("card_link"), lambda n: inside(n, card)), F.lit(1)
        )["href"],
    )
    number = urls.query_page_number(first_of("last_page")["href"])
    return found.select(*keep, number.alias("last_page"), links.alias("links"))


def listed_cards(listing: DataFrame, site: Site, base: Column | None = None) -> DataFrame:
    """One row per activity card of listing pages that were read."""
    base = F.lit(site.activities_url + "/") if base is None else base
    keep = [c for c in listing.columns if c not in ("last_page", "links")]
    cards = listing.select(*keep, F.posexplode("links").alias("position", "href"))
    return cards.filter(F.col("href").contains(site.activity_marker)).select(
        *keep,
        "position",
        urls.resolve_url(base, F.col("href")).alias("activity_url"),
        urls.url_tail(F.col("href"), site.activity_marker).alias("event_slug"),
    )


def _inside_of(label: str, outer: Column) -> Column:
    return F.filter(nodes_of(label), lambda n: inside(n, outer))


def _texts(nodes: Column) -> Column:
    return F.filter(F.transform(nodes, lambda n: node_text(n)), lambda t: t != "")


def _numbered(selectors: dict[str, str], label: str) -> list[str]:
    return sorted(k for k in selectors if k.rstrip("_0123456789") == label)


def extract_activities(pages: DataFrame, site: Site, as_of: Column) -> DataFrame:
    """Activity fields of detail pages, by the first alternative that the page has."""
    s = site.activity_selectors
    labels = ("title", "description", "date", "place", "participants", "type", "organiser")
    labels += ("cause", "sdg", "objective", "goal", "goal_item")
    found = match_nodes(pages, _only(s, *labels), partitions=site.partitions)

    def first(label: str) -> Column:
        return first_of(*_numbered(s, label))

    def every(label: str) -> Column:
        return all_of(*_numbered(s, label))

    day = as_of.cast("date")
    places = every("place")
    date_texts = F.transform(every("date"), lambda n: node_text(n))
    goal = first("goal")
    # A goal with a list is the list's texts, also if they are all blank; else it is its own text.
    goal_text = node_text(goal)
    for label in reversed(_numbered(s, "goal")):
        one = first_of(label)
        own = _inside_of(label.replace("goal", "goal_item"), one)
        listed = F.when(F.size(own) > 0, F.array_join(_texts(own), "\n")).otherwise(node_text(one))
        goal_text = F.when(one.isNotNull(), listed).otherwise(goal_text)
    codes = F.create_map(*(F.lit(x) for pair in COUNTRY_CODES.items() for x in pair))

    raw = found.select(
        *(c for c in pages.columns if c != "html"),
        F.coalesce(node_text(first("title")), F.lit("Unknown Activity")).alias("title"),
        F.coalesce(node_text(first("description"), " "), F.lit("No description available")).alias(
            "description"
        ),
        dates.parse_event_date(F.try_element_at(date_texts, F.lit(1))).alias("_start"),
        dates.parse_event_date(F.try_element_at(date_texts, F.lit(2))).alias("_end"),
        node_text(F.try_element_at(places, F.lit(1))).alias("_city"),
        node_text(F.try_element_at(places, F.lit(2))).alias("_country"),
        text.digits_to_int(node_text(first("participants"))).alias("participants"),
        text.nonempty(node_text(first("type"))).alias("activity_type"),
        _texts(every("organiser")).alias("organisers"),
        F.array_sort(F.array_distinct(_texts(every("cause")))).alias("causes"),
        text.sdg_numbers(
            F.transform(nodes_of("sdg"), lambda n: F.coalesce(n["alt"], F.lit("")))
        ).alias("sdgs"),
        F.array_sort(F.array_distinct(_texts(nodes_of("objective")))).alias("objectives"),
        text.nonempty(goal_text).alias("activity_goal"),
    )
    start = F.coalesce("_start", day)
    end = F.when(F.col("_start").isNull(), day).otherwise(F.coalesce("_end", "_start"))
    columns = [c for c in raw.columns if not c.startswith("_")]
    return raw.select(
        *columns,
        start.alias("start_date"),
        end.alias("end_date"),
        (start > day).alias("is_future_event"),
        F.coalesce(text.nonempty(F.col("_city")), F.lit("Unknown")).alias("city"),
        F.coalesce(codes[F.col("_country")], F.lit(UNKNOWN_COUNTRY)).alias("country_code"),
    )


def page_fanout(
    sections: DataFrame, pages: DataFrame, site: Site, last_pages: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(listing pages found, listing pages that never landed) for every section's page range.

    ``sections`` holds ``activities_platform_slug``, which sections may share, and ``last_pages`` the
    last page by slug. Pass ``pages`` without their text: only addresses are compared. Ranges are
    built once per slug; the sections come last, so each gets every page once.
    """
    slug = "activities_platform_slug"
    others = [c for c in last_pages.columns if c not in (slug, "last_page")]
    last = last_pages.drop(*others).groupBy(slug).agg(F.max("last_page").alias("last_page"))
    chunks = page_chunks(last)
    wanted = chunks.withColumn("page", F.explode(F.sequence("first_page", "final_page")))
    wanted = wanted.withColumn(
        "url", urls.listing_page_url(site.activities_url, F.col(slug), F.col("page"))
    )
    landed = lookup_join(pages, wanted, "url").join(sections, slug)
    missing = wanted.join(pages.select("url").distinct(), "url", "left_anti").join(sections, slug)
    return landed, missing


def linked_activities(cards: DataFrame) -> DataFrame:
    """Each linked detail page once, however many sections list it."""
    return cards.groupBy(F.col("activity_url").alias("url")).agg(
        F.min("event_slug").alias("event_slug")
    )
