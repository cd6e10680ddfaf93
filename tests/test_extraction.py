"""Hand-written pages with the platforms' markup."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orgmetrics.operators import extraction, statistics
from orgmetrics.schemas import PAGE_DDL
from orgmetrics.sources.html import match_nodes
from orgmetrics.sources.pages import page_gate
from orgmetrics.sources.settings_json import page_statistics
from tests.conftest import rows

SITE = extraction.Site("https://accounts.example.org", "https://activities.example.org", "net")


def pages(spark, *html, url="https://accounts.example.org/"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(html)], PAGE_DDL)


def as_of():
    return F.lit("2023-11-08").cast("date")


def texts(spark, html, **selectors):
    """label -> list of (texts, href) of the matching elements."""
    page = match_nodes(pages(spark, html), selectors).first()
    found = {label: [] for label in selectors}
    for n in page["nodes"]:
        found[n["sel"]].append(page["texts"][n["first_text"] : n["end_text"]])
    return found


@pytest.mark.parametrize(
    ("selector", "expected"),
    [
        ("p", [["one", "two", "three"], ["two"]]),
        (".a", [["one", "two", "three"]]),
        ("p.a.b", [["one", "two", "three"]]),
        ("p.a.c", []),
        ("div.x b", [["two"]]),
        ("div .x b", []),
        ("[data-k]", [["one", "two", "three"]]),
        ('[data-k="v w"]', [["one", "two", "three"]]),
        ('p[data-k*="w"] b', [["two"]]),
        ("[data-k='v']", []),
        ("a[href]", [["A & B"]]),
        ("script", [[]]),
        ("i", [["x", "y"]]),
    ],
)
def test_selectors(spark, selector, expected):
    html = (
        '<html><div class="x"><P class="b a" data-k="v w"> one <p><b>two</b></p>three</div>'
        "<script>var s = '<p>no</p>';</script><a href='/h'>A &amp; B</a><i>x<!-- c -->y</i></html>"
    )
    assert texts(spark, html, s=selector)["s"] == expected


def test_unclosed_elements_reach_to_their_parents_end(spark):
    html = "<html><ul><li>a<li>b</ul><p>c"
    assert texts(spark, html, li="li", p="p") == {"li": [["a", "b"], ["b"]], "p": [["c"]]}


def test_page_gate(spark):
    good, bad = page_gate(pages(spark, "<!DOCTYPE html><HTML lang=x><p>", "plain", None, "<htmlx>"))
    assert [r["page_id"] for r in good.collect()] == [0]
    assert rows(bad.select("page_id", "error_message")) == [(i, "no html element") for i in (1, 2, 3)]


def test_countries(spark):
    html = """<html><a href="/country/tr"> Türkiye </a><a href="https://accounts.example.org/country/DE/">Germany</a>
      <a href="/country/fra">France</a><a href="/country/it"> </a><a href="/other">x</a></html>"""
    found = extraction.extract_countries(pages(spark, html), SITE)
    assert rows(found.select("country_code", "name", "slug", "country_url")) == [
        ("DE", "Germany", "de", "https://accounts.example.org/country/DE/"),
        ("TR", "Türkiye", "tr", "https://accounts.example.org/country/tr"),
    ]


def test_sections(spark):
    html = """<html><a href="/section/out">outside</a><div class="x views-view-grid"><a href="/section/tr-anka-met"> Net METU</a>
      <a href="">empty</a><a href="/section/">no slug</a><a href="/section/tr-b"></a><a href="/section/tr-c/">Yıldız</a></div></html>"""
    found = extraction.extract_sections(pages(spark, html), SITE, F.lit("tr"))
    shown = found.select("section_country", "name", "accounts_platform_slug", "activities_platform_slug", "accounts_url", "activities_url")
    assert rows(shown) == [
        ("TR", "Net METU", "tr-anka-met", "net-metu", "https://accounts.example.org/section/tr-anka-met", "https://activities.example.org/organisation/net-metu"),
        ("TR", "Yıldız", "tr-c", "net-yildiz", "https://accounts.example.org/section/tr-c/", "https://activities.example.org/organisation/net-yildiz"),
    ]


SECTION = """<html><div class="field--name-field-email"><div class="field--item"> a@b.org </div></div>
<a title="Website of the organisation" href="http://site.org">s</a>
<div class="field--name-field-university-name"><div class="field--item">Uni</div></div>
<div class="field--name-field-address"><div class="field--item"><p class="address"><span>Street 1</span><br><span> </span><span>Town</span></p></div></div>
<span>not address</span><span class="geolocation-location" data-lat="39.89351111" data-lng=" 32.7767 "></span>
<img class="img-responsive center-block" alt="The Logo" src="/logo.png">
<div class="field--name-field-city"><div class="field--item">Ankara</div></div>
<a title="Facebook profile" href="https://f/1">f</a><a title="facebook profile" href="https://f/2">f</a><a title="X profile" href="https://x">x</a></html>"""


def test_section_details(spark):
    row = extraction.extract_section_details(pages(spark, SECTION), SITE).first()
    assert row.asDict() == {
        "page_id": 0,
        "url": "https://accounts.example.org/",
        "email": "a@b.org",
        "website": "http://site.org",
        "university_name": "Uni",
        "address": "Street 1, Town",
        "latitude": Decimal("39.893511"),
        "longitude": Decimal("32.776700"),
        "logo_url": "https://accounts.example.org/logo.png",
        "city": "Ankara",
        "social_media": {"facebook": "https://f/2", "x": "https://x"},
    }


@pytest.mark.parametrize("attributes", ['data-lat="1"', 'data-lat="1" data-lng="x"', 'data-lat="" data-lng="2"'])
def test_one_bad_coordinate_voids_both(spark, attributes):
    html = f'<html><i class="geolocation-location" {attributes}></i></html>'
    row = extraction.extract_section_details(pages(spark, html), SITE).first()
    assert (row["latitude"], row["longitude"], row["email"], row["social_media"]) == (None, None, None, None)


LISTING = """<html><article class="x activities-mini-preview"><h2 class="eg-c-card-title"><a href="/activity/boat-1">Boat</a></h2>
<div class="eg-c-card-title"><a href="/activity/second">no</a></div></article>
<article class="activities-mini-preview"><div class="eg-c-card-title"><a href="/news/2">x</a></div></article>
<article class="activities-mini-preview"></article><div class="eg-c-card-title"><a href="/activity/outside">x</a></div>
<article class="activities-mini-preview"><div class="eg-c-card-title"><a href="https://activities.example.org/activity/walk-2/">x</a></div></article>
<a title="Go to last page" href="?tag=a&amp;page=27">Last</a></html>"""


def test_activity_links(spark):
    found = extraction.extract_activity_links(pages(spark, LISTING), SITE)
    assert rows(found.select("position", "event_slug", "activity_url")) == [
        (0, "boat-1", "https://activities.example.org/activity/boat-1"),
        (3, "walk-2", "https://activities.example.org/activity/walk-2/"),
    ]


def test_last_page_and_chunks(spark):
    found = extraction.last_page_number(pages(spark, LISTING, "<html></html>", LISTING.replace("27", "x")), SITE)
    assert [r["last_page"] for r in found.orderBy("page_id").collect()] == [27, 0, 0]
    chunks = extraction.page_chunks(found.filter("page_id < 2"))
    none = spark.createDataFrame([(-3,)], "last_page int")
    assert extraction.page_chunks(none).count() == 0
    claimed = spark.createDataFrame([(2_000_000_000,)], "last_page int")
    assert rows(extraction.page_chunks(claimed).select("first_page", "final_page")) == [(0, 0), (2_000_000_000, 2_000_000_000)]
    assert rows(chunks.select("page_id", "first_page", "final_page")) == sorted(
        [(0, 0, 4), (0, 5, 9), (0, 10, 14), (0, 15, 19), (0, 20, 24), (0, 25, 27), (1, 0, 0)], key=str
    )


def activity(spark, html):
    return extraction.extract_activities(pages(spark, f"<html>{html}</html>"), SITE, as_of()).first().asDict()


def test_physical_activity(spark):
    row = activity(
        spark,
        """<div class="block--eg-activities-theme-page-title"><h1><span>Boat Party</span></h1></div>
        <div class="ct-physical-activity__field-ct-act-description"><div class="field__item"><p>First</p><p>second.</p></div></div>
        <div class="field-top-wrapper ct-physical-activity__field-ct-act-dates"><div class="highlight-data-text"><span>08/11/2023</span><span>10 Nov 2023</span></div></div>
        <div class="field-top-wrapper ct-physical-activity__field-ct-act-location"><div class="highlight-data-text"><span>Istanbul</span><span>Türkiye</span></div></div>
        <span class="highlight-data-text-big">1.234 people</span>
        <div class="ct-physical-activity__field-ct-act-types"><div class="field__item"><a>Social</a></div></div>
        <div class="pseudo__items pseudo__organisers"><a>Net Yıldız</a><a> </a></div>
        <div class="activity-cause"><a>Health</a></div><div class="activity-cause"><a>Culture</a><a>Health</a></div>
        <div class="field-sdgs-wrapper"><img alt="SDG 4"><img alt="Goal  3"><img alt="SDG 18"><img></div>
        <div class="activity__objectives"><div class="field__item"><span>Well-Being</span></div></div>
        <div class="ct-physical-activity__field-ct-act-goal-activity"><div class="field__item"><ul><li>fun</li><li> </li><li>fun</li></ul></div></div>""",
    )
    assert row == {
        "page_id": 0,
        "url": "https://accounts.example.org/",
        "title": "Boat Party",
        "description": "First second.",
        "participants": 1234,
        "activity_type": "Social",
        "organisers": ["Net Yıldız"],
        "causes": ["Culture", "Health"],
        "sdgs": [3, 4],
        "objectives": ["Well-Being"],
        "activity_goal": "fun\nfun",
        "start_date": dt.date(2023, 11, 8),
        "end_date": dt.date(2023, 11, 10),
        "is_future_event": False,
        "city": "Istanbul",
        "country_code": "TR",
    }


def test_fallbacks(spark):
    row = activity(
        spark,
        """<h1>Online</h1><div class="activity__field-ct-act-description"><div class="field__item">Text</div></div>
        <div class="highlight-dates-single"><span>2024-01-01T10:00:00Z</span><span>someday</span></div>
        <div class="highlight-data-text"><span></span><span>Atlantis</span></div>
        <div class="pseudo__organisers"><div class="pseudo__organiser"><a>Org</a></div></div>
        <div class="activity-causes"><div class="activity-label"><a>Sport</a></div></div>
        <div class="ct-online-activity__field-ct-act-goal-activity"><div class="field__item">Learn</div></div>""",
    )
    assert (row["title"], row["description"], row["activity_goal"]) == ("Online", "Text", "Learn")
    assert (row["start_date"], row["end_date"], row["is_future_event"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 1), True)
    assert (row["city"], row["country_code"], row["activity_type"]) == ("Unknown", "XX", None)
    assert (row["organisers"], row["causes"]) == (["Org"], ["Sport"])


def test_bare_page_gets_defaults(spark):
    row = activity(spark, "<p>nothing</p>")
    assert (row["title"], row["description"], row["city"], row["country_code"]) == (
        "Unknown Activity",
        "No description available",
        "Unknown",
        "XX",
    )
    assert (row["start_date"], row["end_date"], row["is_future_event"], row["participants"]) == (
        dt.date(2023, 11, 8),
        dt.date(2023, 11, 8),
        False,
        0,
    )
    assert (row["organisers"], row["causes"], row["sdgs"], row["objectives"], row["activity_goal"]) == ([], [], [], [], None)


DOCUMENT = {
    "activities_statistics": {
        "total_activities": {"values": [["Physical", 7], ["Online", 2]]},
        "total_participants": {"values": [["Local", 10], ["International", 5]]},
        "total_causes": {"values": [["Culture", 9], ["Culture", 8], ["Sport", 1], ["Short"]]},
        "physical_causes": {"values": [["Culture", 7]]},
        "online_causes": {"values": [["Culture", 1], ["Extra", 3]]},
        "physical_types": {"values": [["Trip", 4]]},
    }
}
HEAD = '<html><script type="application/json" data-drupal-selector="drupal-settings-json">'


def parsed(spark, *html):
    return pages(spark, *html).select(F.col("page_id").alias("section_id"), page_statistics(F.col("html")).alias("stats"))


def test_statistics(spark):
    frame = parsed(spark, f"{HEAD}{json.dumps(DOCUMENT)}</script></html>", "<html></html>", HEAD + "{bad</script>", HEAD + "{}</script>")
    overall = statistics.overall_statistics(frame)
    assert rows(overall) == [(0, 7, 2, 10, 5, 0, True), *((i, 0, 0, 0, 0, 0, False) for i in (1, 2, 3))]
    assert rows(statistics.category_statistics(frame, "section_id", "causes")) == [
        (0, "Culture", 8, 7, 1),
        (0, "Extra", 0, 0, 3),
        (0, "Sport", 1, 0, 0),
    ]
    assert rows(statistics.category_statistics(frame, "section_id", "types")) == [(0, "Trip", 4, 0)]
    # The overall participant list is also the total list of the category.
    assert rows(statistics.category_statistics(frame, "section_id", "participants")) == [
        (0, "International", 0, 0),
        (0, "Local", 0, 0),
    ]
    assembled = statistics.assembled_statistics(frame, "section_id").orderBy("section_id").collect()
    assert [r["is_complete"] for r in assembled] == [True, False, False, False]
    assert [x["name"] for x in assembled[0]["causes"]] == ["Culture", "Extra", "Sport"]


def test_statistics_attributes_in_any_order(spark):
    head = HEAD.replace('type="application/json" ', "").replace("json\">", 'json" type="application/json">')
    assert "stats" in parsed(spark, f"{head}{json.dumps(DOCUMENT)}</script>").columns
    assert parsed(spark, f"{head}{json.dumps(DOCUMENT)}</script>").first()["stats"] is not None


def test_zero_fill(spark):
    frame = statistics.overall_statistics(parsed(spark, f"{HEAD}{json.dumps(DOCUMENT)}</script>"))
    sections = spark.createDataFrame([(0,), (1,)], "section_id bigint")
    assert rows(statistics.zero_filled(sections, frame, "section_id")) == [
        (0, 7, 2, 10, 5, 0, True),
        (1, 0, 0, 0, 0, 0, False),
    ]


@pytest.mark.parametrize(
    ("inner", "goal"),
    [("Intro<ul><li> </li><li></li></ul>", None), ("Intro<ul><li>a</li><li> </li></ul>", "a"), ("Intro", "Intro"), (" ", None)],
)
def test_a_goal_with_a_list_is_its_items(spark, inner, goal):
    """Also if all items are blank; a goal without a list is its own text."""
    html = f'<html><div class="activity__field-ct-act-goal-activity"><div class="field__item">{inner}</div></div></html>'
    pages = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    found = extraction.extract_activities(pages, SITE, F.lit("2023-11-08").cast("timestamp_ntz"))
    assert found.first()["activity_goal"] == goal


def test_unclosed_tags_take_linear_time():
    import time

    from orgmetrics.sources.html import _Matcher

    matcher = _Matcher({"x": "div.a b", "y": "p i"})
    started = time.perf_counter()
    found, kept = matcher.nodes("<html><div class=a>" + "<p>text" * 100_000 + "<b>end</b></i>")
    assert time.perf_counter() - started < 5
    assert [kept[n["first_text"] : n["end_text"]] for n in found] == [["end"]]


def test_unclosed_matched_elements_take_linear_time():
    import time

    from orgmetrics.sources.html import _Matcher

    matcher = _Matcher({"x": 'a[href*="/section/"]'})
    started = time.perf_counter()
    found, kept = matcher.nodes('<html>' + '<a href="/section/x">name' * 100_000)
    assert time.perf_counter() - started < 5
    assert len(found) == len(kept) == 100_000
    assert [(n["first_text"], n["end_text"]) for n in found[:2]] == [(0, 100_000), (1, 100_000)]


def test_scopes_of_nested_elements():
    from orgmetrics.sources.html import _Matcher

    matcher = _Matcher({"x": "div.a p b", "y": "div div i"})
    found, kept = matcher.nodes("<div class=a><b>1</b><p><b>2</b><u><b>3</b></u></p><b>4</b></div><p><b>5</b></p><div><i>6</i><div><i>7</i></div><i>8</i></div>")
    assert [(n["sel"], kept[n["first_text"] : n["end_text"]]) for n in found] == [("x", ["2"]), ("x", ["3"]), ("y", ["7"])]
