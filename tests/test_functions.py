from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orgmetrics.functions import dates, fetch, geo, slugs, text, urls


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def of(spark, function, *args):
    """The function's value for literal arguments (strings, None, lists)."""
    ddl = ", ".join(
        f"a{i} {'array<string>' if isinstance(a, list) else 'string'}" for i, a in enumerate(args)
    )
    frame = spark.createDataFrame([tuple(args)], ddl)
    return frame.select(function(*(F.col(f"a{i}") for i in range(len(args)))).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("name", "slug"),
    [
        ("Net Metu", "net-metu"),
        ("NET Yıldız", "net-yildiz"),
        ("İstanbul", "net-istanbul"),
        ("networks", "networks"),
        ("Metu", "net-metu"),
        ("Łódź & Kraków!", "net-lodz-krakow"),
        ("Groß-Straße", "net-gross-strasse"),
        ("Москва", "net-moskva"),
        ("Αθήνα", "net-athena"),
        ("  spaced   name ", "net-spaced-name"),
        ("1,000 things", "net-1000-things"),
        ("O'Neil", "net-o-neil"),
        ("", "net"),
    ],
)
def test_activities_slug(spark, name, slug):
    assert of(spark, lambda c: slugs.activities_slug(c, "net"), name) == slug


@pytest.mark.parametrize(
    ("name", "code", "slug"),
    [
        ("Net Ankara Metu", "TR", "tr-anka-met"),
        ("Net Metu", "TR", "tr-metu"),
        ("Metu", "TR", "tr-metu"),
        ("Ankara Üniversite Two", "TR", "tr-anka-uni"),
    ],
)
def test_accounts_slug(spark, name, code, slug):
    assert of(spark, lambda n, k: slugs.accounts_slug(n, k, "net"), name, code) == slug


@pytest.mark.parametrize(
    ("slug", "valid"),
    [("net-a", True), ("net-", False), ("net", False), ("Net-a", False), ("net-é", False), ("", False), (None, False)],
)
def test_activities_slug_valid(spark, slug, valid):
    assert of(spark, lambda c: slugs.activities_slug_valid(c, "net"), slug) is valid


@pytest.mark.parametrize(
    ("slug", "code", "valid"),
    [
        ("tr-anka-met", "TR", True),
        ("tr-anka-met", "DE", False),
        ("tr-anka-met", "", True),
        ("tr-metu", "TR", False),
        ("tr_anka-met-x", "TR", False),
        ("", None, False),
    ],
)
def test_accounts_slug_valid(spark, slug, code, valid):
    assert of(spark, slugs.accounts_slug_valid, slug, code) is valid


@pytest.mark.parametrize(
    ("slug", "valid"),
    [("a-b_c", True), ("Ünï-1", True), ("½", True), ("---", False), ("", False), ("a b", False), ("a.b", False)],
)
def test_lenient_slug(spark, slug, valid):
    assert of(spark, slugs.lenient_slug_valid, slug) is valid


def test_normalize_text(spark):
    assert of(spark, text.normalize_text, "  a \t b　\n c\x1f ") == "a b c"
    assert of(spark, text.normalize_text, " \n ") == ""
    assert of(spark, text.normalize_text, None) is None


def test_country_codes(spark):
    assert of(spark, text.normalize_country_code, " tr\n") == "TR"
    for code, any_length, two in (("TR", True, True), ("abc", True, False), ("a", False, False), ("t1", False, False), (None, False, False)):
        assert of(spark, text.country_code_valid, code) is any_length
        assert of(spark, lambda c: text.country_code_valid(c, 2), code) is two


@pytest.mark.parametrize(("shown", "n"), [("1.234 people", 1234), ("none", 0), ("", 0), (None, 0), ("99999999999", 2147483647), ("١٢ people", 12)])
def test_digits(spark, shown, n):
    assert of(spark, text.digits_to_int, shown) == n


def test_lists(spark):
    assert of(spark, text.clean_list, [" a ", "b", "", "a", None, " "]) == ["a", "b"]
    no_list = F.lit(None).cast("array<string>")
    assert value(spark, text.clean_list(no_list)) == []
    assert value(spark, text.sdg_list_valid(no_list)) is True
    assert of(spark, lambda c: text.join_nonempty(c, ", "), [" a", " ", "b "]) == "a, b"
    assert of(spark, text.sdg_numbers, ["SDG 13", "goal  4: x", "Goal 18", "SDG4", "Goal 4"]) == [4, 13]
    assert of(spark, text.sdg_list, ["3", "1", "3"]) == [3, 1]
    for goals, valid in ((["1", "17"], True), (["0"], False), (["18"], False), (["x"], False), ([], True)):
        assert of(spark, text.sdg_list_valid, goals) is valid


@pytest.mark.parametrize(
    ("title", "platform"),
    [("Facebook profile", "facebook"), ("Our X Profile", "our x"), ("profile", None), ("Site", None), (None, None)],
)
def test_social_platform(spark, title, platform):
    assert of(spark, text.social_platform, title) == platform


def test_map_json(spark):
    again = of(spark, lambda c: text.map_to_json(text.json_to_map(c)), '{"a":"b","n":1}')
    assert again == '{"a":"b","n":"1"}'


def test_masking(spark):
    assert of(spark, text.mask_emails, "to a.b@c.org, not @x or a@b") == "to [email], not @x or a@b"
    assert len(of(spark, text.mask_identity, "x")) == 64


@pytest.mark.parametrize(
    ("shown", "day"),
    [
        ("2023-11-08T10:00:00Z", dt.date(2023, 11, 8)),
        ("08/11/2023", dt.date(2023, 11, 8)),
        ("8/1/2023", dt.date(2023, 1, 8)),
        ("8 Nov 2023", dt.date(2023, 11, 8)),
        ("8 nov 2023", dt.date(2023, 11, 8)),
        ("08-11-2023", dt.date(2023, 11, 8)),
        ("2023-11-08", dt.date(2023, 11, 8)),
        ("November 8, 2023", dt.date(2023, 11, 8)),
        (" 2023-11-08 ", dt.date(2023, 11, 8)),
        ("29/02/2024", dt.date(2024, 2, 29)),
        ("31/02/2023", None),
        ("13/13/2023", None),
        ("8 Foo 2023", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_event_date(spark, shown, day):
    assert of(spark, dates.parse_event_date, shown) == day


@pytest.mark.parametrize(
    ("shown", "start", "end", "error"),
    [
        ("2023-11-08", dt.date(2023, 11, 8), None, None),
        ("2023-11-08 - 2023-11-10", dt.date(2023, 11, 8), dt.date(2023, 11, 10), None),
        ("8 Nov 2023-10 Nov 2023", dt.date(2023, 11, 8), dt.date(2023, 11, 10), None),
        ("8 Nov 2023", dt.date(2023, 11, 8), None, None),
        ("2023-11-10 - 2023-11-08", None, None, "end before start"),
        ("x - 2023-11-08", None, None, "unreadable start date"),
        ("2023-11-08 - x", None, None, "unreadable end date"),
        ("1/1/2023 - 2/1/2023 - 3/1/2023", None, None, "not a date range"),
        (None, None, None, "unreadable start date"),
    ],
)
def test_date_range(spark, shown, start, end, error):
    assert tuple(of(spark, dates.parse_date_range, shown)) == (start, end, error)


@pytest.mark.parametrize(
    ("shown", "wall"),
    [
        ("2023-11-08T15:30:00Z", dt.datetime(2023, 11, 8, 15, 30)),
        ("2023-11-08T15:30:00+03:00", dt.datetime(2023, 11, 8, 12, 30)),
        ("2023-11-08T15:30:00-0130", dt.datetime(2023, 11, 8, 17, 0)),
        ("2023-11-08T15:30:00.25", dt.datetime(2023, 11, 8, 15, 30, 0, 250000)),
        ("2023-11-08 15:30:00", dt.datetime(2023, 11, 8, 15, 30)),
        ("2023-11-08", dt.datetime(2023, 11, 8)),
        ("soon", None),
        (None, None),
    ],
)
def test_timestamp(spark, shown, wall):
    assert of(spark, dates.parse_timestamp, shown) == wall


def test_future_and_upcoming(spark):
    day = F.lit("2023-11-08").cast("date")
    assert value(spark, dates.is_future_event(day, day)) is False
    assert value(spark, dates.is_upcoming(day, day)) is True
    assert value(spark, dates.format_date(day)) == "2023-11-08"


@pytest.mark.parametrize(
    ("href", "full"),
    [
        ("/a/b", "https://x.org/a/b"),
        ("b", "https://x.org/p/b"),
        ("../b", "https://x.org/b"),
        ("../../b", "https://x.org/b"),
        ("./b/../c?q=../d", "https://x.org/p/c?q=../d"),
        ("..", "https://x.org/"),
        ("?page=1", "https://x.org/p/q?page=1"),
        ("#f", "https://x.org/p/q?z=1#f"),
        ("//y.org/a", "https://y.org/a"),
        ("http://z.org", "http://z.org"),
        ("mailto:a@b", "mailto:a@b"),
        ("", "https://x.org/p/q?z=1"),
        (None, "https://x.org/p/q?z=1"),
    ],
)
def test_resolve_url(spark, href, full):
    base = F.lit("https://x.org/p/q?z=1")
    assert of(spark, lambda c: urls.resolve_url(base, c), href) == full


def test_resolve_url_on_a_bare_host(spark):
    assert of(spark, lambda c: urls.resolve_url(F.lit("https://x.org"), c), "a") == "https://x.org/a"


@pytest.mark.parametrize(
    ("href", "tail"),
    [("/country/tr/", "tr"), ("/country/x/country/de", "de"), ("/other", None), ("/country/", "")],
)
def test_url_tail(spark, href, tail):
    assert of(spark, lambda c: urls.url_tail(c, "/country/"), href) == tail


@pytest.mark.parametrize(("href", "n"), [("?page=27", 27), ("?a=1&page=3", 3), ("?page=x", 0), ("/p", 0), (None, 0)])
def test_page_number(spark, href, n):
    assert of(spark, urls.query_page_number, href) == n


@pytest.mark.parametrize(
    ("url", "valid"),
    [("https://x.org", True), ("HTTP://x.org/a b", True), ("ftp://x", False), ("https://", False), ("x.org", False), (None, False)],
)
def test_http_url(spark, url, valid):
    assert of(spark, urls.http_url_valid, url) is valid


@pytest.mark.parametrize(
    ("mail", "valid"),
    [("a.b@c.org", True), ("a..b@c.org", False), ("a@b", False), ("a@-b.org", False), ("@b.org", False), (None, False)],
)
def test_email(spark, mail, valid):
    assert of(spark, urls.email_valid, mail) is valid


@pytest.mark.parametrize(
    ("lat", "lng", "pair"),
    [
        (" 50.6097531 ", "3.140041", (Decimal("50.609753"), Decimal("3.140041"))),
        ("50.6", None, (None, None)),
        ("north", "3.1", (None, None)),
        ("1234.5", "3.1", (None, None)),
    ],
)
def test_coordinates(spark, lat, lng, pair):
    assert tuple(of(spark, geo.coordinates, lat, lng)) == pair


def test_fetch_classes(spark):
    frame = spark.createDataFrame(
        [(200, "x"), (429, "x"), (403, "by CloudFlare"), (403, "x"), (404, "x"), (500, "x"), (None, None)],
        "status int, body string",
    )
    found = frame.select(
        fetch.classify_fetch(F.col("status"), F.col("body")), fetch.kept_body(F.col("status"), F.col("body"))
    )
    assert [tuple(r) for r in found.collect()] == [
        ("ok", "x"),
        ("rate_limit", None),
        ("blocked", None),
        ("other", "x"),
        ("not_found", ""),
        ("other", "x"),
        ("no_response", None),
    ]


def test_backoff(spark):
    assert [value(spark, fetch.backoff_seconds(F.lit(n))) for n in (0, 1, 2, 3)] == [1, 2, 4, 8]


def test_scalar_functions_need_no_python(spark):
    frame = spark.createDataFrame([("Net X", "1/1/2023")], "name string, day string")
    plan = frame.select(
        slugs.activities_slug(F.col("name"), "net"), dates.parse_event_date(F.col("day"))
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@pytest.mark.parametrize(
    ("name", "slug"),
    [
        ("NET თბილისი", "net-t-bilisi"), ("Net Երևան", "net-erewan"), ("NET Қазақстан", "net-kazakstan"),
        ("Net Ғылым үй", "net-gylym-ui"), ("net Batumi ბათუმი", "net-batumi-bat-umi"),
    ],
)
def test_slugs_of_other_scripts(spark, name, slug):
    assert of(spark, lambda c: slugs.activities_slug(c, "net"), name) == slug


def test_long_words_take_linear_time(spark):
    import time

    started = time.perf_counter()
    assert of(spark, text.mask_emails, "a" * 1_000_000) == "a" * 1_000_000
    assert of(spark, text.mask_emails, "x" * 100_000 + "@b.example y") == "[email] y"
    assert of(spark, text.mask_emails, "a.b@c.de, (d@e.fg)@h.ij k@l") == "[email], ([email])@h.ij k@l"
    assert of(spark, urls.email_valid, "a." * 500_000 + "b@c.de") is False
    assert of(spark, urls.email_valid, "a.b@c.de") is True
    assert time.perf_counter() - started < 10
