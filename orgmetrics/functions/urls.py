"""URL and e-mail rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgmetrics.functions.text import strip

CHUNK_SIZE = 5  # fixed value: listing pages per unit of work


def url_tail(href: Column, marker: str) -> Column:
    """Text after the last ``marker``, without slashes at its ends; NULL when it is absent."""
    tail = F.trim(F.substring_index(href, marker, -1), F.lit("/"))
    return F.when(href.contains(marker), tail)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` as found on page ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substring(page, F.length(root) + 1, F.length(page))
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    return (
        F.when(href.isNull() | (href == ""), base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, _without_dots(href)))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, href))))
    )


def _without_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` steps of a rooted path; query and fragment are left alone."""
    bare = F.regexp_extract(path, r"^([^?#]*)", 1)
    rest = F.substring(path, F.length(bare) + 1, F.length(path))
    steps = F.split(F.substring(bare, 2, F.length(bare)), "/")
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(step))),
    )
    # A path that ends in a dot step names a folder, so it keeps its closing slash.
    closing = F.when(bare.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    walked = F.concat(F.lit("/"), F.array_join(kept, "/"), closing)
    return F.when(bare.rlike(r"/\.{1,2}(/|$)"), F.concat(walked, rest)).otherwise(path)


def query_page_number(href: Column) -> Column:
    """Number after the last ``=``; anything else gives 0."""
    return F.coalesce(strip(F.substring_index(href, "=", -1)).try_cast("int"), F.lit(0))


def listing_url(base: str, slug: Column) -> Column:
    return F.concat(F.lit(f"{base}/organisation/"), slug, F.lit("/activities"))


def listing_page_url(base: str, slug: Column, page: Column) -> Column:
    return F.concat(listing_url(base, slug), F.lit("?page="), page.cast("string"))


def statistics_url(base: str, slug: Column) -> Column:
    return F.concat(F.lit(f"{base}/organisation/"), slug, F.lit("/statistics"))


def http_url_valid(c: Column) -> Column:
    rule = c.rlike(r"(?i)^https?://[^\s/?#]+([/?#].*)?$") & (F.length(c) <= 2083)
    return F.coalesce(rule, F.lit(False))


def email_valid(c: Column) -> Column:
    local = r"[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]++"
    label = r"[\p{L}\p{N}]([\p{L}\p{N}-]*[\p{L}\p{N}])?"
    rule = c.rlike(rf"^{local}(\.{local})*+@{label}(\.{label})+$")
    # The length first: the pattern recurses over its groups.
    return F.coalesce(F.when(F.length(c) <= 254, rule), F.lit(False))


def url_host(c: Column) -> Column:
    return F.try_parse_url(c, F.lit("HOST"))
