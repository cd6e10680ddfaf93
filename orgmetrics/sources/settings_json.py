"""The settings block of a statistics page: a JSON document inside a script element."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The script element's marker and the member that holds the statistics.
_SCRIPT = (
    r'(?s)<script(?=[^>]*type="application/json")'
    r'(?=[^>]*data-drupal-selector="drupal-settings-json")[^>]*>(.*?)</script>'
)
_MEMBER = "activities_statistics"

STATISTICS_TYPE = "map<string,struct<values:array<array<string>>>>"


def settings_text(html: Column) -> Column:
    """JSON text of the settings block; NULL when the page has none."""
    return F.nullif(F.regexp_extract(html, _SCRIPT, 1), F.lit(""))


def statistics_member(settings: Column) -> Column:
    """Statistics by key, e.g. ``total_causes`` -> ``[[name, count], ...]``; bad JSON gives NULL."""
    return F.from_json(settings, f"struct<{_MEMBER}:{STATISTICS_TYPE}>")[_MEMBER]


def page_statistics(html: Column) -> Column:
    return statistics_member(settings_text(html))
