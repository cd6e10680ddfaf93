"""Event dates and timestamps. No function reads a clock: callers pass ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgmetrics.functions.text import strip

# Accepted date shapes, day before month, in order of preference. The shape is
# tested first so that a text is handed to one date parser only.
_DATE_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$", "yyyy-M-d'T'H:m:s'Z'"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"(?i)^\d{1,2}\s+[a-z]{3}\s+\d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"(?i)^[a-z]+\s+\d{1,2},\s+\d{4}$", "MMMM d, yyyy"),
)


_RANGE_ERRORS = (
    "not a date range",
    "unreadable start date",
    "unreadable end date",
    "end before start",
)


def parse_event_date(c: Column) -> Column:
    """First matching shape as a date; unreadable or impossible dates give NULL."""
    text = strip(c)
    named_month = F.initcap(F.lower(F.regexp_replace(text, r"\s+", " ")))
    parsed = F.lit(None).cast("date")
    for shape, pattern in reversed(_DATE_SHAPES):
        source = named_month if "MMM" in pattern else text
        day = F.try_to_timestamp(source, F.lit(pattern)).cast("date")
        parsed = F.when(text.rlike(shape), day).otherwise(parsed)
    return parsed


def parse_event_date_strict(c: Column) -> Column:
    """``struct(value, error)``: the date of a text, or why there is none; NULL and blank are missing."""
    day = parse_event_date(c)
    error = F.when(F.coalesce(strip(c), F.lit("")) == "", "missing").when(day.isNull(), "not a date")
    return F.struct(day.alias("value"), error.alias("error"))


def parse_date_range(c: Column) -> Column:
    """``a - b`` as ``struct(start_date, end_date, error)``; the end is optional.

    A dash between blanks divides the two; otherwise a lone dash does.
    """
    text = strip(c)
    spaced = F.split(text, r"\s+-\s+")
    tight = F.split(text, "-")
    parts = F.when(F.size(spaced) > 1, spaced).when(F.size(tight) == 2, tight)
    parts = F.coalesce(parts, F.array(text))
    start = parse_event_date(F.try_element_at(parts, F.lit(1)))
    end = parse_event_date(F.try_element_at(parts, F.lit(2)))
    # All rules are evaluated side by side, so that each date is read once and then reused.
    broken = F.array(
        F.size(parts) > 2,
        start.isNull(),
        (F.size(parts) == 2) & end.isNull(),
        F.coalesce(end < start, F.lit(False)),
    )
    first = F.array_position(broken, F.lit(True)).cast("int")
    error = F.try_element_at(F.array(*map(F.lit, _RANGE_ERRORS)), F.nullif(first, F.lit(0)))
    return F.struct(
        F.when(first == 0, start).alias("start_date"),
        F.when(first == 0, end).alias("end_date"),
        error.alias("error"),
    )


def is_future_event(day: Column, as_of: Column) -> Column:
    """The stored flag: strictly after ``as_of``."""
    return day > as_of


def is_upcoming(day: Column, as_of: Column) -> Column:
    """On or after ``as_of``."""
    return day >= as_of


def format_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def parse_timestamp(c: Column) -> Column:
    """ISO timestamp as UTC wall time (TIMESTAMP_NTZ); without an offset it is UTC already."""
    text = strip(c)
    zone = r"(?:[Zz]|([+-])(\d{2}):?(\d{2}))$"
    wall = F.regexp_replace(text, r"(?<=:\d{2}(?:\.\d{1,9})?)\s*(?:[Zz]|[+-]\d{2}:?\d{2})$", "")
    has_zone = wall != text
    sign = F.when(F.regexp_extract(text, zone, 1) == "-", -1).otherwise(1)
    hours = F.coalesce(F.regexp_extract(text, zone, 2).try_cast("int"), F.lit(0))
    minutes = F.coalesce(F.regexp_extract(text, zone, 3).try_cast("int"), F.lit(0))
    offset = F.make_dt_interval(
        F.lit(0),
        F.when(has_zone, sign * hours).otherwise(0),
        F.when(has_zone, sign * minutes).otherwise(0),
    )
    return wall.try_cast("timestamp_ntz") - offset
