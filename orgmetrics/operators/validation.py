"""Row validation: rows in, the same rows with ``is_valid`` and their errors out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.functions import geo, slugs, text, urls

MAX_PARTICIPANTS = 10000  # fixed value

Checks = list[tuple[str, list[tuple[Column, str]]]]


@dataclass(frozen=True)
class Ruleset:
    """Clean-up expressions by column, then the checks by field on the cleaned row.

    A field reports its first failing check only; different fields report independently.
    """

    clean: dict[str, Column]
    checks: Checks


def validate(df: DataFrame, rules: Ruleset) -> DataFrame:
    """Cleaned rows plus ``errors`` (array of field_name, error_message) and ``is_valid``."""
    clean = {c: e for c, e in rules.clean.items() if c in df.columns}
    cleaned = df.select(*(clean[c].alias(c) if c in clean else F.col(c) for c in df.columns))
    fields = [_first_error(f, checks) for f, checks in rules.checks if f in df.columns]
    with_errors = cleaned.withColumn("errors", F.concat(*fields))
    return with_errors.withColumn("is_valid", F.size("errors") == 0)


def with_parse_errors(validated: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """``validated`` with the errors of strictly parsed columns added, and ``is_valid`` to match.

    ``parsed`` maps fields to ``struct(value, error)``; a field's parse error takes the place of its
    other errors, since those looked at a value that could not be read.
    """
    errors = F.filter(
        F.array(
            *(
                F.struct(F.lit(f).alias("field_name"), p["error"].alias("error_message"))
                for f, p in parsed.items()
            )
        ),
        lambda e: e["error_message"].isNotNull(),
    )
    names = F.transform(errors, lambda e: e["field_name"])
    others = F.filter("errors", lambda e: ~F.array_contains(names, e["field_name"]))
    merged = validated.withColumn("errors", F.concat(others, errors))
    return merged.withColumn("is_valid", F.size("errors") == 0)


def _first_error(field: str, checks: list[tuple[Column, str]]) -> Column:
    """Array with the first failing check of a field, empty when all hold (NULL holds)."""
    found = F.array().cast("array<struct<field_name:string,error_message:string>>")
    for bad, message in reversed(checks):
        error = F.struct(F.lit(field).alias("field_name"), F.lit(message).alias("error_message"))
        found = F.when(bad, F.array(error)).otherwise(found)
    return found


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the error column, invalid rows with it)."""
    return (
        validated.filter("is_valid").drop("errors"),
        validated.filter(~F.col("is_valid")),
    )


def error_rows(
    validated: DataFrame,
    module: str,
    as_of: Column,
    section_id: Column | None = None,
    event_slug: Column | None = None,
) -> DataFrame:
    """Error-log rows, one per failing field, with the offending row as JSON."""
    data = [c for c in validated.columns if c not in ("errors", "is_valid")]
    none = F.lit(None)
    return exploded_errors(
        validated,
        (none if section_id is None else section_id).cast("bigint").alias("section_id"),
        (none if event_slug is None else event_slug).cast("string").alias("activity_event_slug"),
        F.to_json(F.struct(*data)).alias("raw_data"),
        F.lit(module).alias("scraper_module"),
        as_of.cast("timestamp_ntz").alias("created_at"),
    )


def exploded_errors(validated: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns with field_name and error_message, one row per failing field.

    The outer form, filtered afterwards: a plain ``inline`` makes the optimizer add a filter on
    the size of ``errors`` below it, which evaluates every rule a second time.
    """
    rows = validated.select(*columns, F.inline_outer("errors"))
    return rows.filter(F.col("field_name").isNotNull())


def validation_summary(validated: DataFrame) -> DataFrame:
    """One row: how many of how many rows are valid."""
    return validated.agg(
        F.count_if("is_valid").alias("n_valid"), F.count("*").alias("n_rows")
    )


def revalidate(flagged: DataFrame, rules: Ruleset) -> DataFrame:
    """Check rows once more that were flagged invalid; repaired rows lose the flag."""
    again = flagged.filter(~F.col("is_valid")).drop("is_valid")
    return validate(again, rules)


def error_changes(before: DataFrame, validated: DataFrame, key: str) -> DataFrame:
    """What a second check changed: ``key, field_name, error_message, change``.

    ``before`` holds the errors known so far (key, field_name, error_message; repeats count once),
    ``validated`` the rows checked now. ``change`` is cleared, kept or new. Errors of keys that were
    not checked now are left out; a NULL key matches no other.
    """
    names = [key, "field_name", "error_message"]
    old = before.join(validated.select(key), key, "left_semi").select(*names)
    now = exploded_errors(validated, key).select(*names)
    both = old.withColumn("_side", F.lit(1)).unionByName(now.withColumn("_side", F.lit(2)))
    # Grouped rather than joined: one shuffle, and NULL messages find each other. Sides as bits, so
    # that repeats need no distinct of their own.
    sides = both.groupBy(*names).agg(F.bit_or("_side").alias("_sides"))
    change = F.element_at(F.array(F.lit("cleared"), F.lit("new"), F.lit("kept")), F.col("_sides").cast("int"))
    return sides.select(*names, change.alias("change"))


def _length(c: Column, low: int, high: int) -> list[tuple[Column, str]]:
    checks = [(F.length(c) > high, f"longer than {high}")]
    if low:
        checks.insert(0, (c.isNull(), "missing"))
        checks.insert(1, (F.length(c) < low, f"shorter than {low}"))
    return checks


_SLUG_MESSAGE = "only letters, digits, hyphens and underscores are allowed"


def _slug(c: Column) -> list[tuple[Column, str]]:
    return [((c != "") & ~slugs.lenient_slug_valid(c), _SLUG_MESSAGE)]


def _url(c: Column, required: bool = False) -> list[tuple[Column, str]]:
    checks = [(c.isNotNull() & ~urls.http_url_valid(c), "not an http url")]
    return [(c.isNull(), "missing"), *checks] if required else checks


def _negative(c: Column) -> tuple[Column, str]:
    return (c < 0, "negative")


def country_rules() -> Ruleset:
    c = F.col
    return Ruleset(
        clean={
            "country_code": text.normalize_country_code(c("country_code")),
            "name": text.normalize_text(c("name")),
            "slug": slugs.normalize_slug(c("slug")),
            "url": text.strip(c("url")),
        },
        checks=[
            (
                "country_code",
                [
                    *_length(c("country_code"), 2, 10),
                    (~text.country_code_valid(c("country_code"), 2), "not two letters"),
                ],
            ),
            ("name", _length(c("name"), 1, 100)),
            ("slug", [*_length(c("slug"), 1, 100), *_slug(c("slug"))]),
            ("url", _url(c("url"), required=True)),
            ("section_count", [_negative(c("section_count"))]),
        ],
    )


def section_rules() -> Ruleset:
    c = F.col
    slug = slugs.normalize_slug
    texts = ("city", "university_name", "email", "website", "accounts_url", "activities_url")
    # Coordinates may arrive as text: what does not fit decimal(9,6) is an error, not a NULL.
    unreadable = {
        f: c(f).isNotNull() & c(f).try_cast("decimal(9,6)").isNull()
        for f in ("latitude", "longitude")
    }
    lat, lng = (c(f).try_cast("double") for f in ("latitude", "longitude"))
    social = F.exists(F.map_entries("social_media"), lambda e: e["value"].isNull())
    return Ruleset(
        clean={
            "country_code": text.normalize_country_code(c("country_code")),
            "name": text.normalize_text(c("name")),
            "accounts_platform_slug": slug(c("accounts_platform_slug")),
            "activities_platform_slug": slug(c("activities_platform_slug")),
            **{f: text.strip(c(f)) for f in texts},
        },
        checks=[
            ("country_code", _length(c("country_code"), 1, 10)),
            ("name", _length(c("name"), 1, 255)),
            (
                "accounts_platform_slug",
                [*_length(c("accounts_platform_slug"), 1, 255), *_slug(c("accounts_platform_slug"))],
            ),
            (
                "activities_platform_slug",
                [
                    *_length(c("activities_platform_slug"), 0, 255),
                    *_slug(c("activities_platform_slug")),
                ],
            ),
            ("accounts_url", _url(c("accounts_url"))),
            ("activities_url", _url(c("activities_url"))),
            ("city", _length(c("city"), 0, 100)),
            ("university_name", _length(c("university_name"), 0, 255)),
            (
                "email",
                [(c("email").isNotNull() & ~urls.email_valid(c("email")), "not an e-mail address")],
            ),
            ("website", _url(c("website"))),
            (
                "latitude",
                [
                    (unreadable["latitude"], "not a number of nine digits"),
                    (~geo.latitude_valid(lat), "not between -90 and 90"),
                ],
            ),
            (
                "longitude",
                [
                    (unreadable["longitude"], "not a number of nine digits"),
                    (~geo.longitude_valid(lng), "not between -180 and 180"),
                ],
            ),
            ("social_media", [(social, "values must be texts")]),
        ],
    )


def activity_rules(known_types: list[str] | None = None) -> Ruleset:
    """``known_types`` adds the rule that the type is one of a given vocabulary."""
    c = F.col
    kind = _length(c("activity_type"), 0, 100)
    if known_types is not None:
        kind.append(
            (c("activity_type").isNotNull() & ~c("activity_type").isin(known_types), "unknown type")
        )
    bad_goal = F.exists("sdgs", lambda n: n.isNull() | ~n.between(1, 17))
    return Ruleset(
        clean={
            "event_slug": slugs.normalize_slug(c("event_slug")),
            "url": text.strip(c("url")),
            # Length rules look at the stripped title, so its inner blanks collapse afterwards.
            "title": text.strip(c("title")),
            "description": text.normalize_text(c("description")),
            "city": text.strip(c("city")),
            "country_code": text.normalize_country_code(c("country_code")),
            "activity_type": text.strip(c("activity_type")),
            "organisers": text.clean_list(c("organisers")),
            "causes": text.clean_list(c("causes")),
            "objectives": text.clean_list(c("objectives")),
            "sdgs": F.coalesce(text.sdg_list(c("sdgs")), F.array().cast("array<int>")),
        },
        checks=[
            ("event_slug", [*_length(c("event_slug"), 1, 255), *_slug(c("event_slug"))]),
            ("url", _url(c("url"), required=True)),
            ("title", _length(c("title"), 1, 255)),
            (
                "description",
                [(c("description").isNull(), "missing"), (F.length("description") < 10, "shorter than 10")],
            ),
            ("start_date", [(c("start_date").isNull(), "missing")]),
            ("end_date", [(c("end_date") < c("start_date"), "before start date")]),
            ("city", _length(c("city"), 0, 100)),
            (
                "country_code",
                [((c("country_code") != "") & ~text.country_code_valid(c("country_code")), "not 2-3 letters")],
            ),
            (
                "participants",
                [
                    _negative(c("participants")),
                    (c("participants") > MAX_PARTICIPANTS, f"over {MAX_PARTICIPANTS}"),
                ],
            ),
            ("activity_type", kind),
            ("sdgs", [(bad_goal, "not between 1 and 17")]),
        ],
    )


def validate_activities(
    df: DataFrame, as_of: Column, known_types: list[str] | None = None, drop_invalid: bool = False
) -> DataFrame:
    """Activity rules; the future flag is always computed, never taken from the input."""
    checked = validate(df, activity_rules(known_types))
    checked = checked.withColumn("title", text.normalize_text(F.col("title")))
    checked = checked.withColumn("is_future_event", F.col("start_date") > as_of.cast("date"))
    return checked.filter("is_valid") if drop_invalid else checked


def count_rules(columns: list[str], lists: list[str] | None = None) -> Ruleset:
    """Statistics: counts at least 0, lists not empty."""
    checks: Checks = [(f, [_negative(F.col(f))]) for f in columns]
    for f in lists or []:
        checks.append((f, [(F.coalesce(F.size(f) <= 0, F.lit(True)), "empty")]))
    return Ruleset(clean={}, checks=checks)


def lookup_rules(longest: int) -> Ruleset:
    """Lookup names: causes and goals up to 100 characters, objectives up to 200."""
    return Ruleset(clean={}, checks=[("name", _length(F.col("name"), 1, longest))])
