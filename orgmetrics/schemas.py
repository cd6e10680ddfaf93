"""The seventeen stored tables as Spark schemas, with their keys. Counters are 64 bits wide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string


def _schema(ddl: str) -> T.StructType:
    # The DDL parser needs a running session, so tables build their schema on demand.
    return _parse_datatype_string(ddl)


@dataclass(frozen=True)
class Table:
    """One stored table: column DDL, unique key, and the columns an upsert overwrites."""

    name: str
    ddl: str
    key: tuple[str, ...]
    update: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()  # stamps by whose day a log is kept
    not_null: tuple[str, ...] = ()
    longest: tuple[tuple[str, int], ...] = ()  # column, characters
    checks: tuple[tuple[str, str], ...] = ()  # name, condition that a row must meet or leave NULL
    unique: tuple[tuple[str, ...], ...] = ()  # besides the key; NULLs never clash
    references: tuple[tuple[str, str, str], ...] = ()  # column, table, its column
    generated: tuple[str, ...] = ()  # columns that a new row does not give
    defaults: tuple[tuple[str, str], ...] = ()  # column, expression where a new row has NULL

    @property
    def schema(self) -> T.StructType:
        return _schema(self.ddl)


_STAMPS = "created_at timestamp_ntz, updated_at timestamp_ntz"

COUNTRIES = Table(
    "countries",
    "country_code string, name string, slug string, url string, section_count int, " + _STAMPS,
    key=("country_code",),
    update=("name", "slug", "url", "section_count"),
    # Fixed values from here on: the rules of the stored tables.
    not_null=("name", "slug", "url"),
    longest=(("country_code", 10), ("name", 100), ("slug", 100), ("url", 255)),
    unique=(("slug",),),
    generated=("created_at", "updated_at"),
    defaults=(("section_count", "0"),),
)

SECTIONS = Table(
    "sections",
    "id bigint, country_code string, accounts_platform_slug string, "
    "activities_platform_slug string, name string, accounts_url string, "
    "activities_url string, logo_url string, city string, address string, "
    "latitude decimal(9,6), longitude decimal(9,6), email string, website string, "
    "social_media map<string,string>, university_name string, "
    "can_scrape_activities boolean, last_validated_activities_slug timestamp_ntz, "
    "last_scraped timestamp_ntz, " + _STAMPS,
    key=("accounts_platform_slug",),
    update=(
        "country_code",
        "activities_platform_slug",
        "name",
        "accounts_url",
        "activities_url",
        "logo_url",
        "city",
        "address",
        "latitude",
        "longitude",
        "email",
        "website",
        "social_media",
        "university_name",
        "can_scrape_activities",
        "last_validated_activities_slug",
    ),
    not_null=("accounts_platform_slug", "name"),
    longest=(
        ("country_code", 10),
        ("accounts_platform_slug", 255),
        ("activities_platform_slug", 255),
        ("name", 255),
        ("accounts_url", 255),
        ("activities_url", 255),
        ("logo_url", 255),
        ("city", 100),
        ("email", 255),
        ("website", 255),
        ("university_name", 255),
    ),
    unique=(("id",),),
    references=(("country_code", "countries", "country_code"),),
    generated=("id", "last_scraped", "created_at", "updated_at"),
)

ACTIVITIES = Table(
    "activities",
    "id bigint, event_slug string, url string, title string, description string, "
    "start_date date, end_date date, is_future_event boolean, city string, "
    "country_code string, participants int, activity_type string, activity_goal string, "
    "is_valid boolean, " + _STAMPS,
    key=("event_slug",),
    update=(
        "url",
        "title",
        "description",
        "start_date",
        "end_date",
        "is_future_event",
        "city",
        "country_code",
        "participants",
        "activity_type",
        "activity_goal",
        "is_valid",
    ),
    not_null=("event_slug", "url", "title", "description", "start_date", "is_future_event"),
    longest=(
        ("event_slug", 255),
        ("url", 255),
        ("title", 255),
        ("city", 100),
        ("country_code", 10),
        ("activity_type", 100),
    ),
    checks=(("participants >= 0", "participants >= 0"),),
    unique=(("id",),),
    references=(("country_code", "countries", "country_code"),),
    generated=("id", "created_at", "updated_at"),
    defaults=(("is_valid", "true"),),
)

CAUSES = Table("activity_causes", "id bigint, name string, created_at timestamp_ntz", key=("name",),
    not_null=("name",),
    longest=(("name", 100),),
    unique=(("id",),),
    generated=("id", "created_at"),
)
OBJECTIVES = Table("objectives", "id bigint, name string, created_at timestamp_ntz", key=("name",),
    not_null=("name",),
    longest=(("name", 200),),
    unique=(("id",),),
    generated=("id", "created_at"),
)
SDGS = Table(
    "sdgs", "id bigint, name string, description string, created_at timestamp_ntz", key=("name",),
    not_null=("name",),
    longest=(("name", 100),),
    unique=(("id",),),
    generated=("id", "created_at"),
)

ORGANISERS = Table(
    "activity_section_organisers",
    "activity_id bigint, section_id bigint",
    key=("activity_id", "section_id"),
    references=(("activity_id", "activities", "id"), ("section_id", "sections", "id")),
)
ACTIVITY_CAUSES = Table(
    "activity_to_cause", "activity_id bigint, cause_id bigint", key=("activity_id", "cause_id"),
    references=(("activity_id", "activities", "id"), ("cause_id", "activity_causes", "id")),
)
ACTIVITY_SDGS = Table(
    "activity_to_sdg", "activity_id bigint, sdg_id bigint", key=("activity_id", "sdg_id"),
    references=(("activity_id", "activities", "id"), ("sdg_id", "sdgs", "id")),
)
ACTIVITY_OBJECTIVES = Table(
    "activity_to_objective",
    "activity_id bigint, objective_id bigint",
    key=("activity_id", "objective_id"),
    references=(("activity_id", "activities", "id"), ("objective_id", "objectives", "id")),
)

OVERALL_STATISTICS = Table(
    "section_overall_statistics",
    "id bigint, section_id bigint, physical_activities bigint, online_activities bigint, "
    "total_local_students bigint, total_international_students bigint, total_coordinators bigint, "
    "scraped_at timestamp_ntz",
    key=("section_id",),
    update=(
        "physical_activities",
        "online_activities",
        "total_local_students",
        "total_international_students",
        "total_coordinators",
        "scraped_at",
    ),
    unique=(("id",),),
    references=(("section_id", "sections", "id"),),
    generated=("id",),
    defaults=(
        ("physical_activities", "0"),
        ("online_activities", "0"),
        ("total_local_students", "0"),
        ("total_international_students", "0"),
        ("total_coordinators", "0"),
    ),
)
CAUSE_STATISTICS = Table(
    "section_cause_statistics",
    "id bigint, section_id bigint, cause_name string, total_count bigint, physical_count bigint, "
    "online_count bigint, scraped_at timestamp_ntz",
    key=("section_id", "cause_name"),
    update=("total_count", "physical_count", "online_count", "scraped_at"),
    not_null=("cause_name",),
    longest=(("cause_name", 100),),
    unique=(("id",),),
    references=(("section_id", "sections", "id"),),
    generated=("id",),
    defaults=(
        ("total_count", "0"),
        ("physical_count", "0"),
        ("online_count", "0"),
    ),
)
TYPE_STATISTICS = Table(
    "section_type_statistics",
    "id bigint, section_id bigint, activity_type string, physical_count bigint, "
    "online_count bigint, scraped_at timestamp_ntz",
    key=("section_id", "activity_type"),
    update=("physical_count", "online_count", "scraped_at"),
    not_null=("activity_type",),
    longest=(("activity_type", 100),),
    unique=(("id",),),
    references=(("section_id", "sections", "id"),),
    generated=("id",),
    defaults=(
        ("physical_count", "0"),
        ("online_count", "0"),
    ),
)
PARTICIPANT_STATISTICS = Table(
    "section_participant_statistics",
    "id bigint, section_id bigint, participant_type string, physical_count bigint, "
    "online_count bigint, scraped_at timestamp_ntz",
    key=("section_id", "participant_type"),
    update=("physical_count", "online_count", "scraped_at"),
    not_null=("participant_type",),
    longest=(("participant_type", 100),),
    unique=(("id",),),
    references=(("section_id", "sections", "id"),),
    generated=("id",),
    defaults=(
        ("physical_count", "0"),
        ("online_count", "0"),
    ),
)

SCRAPER_STATUS = Table(
    "scraper_status",
    "id bigint, scraper_module string, status string, started_at timestamp_ntz, "
    "completed_at timestamp_ntz, sections_processed bigint, sections_failed bigint, "
    "error_message string, metadata string",
    key=("id",),
    partition_by=("completed_at",),
    not_null=("scraper_module", "status", "started_at"),
    longest=(("scraper_module", 50), ("status", 20)),
    generated=("id",),
    defaults=(("sections_processed", "0"), ("sections_failed", "0")),
)
VALIDATION_ERRORS = Table(
    "validation_errors",
    "id bigint, section_id bigint, activity_event_slug string, field_name string, "
    "error_message string, raw_data string, scraper_module string, created_at timestamp_ntz",
    key=("id",),
    partition_by=("created_at",),
    not_null=("error_message",),
    longest=(("activity_event_slug", 255), ("field_name", 100), ("scraper_module", 50)),
    references=(("section_id", "sections", "id"),),
    generated=("id", "created_at"),
)
FAILED_SCRAPES = Table(
    "failed_scrapes",
    "id bigint, url string, section_id bigint, scraper_module string, http_status_code int, "
    "error_message string, retry_count int, last_attempt timestamp_ntz, will_retry boolean",
    key=("id",),
    partition_by=("last_attempt",),
    not_null=("url",),
    longest=(("url", 500), ("scraper_module", 50)),
    references=(("section_id", "sections", "id"),),
    generated=("id",),
    defaults=(("retry_count", "0"), ("will_retry", "true")),
)

TABLES = {
    t.name: t
    for t in (
        COUNTRIES,
        SECTIONS,
        ACTIVITIES,
        CAUSES,
        SDGS,
        OBJECTIVES,
        ORGANISERS,
        ACTIVITY_CAUSES,
        ACTIVITY_SDGS,
        ACTIVITY_OBJECTIVES,
        OVERALL_STATISTICS,
        CAUSE_STATISTICS,
        TYPE_STATISTICS,
        PARTICIPANT_STATISTICS,
        SCRAPER_STATUS,
        VALIDATION_ERRORS,
        FAILED_SCRAPES,
    )
}

# Landed input, written by whatever fetched the pages.
PAGE_DDL = "page_id bigint, url string, html string"
FETCH_LOG_DDL = "url string, status int, body string, error string, attempt int, ts timestamp_ntz"
