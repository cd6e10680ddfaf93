"""Run counters, quality gates, completeness checks and service levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.functions.fetch import classify_fetch, error_kind
from orgmetrics.operators.joins import lookup_join

# Thresholds of the gates, alerts and service levels.
MIN_COUNTRIES = 40
MIN_SECTIONS = 400
MIN_VALIDATED = 0.7
MAX_ACCOUNT_ERRORS = 0.1
MIN_ACTIVITIES = 5
MAX_ACTIVITY_ERRORS = 0.2
ALERT_SUCCESS = 0.8
MIN_COVERAGE = 0.95
MAX_VALIDATION_ERRORS = 0.02
MIN_HTTP_SUCCESS = 0.95


def _count(df: DataFrame, condition: Column | None = None) -> Column:
    """A count as a scalar subquery: combined without any join."""
    return df.agg((F.count("*") if condition is None else F.count_if(condition)).alias("n")).scalar()


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def accounts_run_summary(countries: DataFrame, sections: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: countries, sections, sections with a reachable activities page, and ``errors``, the
    rows that failed."""
    counted = sections.agg(
        F.count("*").alias("sections_processed"),
        F.count_if("can_scrape_activities").alias("sections_validated"),
    )
    return counted.withColumn("countries_processed", _count(countries)).withColumn(
        "errors", _count(errors)
    )


def activity_run_summary(
    sections: DataFrame, links: DataFrame, statistics: DataFrame, errors: DataFrame
) -> DataFrame:
    """One row: sections read, their parsed activities (one per section that lists them), parsed
    statistics documents, and ``errors``, the sections that failed."""
    return sections.agg(F.count("*").alias("sections_processed")).select(
        "sections_processed",
        _count(links).alias("activities_processed"),
        _count(statistics).alias("statistics_processed"),
        _count(errors).alias("errors"),
    )


def request_counters(log: DataFrame) -> DataFrame:
    """One row: requests made, successful, failed, and how many were retries."""
    ok = classify_fetch(F.col("status"), F.col("body")) == "ok"
    return log.agg(
        F.count("*").alias("requests_made"),
        F.count_if(ok).alias("requests_successful"),
        F.count_if(~ok).alias("requests_failed"),
        F.count_if(F.col("attempt") > 0).alias("retries_performed"),
    )


def run_duration(log: DataFrame, run: str, stamp: str = "ts") -> DataFrame:
    """Whole seconds from the first to the last entry of each run."""
    spans = log.groupBy(run).agg(F.min(stamp).alias("started_at"), F.max(stamp).alias("ended_at"))
    return spans.withColumn(
        "duration_seconds", F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    )


def sections_per_hour(log: DataFrame, section: str, stamp: str = "ts") -> DataFrame:
    """One row: distinct sections over the hours the log spans."""
    counted = log.agg(
        F.countDistinct(section).alias("sections_processed"),
        F.timestamp_diff("SECOND", F.min(stamp), F.max(stamp)).alias("seconds"),
    )
    rate = F.try_divide(F.col("sections_processed") * 3600.0, F.col("seconds"))
    return counted.withColumn("per_hour", rate)


def accounts_gate(summary: DataFrame) -> DataFrame:
    """Verdict on an accounts run: the first failing rule is the reason."""
    n, validated = F.col("sections_processed"), F.col("sections_validated")
    rate = F.try_divide(validated, n)
    reason = (
        F.when(F.col("countries_processed") < MIN_COUNTRIES, "too few countries")
        .when(n < MIN_SECTIONS, "too few sections")
        .when(rate < MIN_VALIDATED, "low validation rate")
        .when(F.col("errors") > n * MAX_ACCOUNT_ERRORS, "too many errors")
    )
    rated = summary.withColumn("validation_rate", F.coalesce(rate, F.lit(0.0)))
    return rated.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def activities_gate(summary: DataFrame) -> DataFrame:
    """Verdict on an activities run."""
    n = F.col("sections_processed")
    mean = F.try_divide(F.col("activities_processed"), n)
    reason = (
        F.when(n == 0, "no sections")
        .when(mean < MIN_ACTIVITIES, "too few activities")
        .when(F.col("errors") > n * MAX_ACTIVITY_ERRORS, "too many errors")
    )
    rated = summary.withColumn("average_activities", F.coalesce(mean, F.lit(0.0)))
    return rated.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def quality_score(inserted: Column, processed: Column) -> Column:
    """Inserted rows per hundred processed; 0 when nothing was processed."""
    return F.when(processed == 0, F.lit(0.0)).otherwise(inserted * 100.0 / processed)


def quality_checks(
    activities: DataFrame, errors: DataFrame, failed: DataFrame, as_of: Column
) -> DataFrame:
    """One row with the four standing checks."""
    joined_in = F.when(F.col("participants") > 0, F.col("participants"))
    recent = F.col("created_at") > as_of - F.make_dt_interval(F.lit(0), F.lit(1))
    return activities.agg(
        F.count_if(~F.col("is_valid")).alias("invalid_activities"),
        F.avg(joined_in).alias("mean_participants"),
    ).select(
        "invalid_activities",
        _count(errors, recent).alias("recent_errors"),
        _count(failed, F.col("will_retry")).alias("pending_retries"),
        "mean_participants",
    )


def sections_without_activities(sections: DataFrame, links: DataFrame) -> DataFrame:
    """Eligible sections that organise nothing."""
    eligible = sections.filter(F.col("can_scrape_activities"))
    busy = links.select(F.col("section_id").alias("id")).distinct()
    return eligible.join(busy, "id", "left_anti")


def activities_without_organisers(activities: DataFrame, links: DataFrame) -> DataFrame:
    owned = links.select(F.col("activity_id").alias("id")).distinct()
    return activities.join(owned, "id", "left_anti")


def missing_statistics(sections: DataFrame, statistics: DataFrame) -> DataFrame:
    """Eligible sections without a statistics row."""
    eligible = sections.filter(F.col("can_scrape_activities"))
    have = statistics.select(F.col("section_id").alias("id")).distinct()
    return eligible.join(have, "id", "left_anti")


def cause_coverage(sections: DataFrame, observed: DataFrame, causes: DataFrame) -> DataFrame:
    """Per section how many causes of the vocabulary its activities cover, and how many not.

    ``observed`` holds (id, name) pairs, repeats included; names beyond the vocabulary do not count.
    """
    # The vocabulary is not aggregated: so AQE can split the partitions of a hot name.
    known = observed.join(causes.select("name"), "name", "left_semi").distinct()
    covered = known.groupBy("id").agg(F.count("*").alias("n_covered"))
    n = causes.agg(F.countDistinct("name").alias("n")).scalar()
    return sections.select("id").join(covered, "id", "left").select(
        "id",
        F.coalesce("n_covered", F.lit(0)).alias("n_covered"),
        (n - F.coalesce("n_covered", F.lit(0))).alias("n_missing"),
    )


def missing_causes(observed: DataFrame, causes: DataFrame, section_id: int | Column) -> DataFrame:
    """The causes of the vocabulary that the activities of one section do not cover."""
    wanted = F.lit(section_id) if isinstance(section_id, int) else section_id
    have = observed.filter(F.col("id") == wanted).select("name").distinct()
    return causes.select("name").distinct().join(have, "name", "left_anti")


def success_by_section(log: DataFrame, section: str, ok: Column) -> DataFrame:
    counted = log.groupBy(section).agg(
        F.count("*").alias("requests"), F.count_if(ok).alias("successes")
    )
    return counted.withColumn("success_rate", F.try_divide("successes", "requests"))


def success_alert(rates: DataFrame) -> DataFrame:
    """Sections under the alert threshold."""
    return rates.filter(F.col("success_rate") < ALERT_SUCCESS)


def errors_by_kind(errors: DataFrame, message: str = "error_message") -> DataFrame:
    kind = error_kind(F.col(message)).alias("kind")
    return errors.groupBy(kind).agg(F.count("*").alias("n_errors"))


def data_coverage(rows: DataFrame, required: list[str]) -> DataFrame:
    """One row: rows, complete rows and their share, and the filled share of each field."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    filled = [F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}_share") for c in required]
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(complete).alias("n_complete"),
        F.avg(complete.cast("double")).alias("coverage"),
        *filled,
    )


def sla_report(coverage: Column, error_rate: Column, http_success: Column, row: DataFrame) -> DataFrame:
    """Three service levels of a one-row frame as rows: value, threshold, met or not."""
    levels = F.array(
        _level("coverage", coverage, MIN_COVERAGE, coverage > MIN_COVERAGE),
        _level("validation_errors", error_rate, MAX_VALIDATION_ERRORS, error_rate < MAX_VALIDATION_ERRORS),
        _level("http_success", http_success, MIN_HTTP_SUCCESS, http_success > MIN_HTTP_SUCCESS),
    )
    return row.select(F.inline(levels))


def _level(name: str, value: Column, threshold: float, met: Column) -> Column:
    return F.struct(
        F.lit(name).alias("measure"),
        value.cast("double").alias("value"),
        F.lit(threshold).alias("threshold"),
        met.alias("met"),
    )


def section_report(
    sections: DataFrame, countries: DataFrame, links: DataFrame, activities: DataFrame
) -> DataFrame:
    """Activities and participants of every section, with its country.

    Facts shrink to one row per section before sections and countries are joined.
    """
    facts = activities.select(
        F.col("id").alias("activity_id"), "start_date", "participants", "is_valid", "activity_type"
    )
    per_section = (
        lookup_join(links, facts, "activity_id")
        .groupBy(F.col("section_id").alias("id"))
        .agg(
            F.count("*").alias("n_activities"),
            F.count_if("is_valid").alias("n_valid"),
            F.sum("participants").alias("participants"),
            F.countDistinct("activity_type").alias("n_types"),
            F.min("start_date").alias("first_activity"),
            F.max("start_date").alias("last_activity"),
        )
    )
    named = lookup_join(
        sections.select("id", "name", "country_code"),
        countries.select("country_code", F.col("name").alias("country")),
        "country_code",
        "left",
    )
    zero = F.lit(0)
    return named.join(per_section, "id", "left").select(
        "id",
        "name",
        "country_code",
        "country",
        F.coalesce("n_activities", zero).alias("n_activities"),
        F.coalesce("n_valid", zero).alias("n_valid"),
        F.coalesce("participants", zero).alias("participants"),
        F.coalesce("n_types", zero).alias("n_types"),
        F.round(F.try_divide("participants", "n_activities"), 2).alias("mean_participants"),
        "first_activity",
        "last_activity",
    )


def country_trend(
    sections: DataFrame, links: DataFrame, activities: DataFrame, period: str = "quarter"
) -> DataFrame:
    """Activities and participants by country and period; shared activities count once a country."""
    homes = sections.select(F.col("id").alias("section_id"), "country_code")
    owned = lookup_join(links, homes, "section_id").select("activity_id", "country_code").distinct()
    facts = activities.select(F.col("id").alias("activity_id"), "start_date", "participants")
    joined = lookup_join(owned, facts, "activity_id")
    start = F.date_trunc(period, F.col("start_date").cast("timestamp_ntz")).cast("date")
    return joined.groupBy("country_code", start.alias("period")).agg(
        F.count("*").alias("n_activities"), F.sum("participants").alias("participants")
    )


def section_counts(countries: DataFrame, sections: DataFrame) -> DataFrame:
    """Sections per country; countries without any get 0."""
    counts = sections.groupBy("country_code").agg(F.count("*").cast("int").alias("n"))
    return countries.select("country_code").join(counts, "country_code", "left").select(
        "country_code", F.coalesce("n", F.lit(0)).alias("section_count")
    )
