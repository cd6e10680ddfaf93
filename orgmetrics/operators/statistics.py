"""Section statistics out of the settings JSON of statistics pages.

Input frames hold the section key and ``stats``: statistics by key, each a list of
``[name, count]`` items (see ``sources.settings_json``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Categories with the name their rows are stored under, and the three list kinds.
CATEGORIES = {"causes": "cause_name", "types": "activity_type", "participants": "participant_type"}
KINDS = ("total", "physical", "online")

# Overall counts by statistics key and position in its list.
_OVERALL = {
    "physical_activities": ("total_activities", 0),
    "online_activities": ("total_activities", 1),
    "total_local_students": ("total_participants", 0),
    "total_international_students": ("total_participants", 1),
    "total_coordinators": ("total_participants", 2),
}


def _values(key: str) -> Column:
    return F.col("stats")[key]["values"]


def overall_statistics(df: DataFrame) -> DataFrame:
    """Positional overall counts, 0 where the document lacks them; one row per input row."""
    counts = []
    for name, (key, position) in _OVERALL.items():
        item = F.try_element_at(_values(key), F.lit(position + 1))
        count = F.try_element_at(item, F.lit(2)).try_cast("bigint")
        counts.append(F.coalesce(count, F.lit(0)).alias(name))
    others = [c for c in df.columns if c != "stats"]
    return df.select(*others, *counts, F.col("stats").isNotNull().alias("has_statistics"))


def _entries(category: str) -> Column:
    """Items of the three lists of one category; items without a count are skipped."""
    return F.array_compact(F.concat(*(_named_items(kind, category) for kind in KINDS)))


def _named_items(kind: str, category: str) -> Column:
    items = F.coalesce(_values(f"{kind}_{category}"), F.array().cast("array<array<string>>"))
    return F.transform(
        items,
        lambda item, i: F.when(
            F.size(item) >= 2,
            F.struct(
                F.lit(category).alias("category"),
                F.lit(kind).alias("kind"),
                i.alias("position"),
                item[0].alias("name"),
                item[1].try_cast("bigint").alias("count"),
            ),
        ),
    )


def detail_statistics(df: DataFrame, key: str, categories: tuple[str, ...]) -> DataFrame:
    """(key, category, name) with total, physical and online counts.

    A name repeated within a list counts with its last entry; a name in any list makes a row.
    """
    entries = F.concat(*(_entries(c) for c in categories))
    long = df.select(key, F.inline(entries))

    def last_count(kind: str) -> Column:
        own = F.col("kind") == kind
        last = F.max_by(F.when(own, F.col("count")), F.when(own, F.col("position")))
        return F.coalesce(last, F.lit(0)).alias(f"{kind}_count")

    return long.groupBy(key, "category", "name").agg(*(last_count(k) for k in KINDS))


def category_statistics(df: DataFrame, key: str, category: str) -> DataFrame:
    """Rows of one statistics table; only causes store a total."""
    rows = detail_statistics(df, key, (category,))
    kinds = KINDS if category == "causes" else KINDS[1:]
    return rows.select(
        key, F.col("name").alias(CATEGORIES[category]), *(f"{k}_count" for k in kinds)
    )


def _row_list(category: str) -> Column:
    """The list of one category, sorted by name, made inside the row: a repeated name counts last."""
    entries = _entries(category)

    def last_count(kind: str, name: Column) -> Column:
        own = F.filter(entries, lambda e: (e["kind"] == kind) & e["name"].eqNullSafe(name))
        return F.coalesce(F.try_element_at(own, F.lit(-1))["count"], F.lit(0)).alias(f"{kind}_count")

    def item(name: Column) -> Column:
        return F.struct(name.alias("name"), *(last_count(k, name) for k in KINDS))

    names = F.array_distinct(F.transform(entries, lambda e: e["name"]))
    return F.array_sort(F.transform(names, item))


def assembled_statistics(df: DataFrame, key: str) -> DataFrame:
    """Overall counts with the three detail lists, sorted by name, and ``is_complete``.

    One row per input row, made inside the row: nothing is shuffled and the input is read once. The
    lists of a row without any entry are NULL. Keys are unique.
    """
    some = F.lit(0)
    for c in CATEGORIES:
        some = some + F.size(_entries(c))
    lists = [F.when(some > 0, _row_list(c)).alias(c) for c in CATEGORIES]
    complete = F.lit(True)
    for c in CATEGORIES:
        complete = complete & (F.size(_entries(c)) > 0)
    overall = overall_statistics(df.withColumn("_stats", F.col("stats"))).withColumnRenamed("_stats", "stats")
    shown = [c for c in overall.columns if c != "stats"]
    return overall.select(*shown, *lists, complete.alias("is_complete"))


def zero_filled(sections: DataFrame, overall: DataFrame, key: str) -> DataFrame:
    """One statistics row per section: zeros and ``has_statistics = false`` where none exist."""
    names = list(_OVERALL)
    found = overall.select(key, *names, F.lit(True).alias("_found"))
    return sections.select(key).join(found, key, "left").select(
        key,
        *(F.coalesce(n, F.lit(0)).alias(n) for n in names),
        F.coalesce("_found", F.lit(False)).alias("has_statistics"),
    )


def recomputed_statistics(rows: DataFrame, section: str, category: str, online: Column) -> DataFrame:
    """The same counts taken from activity rows instead of the published document."""
    return rows.groupBy(section, category).agg(
        F.count("*").alias("total_count"),
        F.count_if(~online).alias("physical_count"),
        F.count_if(online).alias("online_count"),
    )
