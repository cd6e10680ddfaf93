"""The re-validation run: check flagged rows once more, write back what was repaired."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.operators.upsert import upsert
from orgmetrics.operators.validation import Ruleset, error_changes, error_rows, revalidate
from orgmetrics.plans.stage import Stage

MODULE = "revalidation"


@dataclass(frozen=True)
class Revalidation:
    """``rows``: the table's next version; ``changes``: errors cleared, kept and new; ``errors``: new log rows."""

    rows: DataFrame
    changes: DataFrame
    errors: DataFrame


def revalidation_run(
    stored: DataFrame, known_errors: DataFrame, rules: Ruleset, key: str, as_of: Column, update: list[str]
) -> Revalidation:
    """Check the rows of ``stored`` flagged invalid, against the errors known of them.

    ``known_errors`` holds ``key, field_name, error_message``. Checked rows are staged once, since three
    results read them. Rows that pass get ``is_valid`` and, like those that still fail, the cleaned
    values of ``update``; rows that were not flagged stay as they are. Only errors that were not
    known before are logged. Keys are unique.
    """
    stage = Stage(stored.sparkSession, "revalidation")
    checked = stage.table(revalidate(stored, rules), "checked")
    changes = stage.table(error_changes(known_errors, checked, key), "changes")
    touched = "updated_at" if "updated_at" in stored.columns else None
    rows = upsert(stored, checked, [key], [*update, "is_valid"], as_of, created=None, touched=touched)
    fresh = changes.filter(F.col("change") == "new").select(key, "field_name", "error_message")
    logged = error_rows(checked, MODULE, as_of, event_slug=F.col(key).cast("string"))
    fresh = fresh.withColumn("activity_event_slug", F.col(key).cast("string")).drop(key)
    errors = logged.join(fresh, ["activity_event_slug", "field_name", "error_message"], "left_semi")
    return Revalidation(rows, changes, errors.select(*logged.columns))
