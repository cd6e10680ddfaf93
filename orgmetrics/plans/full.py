"""Both runs in order: the accounts run when it is due, then the activities run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from orgmetrics.operators.extraction import Site
from orgmetrics.operators.selection import refresh_due
from orgmetrics.plans.accounts import AccountsRun, accounts_run
from orgmetrics.plans.activities import ActivitiesRun, activities_run


def full_run(
    pages: DataFrame,
    answers: DataFrame,
    stored: dict[str, DataFrame],
    site: Site,
    as_of: Column,
    limit: int | None = None,
) -> tuple[AccountsRun | None, ActivitiesRun]:
    """The accounts run is skipped while the sections of the last one are recent enough."""
    due = refresh_due(stored["sections"], stored["scraper_status"], as_of).first()["due"]
    accounts = None
    if due:
        accounts = accounts_run(
            pages, answers, stored["countries"], stored["sections"], site, as_of
        )
        stored = {**stored, "countries": accounts.countries, "sections": accounts.sections}
    return accounts, activities_run(pages, stored, site, as_of, limit)
