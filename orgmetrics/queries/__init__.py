"""Registered queries: every operator on the sample tables, each next to its SQL equivalent."""

from orgmetrics.queries import (  # noqa: F401
    functions,
    logs,
    pages,
    relations,
    reports,
    selections,
    statistics,
    validations,
    writes,
)
from orgmetrics.queries.registry import ORACLES, QUERIES  # noqa: F401
