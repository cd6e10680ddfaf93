"""The rules that the stored tables declare, checked on tables that do not enforce them.

Rules of single rows (NOT NULL, length, CHECK) are compiled into one aggregation per table. Keys are
counted once each, references are looked up in the distinct keys of their table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmetrics.operators.integrity import fk_orphans
from orgmetrics.schemas import Table

REPORT = "table_name string, rule string, n_bad bigint, n_rows bigint"


def row_rules(table: Table) -> list[tuple[str, Column]]:
    """(name, is broken) of every rule that a row breaks by itself; NULL breaks NOT NULL alone."""
    missing = [c for c in dict.fromkeys((*table.key, *table.not_null))]
    rules = [(f"{c} NOT NULL", F.col(c).isNull()) for c in missing]
    rules += [(f"{c} AT MOST {n}", F.char_length(c) > n) for c, n in table.longest]
    rules += [(f"CHECK {name}", ~F.expr(condition)) for name, condition in table.checks]
    return [(name, F.coalesce(broken, F.lit(False))) for name, broken in rules]


def unique_rules(table: Table) -> list[tuple[str, ...]]:
    """The key and the other unique columns; a table without a key has no rule for it."""
    return [u for u in dict.fromkeys((table.key, *table.unique)) if u]


def _unique_name(columns: tuple[str, ...]) -> str:
    return f"UNIQUE ({', '.join(columns)})"


def _reference_name(column: str, other: str, key: str) -> str:
    return f"{column} REFERENCES {other} ({key})"


def constraint_report(tables: dict[str, DataFrame], known: dict[str, Table]) -> DataFrame:
    """``table_name, rule, n_bad, n_rows``: rows that break each declared rule of each given table.

    A key that n rows share counts n - 1 times. Rules on columns that a frame lacks, and references
    to tables that are not given, are left out.
    """
    parts = []
    for name, rows in tables.items():
        table, have = known[name], set(rows.columns)
        total = F.count("*").alias("n_rows")
        rules = [(n, b) for n, b in row_rules(_restricted(table, have))]
        if rules:
            counts = rows.agg(*(F.count_if(b).alias(f"_{i}") for i, (_, b) in enumerate(rules)), total)
            found = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("n_bad")) for i, (n, _) in enumerate(rules)))
            parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(found), "n_rows"))
        for columns in unique_rules(table):
            if have.issuperset(columns):
                given = reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))
                # All of them less the different ones: no counts per key beside the keys themselves.
                keys = rows.filter(given).select(*columns).distinct().agg(F.count("*").alias("_keys"))
                known_rows = rows.agg(F.count_if(given)).scalar()
                repeats = keys.select((known_rows - F.col("_keys")).alias("n_bad"))
                parts.append(_line(name, _unique_name(columns), repeats, rows))
        for column, other, key in table.references:
            if column in have and other in tables:
                orphans = fk_orphans(rows.select(column), tables[other], column, key)
                orphans = orphans.agg(F.count("*").alias("n_bad"))
                parts.append(_line(name, _reference_name(column, other, key), orphans, rows))
    return reduce(DataFrame.unionByName, parts)


def _line(table: str, rule: str, counted: DataFrame, rows: DataFrame) -> DataFrame:
    total = rows.agg(F.count("*")).scalar()
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "n_bad", total.alias("n_rows")
    )


def _restricted(table: Table, have: set[str]) -> Table:
    """The table with the rules of the columns that are there."""
    return Table(
        table.name, table.ddl, tuple(c for c in table.key if c in have),
        not_null=tuple(c for c in table.not_null if c in have),
        longest=tuple(x for x in table.longest if x[0] in have),
        checks=tuple(x for x in table.checks if any(c in x[1] for c in have)),
    )


def violations(rows: DataFrame, table: Table) -> DataFrame:
    """The rows that break a rule of their own, with ``broken``, the names of those rules."""
    rules = row_rules(_restricted(table, set(rows.columns)))
    broken = F.array_compact(F.array(*(F.when(b, F.lit(n)) for n, b in rules)))
    return rows.withColumn("broken", broken).filter(F.size("broken") > 0)


def create_projection(given: DataFrame, table: Table, computed: dict[str, Column] | None = None) -> DataFrame:
    """New rows of a table from what a caller gives: no generated columns, defaults for NULLs.

    ``computed`` are columns that follow from others. Columns that are neither given, computed nor
    defaulted are NULL; columns the table does not have are left out.
    """
    computed, defaults, have = computed or {}, dict(table.defaults), set(given.columns)
    columns = []
    for f in table.schema.fields:
        if f.name in table.generated:
            continue
        value = computed.get(f.name, F.col(f.name) if f.name in have else F.lit(None))
        if f.name in defaults:
            value = F.coalesce(value, F.expr(defaults[f.name]))
        columns.append(value.cast(f.dataType).alias(f.name))
    return given.select(*columns)
