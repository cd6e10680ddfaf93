"""Equi-joins of a large side with a side whose key is unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner"
) -> DataFrame:
    """``facts.join(dim, on, how)`` for a ``dim`` with one row per key.

    ``how`` is one of inner, left, left_semi, left_anti. Catalyst broadcasts a small ``dim``. With
    both sides shuffled AQE splits the partitions of hot keys only where ``dim`` is a table or a
    plain projection of one; for a ``dim`` that is aggregated on the key see ``salted_join``.
    """
    joined = facts.join(dim, on, how)
    # A join on names moves them to the front; filters leave the facts as they were.
    return joined.select(*facts.columns) if how in ("left_semi", "left_anti") else joined


def hot_keys(facts: DataFrame, on: list[str], shares: int) -> DataFrame:
    """``on`` and ``_salts`` for keys that hold more than one of ``shares`` equal shares of the rows.

    There are fewer than ``shares`` such keys, whatever the table. ``_salts`` is the number of shares
    that a key fills. Counted by partial sums, so a hot key costs no more than any other.
    """
    known = facts.select(*on).dropna()
    counts = known.groupBy(*on).agg(F.count("*").alias("_n"))
    total = known.agg(F.count("*")).scalar()
    salts = F.ceil(F.col("_n") * shares / total).cast("int")
    return counts.select(*on, salts.alias("_salts")).filter(F.col("_salts") > 1)


def salted_join(
    facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner", shares: int | None = None
) -> DataFrame:
    """As ``lookup_join``, with the rows of hot keys dealt over several tasks whatever ``dim`` is.

    A key with more than one of ``shares`` shares of the facts (by default four per shuffle partition)
    gets a number of salts in proportion; its row of ``dim`` is copied to each, all other rows have one
    salt. The hot keys are fewer than ``shares``, hence the broadcast. The facts are read twice: use
    it where a key may hold much of them and ``dim`` is aggregated. NULL keys match nothing.
    """
    on = [on] if isinstance(on, str) else list(on)
    if shares is None:
        shares = 4 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(facts, on, shares))
    one = F.coalesce("_salts", F.lit(1))
    # Dealt by the row's place in its partition: a task that runs again deals alike.
    dealt = facts.join(hot, on, "left").withColumn(
        "_salt", F.when(one > 1, F.pmod(F.monotonically_increasing_id(), one)).otherwise(0).cast("int")
    )
    copies = dim.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
    joined = dealt.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"], how)
    shown = facts.columns if how in ("left_semi", "left_anti") else [
        *on, *(c for c in facts.columns if c not in on), *(c for c in dim.columns if c not in on)
    ]
    return joined.select(*shown)
