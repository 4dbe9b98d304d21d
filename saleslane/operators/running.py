"""Totals over days: what every key has come to so far, kept as a table and merged day by day.

Sums and counts of parts add up to those of the whole, so a day needs the totals up to the day before
and its own rows, and never the rows of earlier days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.functions.columns import quoted

TOTAL, ROWS = "total", "rows"


def partial_totals(df: DataFrame, key: str, amount: str, rows: str | None = None) -> DataFrame:
    """(key, total, rows) of some rows, or of groups that count ``rows`` each."""
    number = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return df.groupBy(quoted(key).alias("key")).agg(
        F.sum(amount).alias(TOTAL), number.cast("long").alias(ROWS)
    )


def merged_totals(parts: Sequence[DataFrame]) -> DataFrame:
    """The totals of several parts together, whatever their order; null keys are one key."""
    together = reduce(DataFrame.unionByName, parts)
    return together.groupBy("key").agg(F.sum(TOTAL).alias(TOTAL), F.sum(ROWS).alias(ROWS))


def with_earlier(totals: DataFrame, key: str, total: str, earlier: DataFrame | None) -> DataFrame:
    """Add what each key had before to column ``total`` of one row per key."""
    if earlier is None:
        return totals
    before = earlier.select(F.col("key").alias("_before_key"), F.col(TOTAL).alias("_before"))
    met = totals.join(before, F.col(key).eqNullSafe(F.col("_before_key")), "left")
    both = F.coalesce(F.col(total) + F.col("_before"), F.col(total), F.col("_before"))
    return met.withColumn(total, both).drop("_before_key", "_before")
