"""Enrichment of the sales fact: amounts, date parts, customer totals, spend tiers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.functions.columns import MONEY_SCALE, SPEND_TIERS, date_parts, line_amount, quoted, spend_tier
from saleslane.operators.running import with_earlier

# A customer is heavy with at least this many rows and this share of all rows. No more than
# 1 / HEAVY_SHARE customers can have the share, which bounds what is broadcast.
HEAVY_ROWS = 1_000_000
HEAVY_SHARE = 0.005


def add_line_facts(df: DataFrame) -> DataFrame:
    """Line amount and calendar parts: a projection, no shuffle."""
    return df.withColumns({"total_amount": line_amount(), **date_parts()})


def add_group_total(
    df: DataFrame,
    key: str,
    amount: str | Column,
    total: str,
    heavy_rows: int = HEAVY_ROWS,
    heavy_share: float = HEAVY_SHARE,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Put the sum of ``amount`` over all rows of the same ``key`` on every row.

    Null keys form one group, as in a window partitioned by ``key``. A window would sort all
    rows of a key in one task; a key with a third of the table would never finish. Here the
    sums are aggregated before the shuffle and joined back:

    * rows of heavy keys meet a broadcast of their totals and are not shuffled at all. Shares
      add up to one, so the broadcast holds at most ``1 / heavy_share`` rows for any table;
    * all other rows are joined by shuffle. Their keys have small shares, and adaptive execution
      splits a partition that is still too large.

    The result does not depend on the limits, only the plan does: a heavy key beyond the bound of the
    broadcast stays in the other branch. ``df`` is read more than once, so it should be a table.
    ``earlier`` holds totals of rows that are not in ``df`` (`saleslane.operators.running`); they count too.
    Without heavy keys the broadcast is empty and adaptive execution drops the first branch,
    so the rows are read once for the totals and once for the join.
    """
    df = df.drop(total)
    totals = df.groupBy(F.col(key).alias("_key")).agg(
        F.sum(amount).alias(total), F.count(F.lit(1)).alias("_rows")
    )
    # Every use of totals touches the sum and the count, needed or not. So column pruning leaves
    # the aggregates alike, and Spark runs one and reuses its exchange.
    whole = totals.agg(F.struct(F.sum("_rows").alias("rows"), F.sum(total).alias("sum"))).scalar()
    heavy = (
        totals.where(F.col("_rows") >= heavy_rows)
        .where(F.col("_rows") >= whole["rows"] * heavy_share)
        # the key is unique, so the order is total and both joins below see the same keys
        .orderBy(F.desc("_rows"), "_key", total)
        .limit(math.floor(1 / heavy_share))
        .select("_key", total)
    )
    heavy = with_earlier(heavy, "_key", total, earlier)
    rest = with_earlier(totals.where(F.col("_rows") > 0).select("_key", total), "_key", total, earlier)
    same_key = F.col(key).eqNullSafe(F.col("_key"))

    in_heavy = df.join(F.broadcast(heavy), same_key, "inner")
    in_rest = df.join(F.broadcast(heavy), same_key, "left_anti").join(rest, same_key, "left")
    return in_heavy.unionByName(in_rest).drop("_key")


def add_customer_total(
    df: DataFrame,
    earlier: DataFrame | None = None,
    amount: str | Column = "total_amount",
    **limits: float,
) -> DataFrame:
    total = "customer_total_spent"
    return add_group_total(df, "customer_id", amount, total, earlier=earlier, **limits)


def add_customer_tier(
    df: DataFrame,
    tiers: Sequence[tuple[str, float]] = SPEND_TIERS,
    money_scale: int | None = MONEY_SCALE,
) -> DataFrame:
    tier = spend_tier(F.col("customer_total_spent"), tiers, money_scale=money_scale)
    return df.withColumn("customer_category", tier)


def transform_sales_data(
    df: DataFrame,
    tiers: Sequence[tuple[str, float]] = SPEND_TIERS,
    money_scale: int | None = MONEY_SCALE,
    earlier: DataFrame | None = None,
    **limits: float,
) -> DataFrame:
    """The sales fact with every derived column.

    Totals and tiers cover the rows of ``df``, and what customers spent before if ``earlier`` has it.
    What a row tells by itself is added behind the join of the totals, so that it is not shuffled.
    """
    total = "customer_total_spent"
    names = [c for c in add_line_facts(df).columns if c != total]
    joined = add_customer_total(df, earlier, line_amount(), **limits)
    totals = add_line_facts(joined).select(*[quoted(c) for c in names], total)
    return add_customer_tier(totals, tiers, money_scale)
