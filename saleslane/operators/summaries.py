"""The three summaries, declared as grouping keys and measures.

Each runs as a partial and a final hash aggregate around one exchange, so a hot group reaches
the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslane.functions.columns import MONEY_SCALE, SPEND_TIERS, spend_tier


@dataclass(frozen=True)
class Summary:
    """``measures`` maps an output column to (aggregate, input column); ``few_rows`` says that
    the number of rows in a partition folder is bounded, whatever the size of the input."""

    name: str
    keys: tuple[str, ...]
    measures: Mapping[str, tuple[str, str]]
    partitions: tuple[str, ...]
    few_rows: bool = False

    def of(self, df: DataFrame) -> DataFrame:
        measures = [
            getattr(F, aggregate)(F.col(column)).alias(output)
            for output, (aggregate, column) in self.measures.items()
        ]
        return df.groupBy(*self.keys).agg(*measures)


# Names, keys and measures of the published summaries. ``count`` skips null ids.
DAILY = Summary(
    name="daily_sales_summary",
    keys=("year", "month", "day", "region"),
    measures={
        "daily_revenue": ("sum", "total_amount"),
        "daily_transactions": ("count", "id"),
        "avg_transaction_amount": ("avg", "total_amount"),
    },
    partitions=("region", "year", "month"),
    few_rows=True,  # one per day of the month
)
# Spend is per region, while the tier comes from the customer's total over all regions.
CUSTOMER = Summary(
    name="customer_summary",
    keys=("customer_id", "customer_category", "region"),
    measures={
        "total_spent": ("sum", "total_amount"),
        "total_transactions": ("count", "id"),
        "avg_transaction_amount": ("avg", "total_amount"),
        "last_purchase_date": ("max", "transaction_date"),
    },
    partitions=("region",),
)
PRODUCT = Summary(
    name="product_summary",
    keys=("product_id", "category", "region"),
    measures={
        "total_quantity_sold": ("sum", "quantity"),
        "total_revenue": ("sum", "total_amount"),
        "total_orders": ("count", "id"),
        "avg_price": ("avg", "price"),
    },
    partitions=("region",),
)
SUMMARIES = (DAILY, CUSTOMER, PRODUCT)


def create_aggregations(df: DataFrame) -> tuple[DataFrame, ...]:
    """Daily, customer and product summary of the transformed sales fact, in this order."""
    return tuple(summary.of(df) for summary in SUMMARIES)


SUMMARY_SET = "_set"


class SummarySets:
    """Several summaries from one scan and one shuffle, as grouping sets.

    Every row is grouped by the keys of each summary within its task, so the scan is read once, and only
    groups reach the shuffle. A measure that several summaries ask for is computed once.
    """

    def __init__(self, summaries: Sequence[Summary] = SUMMARIES):
        self.summaries = tuple(summaries)
        self.keys = list(dict.fromkeys(k for s in self.summaries for k in s.keys))
        wanted = dict.fromkeys(m for s in self.summaries for m in s.measures.values())
        # named by number, so no measure can collide with a key
        self._measures = {measure: f"_measure_{i}" for i, measure in enumerate(wanted)}
        self._ids = {s.name: self._set_id(s) for s in self.summaries}
        if len(set(self._ids.values())) < len(self.summaries):
            raise ValueError("summaries with the same keys are one grouping set")

    def _set_id(self, summary: Summary) -> int:
        """What grouping_id gives the rows of a summary: a bit for each key that it does not have."""
        return sum(1 << i for i, k in enumerate(reversed(self.keys)) if k not in summary.keys)

    def of(self, df: DataFrame) -> DataFrame:
        """The groups of all summaries; SUMMARY_SET says whose group a row is."""
        measures = [
            getattr(F, aggregate)(F.col(column)).alias(name)
            for (aggregate, column), name in self._measures.items()
        ]
        sets = [[F.col(k) for k in s.keys] for s in self.summaries]
        return df.groupingSets(sets, *self.keys).agg(F.grouping_id().alias(SUMMARY_SET), *measures)

    def rows(self, groups: DataFrame, summary: Summary) -> DataFrame:
        """The rows of one summary among the groups of all."""
        measures = [F.col(self._measures[m]).alias(output) for output, m in summary.measures.items()]
        return groups.where(F.col(SUMMARY_SET) == self._ids[summary.name]).select(*summary.keys, *measures)


def customer_summary_of_lines(
    lines: DataFrame,
    tiers: Sequence[tuple[str, float]] = SPEND_TIERS,
    money_scale: int | None = MONEY_SCALE,
    summary: Summary | None = None,
) -> DataFrame:
    """The customer summary without the transformed fact.

    Lines are read once and reach the shuffle as customer and region groups, so no line is
    shuffled or joined. The window then runs over the groups, one row per region of a customer.
    """
    summary = summary or CUSTOMER
    groups = replace(summary, keys=("customer_id", "region")).of(lines)
    total = F.sum("total_spent").over(Window.partitionBy("customer_id"))
    tier = spend_tier(F.col("_total"), tiers, money_scale=money_scale)
    columns = [*summary.keys, *summary.measures]
    return (
        groups.withColumn("_total", total).withColumn("customer_category", tier).select(*columns)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
