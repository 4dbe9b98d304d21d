"""Row rules. A rule names the rows that fail it; all rules of a table are counted in one pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslane.functions.columns import quoted


@dataclass(frozen=True)
class Rule:
    """``failed`` is true on failing rows; null counts as passing."""

    check_type: str
    name: str
    text: str
    columns: tuple[str, ...]
    failed: Column
    column_name: str | None = None


def applicable(rules: Iterable[Rule], schema: StructType) -> list[Rule]:
    """Rules whose columns all exist. A rule on a missing column yields no report row."""
    present = set(schema.fieldNames())
    return [rule for rule in rules if present.issuperset(rule.columns)]


def not_negative(column: str) -> Rule:
    return Rule("validity", f"negative_{column}", f"{column} >= 0", (column,), quoted(column) < 0)


def not_in_future(column: str, as_of: str | datetime | Column | None = None) -> Rule:
    """Dates after ``as_of`` (now by default) fail; the rule text speaks of current_date."""
    bound = F.current_timestamp() if as_of is None else as_of
    if isinstance(bound, str):
        bound = F.lit(bound).cast("timestamp")
    elif isinstance(bound, datetime):
        bound = F.lit(bound)
    return Rule(
        "validity",
        f"future_{column}",
        f"{column} <= current_date",
        (column,),
        quoted(column) > bound,
    )


def sales_validity(as_of: str | datetime | Column | None = None) -> list[Rule]:
    return [
        not_negative("quantity"),
        not_negative("price"),
        not_in_future("transaction_date", as_of),
    ]


def amount_agrees(tolerance: float = 0.01) -> Rule:
    """The stored line amount may differ from quantity * price by at most ``tolerance``."""
    gap = F.abs(F.col("total_amount") - F.col("quantity") * F.col("price"))
    return Rule(
        "consistency",
        "total_amount_calculation",
        "total_amount = quantity * price",
        ("quantity", "price", "total_amount"),
        gap > tolerance,
    )


def castable(column: str, type_name: str) -> Rule:
    """Present values that cannot be read as ``type_name`` fail."""
    value = quoted(column)
    return Rule(
        "type",
        f"{column}_is_{type_name}",
        f"{column} can be read as {type_name}",
        (column,),
        value.isNotNull() & value.try_cast(type_name).isNull(),
        column,
    )


def in_range(column: str, low=None, high=None) -> Rule:
    """Present values outside the closed range fail; an open end is None."""
    value = quoted(column)
    failed = F.lit(False)
    if low is not None:
        failed = failed | (value < F.lit(low))
    if high is not None:
        failed = failed | (value > F.lit(high))
    bounds = f"{'' if low is None else f'{low} <= '}{column}{'' if high is None else f' <= {high}'}"
    return Rule("range", f"{column}_in_range", bounds, (column,), failed, column)


def matches(column: str, pattern: str) -> Rule:
    """Present values in which the regular expression finds nothing fail."""
    return Rule(
        "format",
        f"{column}_format",
        f"{column} matches {pattern}",
        (column,),
        ~quoted(column).rlike(pattern),
        column,
    )


def business_rule(name: str, failed: Column, text: str, columns: Iterable[str] = ()) -> Rule:
    """A named cross-field rule, given as the condition of the rows that break it."""
    return Rule("business", name, text, tuple(columns), failed)
