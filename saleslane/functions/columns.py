"""Scalar expressions. All of them are built-in Spark expressions and stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

# Spend tiers, highest first; a total must be above the bound.
SPEND_TIERS = (("Premium", 10000.0), ("Gold", 5000.0), ("Silver", 1000.0))
LOWEST_TIER = "Bronze"
# Totals are compared with the bounds in cents.
MONEY_SCALE = 2

# Type names that count as numeric when a table is profiled.
PROFILED_TYPES = ("int", "bigint", "float", "double")


def quoted(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def line_amount(quantity: str = "quantity", price: str = "price") -> Column:
    return F.col(quantity) * F.col(price)


def date_parts(date: str = "transaction_date") -> dict[str, Column]:
    return {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}


def spend_tier(
    total: Column,
    tiers: Sequence[tuple[str, float]] = SPEND_TIERS,
    lowest: str = LOWEST_TIER,
    money_scale: int | None = MONEY_SCALE,
) -> Column:
    """Tier of a customer total; a null total falls to the lowest tier.

    Sums of doubles depend on the order of addition. Totals are compared rounded to
    ``money_scale`` places, so that a customer exactly on a bound gets the same tier every run;
    None compares them as they are.
    """
    compared = total if money_scale is None else F.round(total, money_scale)
    if not tiers:
        return F.lit(lowest)
    (name, bound), *others = tiers
    tier = F.when(compared > bound, name)
    for name, bound in others:
        tier = tier.when(compared > bound, name)
    return tier.otherwise(lowest)


# Text that a folder name would not give back: Spark names the folder of null and of the empty text so.
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPE = "~"


def escaped(name: str) -> Column:
    """Text as a folder name can hold it: the empty text, NO_FOLDER, and text that begins with ESCAPE
    get an ESCAPE in front; null and all other text stay as they are."""
    text = quoted(name)
    odd = (text == "") | (text == NO_FOLDER) | text.startswith(ESCAPE)
    return F.when(odd, F.concat(F.lit(ESCAPE), text)).otherwise(text)


def unescaped(name: str) -> Column:
    """The text that ``escaped`` was given."""
    text = quoted(name)
    return F.when(text.startswith(ESCAPE), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def is_missing(field: StructField) -> Column:
    """Null, or NaN where the type has NaN. The string 'NaN' is not missing."""
    column = quoted(field.name)
    if isinstance(field.dataType, (FloatType, DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def completeness_rate(total: Column, missing: Column) -> Column:
    """Share of present values in percent; 0.0 for an empty table."""
    return F.when(total > 0, (total - missing) / total * 100).otherwise(F.lit(0.0))


def numeric_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if f.dataType.simpleString() in PROFILED_TYPES]


def missing_count(schema: StructType, names: Iterable[str] | None = None) -> Column:
    """Number of missing values in a row over the named columns (all by default)."""
    wanted = None if names is None else set(names)
    flags = [is_missing(f).cast("int") for f in schema if wanted is None or f.name in wanted]
    total = F.lit(0)
    for flag in flags:
        total = total + flag
    return total
