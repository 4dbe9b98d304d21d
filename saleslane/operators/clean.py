"""Cleaning: drop unusable rows, fill gaps, stamp. One Filter and one Project, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Defaults of the cleaning rules.
REQUIRED = ("customer_id", "product_id")
POSITIVE = ("quantity", "price")
FILLED = ("category", "region")
FILL_VALUE = "UNKNOWN"


def usable_row(
    required: Sequence[str] = REQUIRED, positive: Sequence[str] = POSITIVE
) -> Column:
    """Keys present and amounts strictly above zero. NaN is above zero in Spark's order."""
    conditions = [F.col(name).isNotNull() for name in required]
    conditions += [F.col(name) > 0 for name in positive]
    return reduce(and_, conditions, F.lit(True))


def rejections(
    required: Sequence[str] = REQUIRED, positive: Sequence[str] = POSITIVE
) -> Column:
    """Why a row is not usable, as texts in the order of the rules; none for a usable row."""
    reasons = [F.when(F.col(name).isNull(), F.lit(f"{name} is missing")) for name in required]
    reasons += [
        F.when(F.col(name).isNull(), F.lit(f"{name} is missing")).when(
            ~(F.col(name) > 0), F.lit(f"{name} is not above zero")
        )
        for name in positive
    ]
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")


def keep_usable_rows(
    df: DataFrame, required: Sequence[str] = REQUIRED, positive: Sequence[str] = POSITIVE
) -> DataFrame:
    return df.where(usable_row(required, positive))


def fill_missing(
    df: DataFrame, columns: Sequence[str] = FILLED, value: str = FILL_VALUE
) -> DataFrame:
    """Replace nulls in the named string columns; other types and absent columns stay as they are."""
    strings = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    filled = {name: F.coalesce(name, F.lit(value)) for name in columns if name in strings}
    return df.withColumns(filled) if filled else df


def with_processing_time(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def clean_data(
    df: DataFrame,
    required: Sequence[str] = REQUIRED,
    positive: Sequence[str] = POSITIVE,
    filled: Sequence[str] = FILLED,
    fill_value: str = FILL_VALUE,
) -> DataFrame:
    """Usable rows with gaps filled and the time of processing added."""
    usable = fill_missing(keep_usable_rows(df, required, positive), filled, fill_value)
    return with_processing_time(usable)
