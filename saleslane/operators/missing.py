"""Missing-data analysis: how many values are missing together in a row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.functions.columns import missing_count
from saleslane.operators.audit import report_row


def missing_pattern(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows by number of missing values; at most one group per column of the table."""
    missing = missing_count(df.schema, columns)
    return df.groupBy(missing.alias("missing_values")).agg(F.count(F.lit(1)).alias("row_count"))


def check_missing_pattern(
    df: DataFrame, table_name: str = "unknown", columns: Iterable[str] | None = None
) -> DataFrame:
    """The rows with at least one missing value, as one check row per number of them."""
    row = report_row(
        table_name=table_name,
        check_type="missing_data",
        check_name=F.format_string("rows_missing_%d", "missing_values"),
        rule="no value is missing",
        failed_records=F.col("row_count"),
    )
    incomplete = missing_pattern(df, columns).where(F.col("missing_values") > 0)
    return incomplete.select(row.alias("row")).select("row.*")
