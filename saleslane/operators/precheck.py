"""Checks on the raw input before a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.functions.rules import Rule
from saleslane.operators.audit import TableAudit
from saleslane.operators.clean import REQUIRED
from saleslane.schema import define_schema
from saleslane.sources.tables import mismatched_files


class InputRejected(ValueError):
    """The raw input must not be processed."""


def sales_columns() -> list[str]:
    return define_schema().fieldNames()


def check_input(
    df: DataFrame,
    table_name: str = "raw",
    required: Sequence[str] = REQUIRED,
    bad_files: int | None = None,
) -> DataFrame:
    """Missing columns, emptiness and completeness of the required columns, in one pass.

    ``bad_files`` is the number of files with another header, where the input comes from files.
    """
    present = [name for name in required if name in df.columns]
    absent = len(set(sales_columns()).difference(df.columns))
    audit = TableAudit(df.select(*present), table_name, profile=False)
    all_columns = "all sales columns are present"
    rules = [
        Rule("precheck", "missing_columns", all_columns, (), F.lit(absent)),
        Rule("precheck", "empty_input", "input has rows", (), F.col("rows") == 0),
    ]
    if bad_files is not None:
        text = "every file has the sales columns in order"
        rules.append(Rule("precheck", "mismatched_files", text, (), F.lit(bad_files)))
    return audit.results(rules)


def require_headers(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> None:
    """Refuse files whose header lacks columns or has them in another order, naming the files."""
    bad = mismatched_files(spark, path, columns)
    if bad:
        files = "; ".join(f"{file} has {', '.join(header)}" for file, header in bad)
        expected = ", ".join(columns or sales_columns())
        raise InputRejected(f"{path}: columns must be {expected}, but {files}")


def require_rows(df: DataFrame, table_name: str = "raw") -> None:
    """Reads until the first row only: head starts with one task, isEmpty with one per split."""
    if not df.head(1):
        raise InputRejected(f"{table_name}: no rows")


def require_completeness(
    df: DataFrame,
    minimum: float,
    required: Sequence[str] = REQUIRED,
    table_name: str = "raw",
) -> None:
    """One aggregation pass over the required columns; raises below ``minimum`` percent."""
    audit = TableAudit(df.select(*required), table_name, profile=False)
    # bounded: one row per required column
    low = audit.results().where(F.col("completeness_rate") < minimum).collect()
    if low:
        names = ", ".join(f"{row.column_name} {row.completeness_rate:.2f}%" for row in low)
        raise InputRejected(f"{table_name}: completeness below {minimum}%: {names}")
