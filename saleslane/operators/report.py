"""The quality report over several tables, and the gates on it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.functions.rules import amount_agrees, sales_validity
from saleslane.operators.audit import TableAudit, report_row
from saleslane.operators.integrity import check_referential_integrity
from saleslane.schema import check_schema, quality_results_schema

# A completeness rate below the first, or more failed rows than the second.
MIN_COMPLETENESS = 95
CRITICAL_FAILURES = 100


def union_checks(checks: list[DataFrame]) -> DataFrame:
    """All check rows under one schema; columns a check does not have are null."""
    schema = check_schema()
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checks)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in merged.columns}
    return (merged.withColumns(absent) if absent else merged).to(schema)


def audit_table(df: DataFrame, table_name: str, as_of=None) -> TableAudit:
    """The standard audit of one table: completeness, validity, consistency and profile."""
    return TableAudit(df, table_name, [*sales_validity(as_of), amount_agrees()])


def table_checks(df: DataFrame, table_name: str, as_of=None) -> DataFrame:
    """All four check families of one table.

    The audit reads many columns, the check of the ids one. For a table that comes out of joins, that would
    be other joins and shuffles; where both read the same columns, Spark shuffles once for the two.
    """
    audit = audit_table(df, table_name, as_of)
    rows = audit.as_read(df)
    return union_checks([audit.results(), check_referential_integrity(rows, table_name)])


def unreadable_dataset(spark: SparkSession, table_name: str) -> DataFrame:
    """Check row for a dataset that could not be read or checked."""
    row = report_row(
        table_name=table_name,
        check_type="dataset_status",
        check_name="dataset_unreadable",
        rule="dataset can be read and checked",
        failed_records=F.lit(1),
    )
    return spark.range(1).select(row.alias("row")).select("row.*")


def stamp(checks: DataFrame, processing_date: str) -> DataFrame:
    stamps = {"check_timestamp": F.current_timestamp(), "processing_date": F.lit(processing_date)}
    return checks.withColumns(stamps).to(quality_results_schema())


def quality_results(
    tables: Mapping[str, DataFrame], processing_date: str, as_of=None
) -> DataFrame:
    """Report over all tables as one lazy DataFrame."""
    checks = [table_checks(df, name, as_of) for name, df in tables.items()]
    return stamp(union_checks(checks), processing_date)


def is_failed(min_completeness: float = MIN_COMPLETENESS):
    return (F.col("failed_records") > 0) | (F.col("completeness_rate") < min_completeness)


def is_critical(threshold: int = CRITICAL_FAILURES):
    return F.col("failed_records") > threshold


def failed_checks(results: DataFrame, min_completeness: float = MIN_COMPLETENESS) -> DataFrame:
    return results.where(is_failed(min_completeness))


def critical_failures(results: DataFrame, threshold: int = CRITICAL_FAILURES) -> DataFrame:
    return results.where(is_critical(threshold))
