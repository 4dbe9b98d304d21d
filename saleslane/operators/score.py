"""Quality score of a table: the share of rows that pass every rule."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.functions.columns import completeness_rate
from saleslane.functions.rules import Rule, applicable
from saleslane.operators.audit import report_row


def rows_failing(rules: Iterable[Rule]) -> Column:
    """True on rows that fail any rule; a rule that is null on a row counts as passed."""
    flags = [F.coalesce(rule.failed, F.lit(False)) for rule in rules]
    return reduce(or_, flags, F.lit(False))


def quality_score(df: DataFrame, passing: Column, table_name: str = "unknown") -> DataFrame:
    """Score from a row condition: rows where it is true count as good, null and false do not."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(passing).alias("passing_records"),
    )
    total, good = F.col("total_records"), F.col("passing_records")
    return counted.select(
        F.lit(table_name).alias("table_name"),
        total,
        good,
        completeness_rate(total, total - good).alias("quality_score"),
    )


def score_by_rules(df: DataFrame, rules: Iterable[Rule], table_name: str = "unknown") -> DataFrame:
    return quality_score(df, ~rows_failing(applicable(rules, df.schema)), table_name)


def check_quality_score(df: DataFrame, passing: Column, table_name: str = "unknown") -> DataFrame:
    """The score as a check row: ``failed_records`` holds the rows that are not good."""
    row = report_row(
        table_name=table_name,
        check_type="score",
        check_name="quality_score",
        rule="row passes every rule",
        total_records=F.col("total_records"),
        failed_records=F.col("total_records") - F.col("passing_records"),
    )
    return quality_score(df, passing, table_name).select(row.alias("row")).select("row.*")
