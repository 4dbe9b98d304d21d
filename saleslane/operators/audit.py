"""One-pass table audit: completeness, row rules and numeric profile from a single aggregate.

Every measure is an aggregate without grouping keys, so each map task sends one row to the
shuffle and the table is scanned once, however many columns and rules there are. The report
rows are then unfolded from that one row of measures.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.functions.columns import (
    completeness_rate,
    is_missing,
    numeric_columns,
    quoted,
)
from saleslane.functions.rules import Rule, amount_agrees, applicable, sales_validity
from saleslane.schema import check_schema, profile_schema


def report_row(**values: Column | str | None) -> Column:
    """A struct with the columns of a check row; columns not given are null."""
    fields = []
    for field in check_schema():
        value = values.get(field.name)
        column = value if isinstance(value, Column) else F.lit(value)
        fields.append(column.cast(field.dataType).alias(field.name))
    return F.struct(*fields)


def kept(few: DataFrame) -> DataFrame:
    """The same rows without their plan; for a single aggregated row, which the driver can hold."""
    return few.sparkSession.createDataFrame(few.collect(), few.schema)


class TableAudit:
    """Measures of one table, and the report rows drawn from them."""

    def __init__(
        self,
        df: DataFrame,
        table_name: str = "unknown",
        rules: Iterable[Rule] = (),
        completeness: bool = True,
        profile: bool = True,
    ):
        self.table_name = table_name
        self.rules = applicable(rules, df.schema)
        self.checked = list(df.schema) if completeness else []
        self.profiled = numeric_columns(df.schema) if profile else []
        self.column_count = len(df.columns)
        self.measures = df.agg(*self._aggregates())

    def _aggregates(self) -> list[Column]:
        # measures are named by position, so no column name can collide with them
        found = [F.count(F.lit(1)).alias("rows")]
        found += [F.count_if(is_missing(f)).alias(f"missing_{i}") for i, f in enumerate(self.checked)]
        found += [F.count_if(r.failed).alias(f"failed_{i}") for i, r in enumerate(self.rules)]
        for i, name in enumerate(self.profiled):
            column = quoted(name)
            found += [
                F.min(column).alias(f"min_{i}"),
                F.max(column).alias(f"max_{i}"),
                F.avg(column).alias(f"avg_{i}"),
                F.count(column).alias(f"present_{i}"),
            ]
        return found

    def as_read(self, df: DataFrame) -> DataFrame:
        """``df``, the audited table, of which any other reader reads the columns that `results` reads."""
        counts = self._aggregates()[: 1 + len(self.checked) + len(self.rules)]
        # a name of its own, as a plan may hold several
        return df.observe(f"as_read_{uuid.uuid4().hex}", *counts)

    def measured(self) -> Measured:
        """Run the scan now and go on, on the driver, from its one row of measures."""
        row = self.measures.first()
        missing = [row[f"missing_{i}"] for i in range(len(self.checked))]
        failed = [row[f"failed_{i}"] for i in range(len(self.rules))]
        found = zip(self._about(), [*missing, *failed], strict=True)
        return Measured(
            [(self.table_name, *about, row["rows"], value) for about, value in found],
            [
                (self.table_name, name, row["rows"], self.column_count)
                + tuple(None if v is None else float(v) for v in (row[f"min_{i}"], row[f"max_{i}"], row[f"avg_{i}"]))
                + (row[f"present_{i}"],)
                for i, name in enumerate(self.profiled)
            ],
        )

    def _about(self) -> list[tuple[str | None, ...]]:
        """Type, name, column and rule of every check on the columns and rows."""
        about = [("completeness", None, f.name, None) for f in self.checked]
        return about + [(r.check_type, r.name, r.column_name, r.text) for r in self.rules]

    def results(self, table_rules: Iterable[Rule] = ()) -> DataFrame:
        """One row per checked column, one per rule, and one per rule on the table as a whole.

        A table rule is a condition or a count over the measures, such as the number of ``rows``;
        a true condition counts as one failed record.
        """
        table_rules = list(table_rules)
        about = [*self._about(), *((r.check_type, r.name, r.column_name, r.text) for r in table_rules)]
        counts = [F.col(f"missing_{i}") for i in range(len(self.checked))]
        counts += [F.col(f"failed_{i}") for i in range(len(self.rules))]
        counts += [r.failed.cast("bigint") for r in table_rules]

        names = ["check_type", "check_name", "column_name", "rule"]
        rows = _unfold(self.measures, names, about, "bigint", counts)
        return _check_rows(rows.withColumn("table_name", F.lit(self.table_name)))

    def profile(self) -> DataFrame:
        """Long form: one row per numeric column, values as double."""
        about = [(name,) for name in self.profiled]
        value_type = "struct<min:double,max:double,avg:double,present:bigint>"
        values = [
            F.struct(f"min_{i}", f"max_{i}", f"avg_{i}", f"present_{i}").cast(value_type)
            for i in range(len(self.profiled))
        ]
        rows = _unfold(self.measures, ["column_name"], about, value_type, values)
        long = rows.select(
            F.lit(self.table_name).alias("table_name"),
            "column_name",
            F.col("rows").alias("total_records"),
            F.lit(self.column_count).alias("column_count"),
            F.col("value.min").alias("min_val"),
            F.col("value.max").alias("max_val"),
            F.col("value.avg").alias("avg_val"),
            F.col("value.present").alias("non_null_count"),
        )
        return long.to(profile_schema()).withColumn("profiled_at", F.current_timestamp())

    def wide_profile(self) -> DataFrame:
        """One row per table with ``<column>_min/_max/_avg/_non_null_count`` in native types."""
        columns = [
            F.lit(self.table_name).alias("table_name"),
            F.col("rows").alias("total_records"),
            F.lit(self.column_count).alias("column_count"),
            F.current_timestamp().alias("timestamp"),
        ]
        for i, name in enumerate(self.profiled):
            columns += [
                F.col(f"min_{i}").alias(f"{name}_min"),
                F.col(f"max_{i}").alias(f"{name}_max"),
                F.col(f"avg_{i}").alias(f"{name}_avg"),
                F.col(f"present_{i}").alias(f"{name}_non_null_count"),
            ]
        return self.measures.select(*columns)


def _unfold(
    measures: DataFrame,
    names: Sequence[str],
    about: Sequence[tuple[str | None, ...]],
    value_type: str,
    values: Sequence[Column | str],
) -> DataFrame:
    """One row per value: ``rows``, ``value``, and its description in the named text columns.

    The descriptions go into the plan as one constant, so a table with hundreds of columns
    still gets a small plan.
    """
    text = json.dumps([dict(zip(names, described, strict=True)) for described in about])
    fields = ",".join(f"{name}:string" for name in names)
    descriptions = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    found = F.array(*values).cast(f"array<{value_type}>")
    pairs = F.arrays_zip(descriptions.alias("about"), found.alias("value"))
    return measures.select("rows", F.inline(pairs)).select("rows", "about.*", "value")


def _check_rows(found: DataFrame) -> DataFrame:
    """Check rows from table_name, the description of each check, ``rows`` and the ``value`` counted."""
    total, count = F.col("rows"), F.col("value")
    complete = F.col("check_type") == "completeness"
    return found.select(
        "table_name",
        "check_type",
        "check_name",
        "column_name",
        "rule",
        F.when(complete, total).alias("total_records"),
        F.when(complete, count).alias("null_count"),
        F.when(~complete, count).alias("failed_records"),
        F.when(complete, completeness_rate(total, count)).alias("completeness_rate"),
    ).to(check_schema())


FOUND = "table_name string, check_type string, check_name string, column_name string, rule string, rows long, value long"


@dataclass(frozen=True)
class Measured:
    """The counts and profiles of an audit that has run: a few rows for each column and rule."""

    counts: list[tuple]
    profiles: list[tuple]


def measured_results(spark: SparkSession, audits: Sequence[Measured]) -> DataFrame:
    """The check rows of several audits as one small table, whose plan does not grow with them."""
    return _check_rows(spark.createDataFrame([c for a in audits for c in a.counts], FOUND))


def measured_profiles(spark: SparkSession, audits: Sequence[Measured]) -> DataFrame:
    rows = [p for a in audits for p in a.profiles]
    return spark.createDataFrame(rows, profile_schema()).withColumn("profiled_at", F.current_timestamp())


def check_rules(df: DataFrame, rules: Iterable[Rule], table_name: str = "unknown") -> DataFrame:
    """Rows that fail each rule, all rules in one pass."""
    return TableAudit(df, table_name, rules, completeness=False, profile=False).results()


def check_data_completeness(df: DataFrame, table_name: str = "unknown") -> DataFrame:
    return TableAudit(df, table_name, profile=False).results()


def check_data_validity(
    df: DataFrame, table_name: str = "unknown", as_of: str | datetime | Column | None = None
) -> DataFrame:
    return check_rules(df, sales_validity(as_of), table_name)


def check_data_consistency(
    df: DataFrame, table_name: str = "unknown", tolerance: float = 0.01
) -> DataFrame:
    return check_rules(df, [amount_agrees(tolerance)], table_name)


def generate_data_profile(df: DataFrame, table_name: str = "unknown") -> DataFrame:
    return TableAudit(df, table_name, completeness=False).profile()
