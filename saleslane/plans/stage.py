"""Row counts of the stages of a run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from saleslane.schema import stage_metric_schema


@dataclass(frozen=True)
class StageMetrics:
    stage: str
    output: str
    rows_in: int | None
    rows_out: int
    date: str
    filters: bool = True
    rows_malformed: int | None = None

    @property
    def rows_rejected(self) -> int | None:
        """Rows dropped by the stage; null for outputs that group rows."""
        return self.rows_in - self.rows_out if self.filters else None


def metrics_table(spark: SparkSession, metrics: Iterable[StageMetrics]) -> DataFrame:
    """The counts of one run as a table, one row per written output."""
    rows = [
        (m.stage, m.output, m.rows_in, m.rows_out, m.rows_rejected, m.rows_malformed, m.date)
        for m in metrics
    ]
    return spark.createDataFrame(rows, stage_metric_schema())
