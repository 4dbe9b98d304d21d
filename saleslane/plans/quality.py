"""Quality job: check the transformed tables, save report and profiles, stop bad runs."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslane.operators.audit import Measured, measured_profiles, measured_results
from saleslane.operators.integrity import check_referential_integrity
from saleslane.operators.report import (
    audit_table,
    failed_checks,
    is_critical,
    is_failed,
    stamp,
    union_checks,
    unreadable_dataset,
)
from saleslane.operators.summaries import SUMMARIES
from saleslane.plans.transformation import TRANSFORMED, known_schemas
from saleslane.schema import check_schema, quality_results_schema
from saleslane.session import PARQUET_TARGET, shuffles_sized_for, side_by_side
from saleslane.sources.publish import Publication
from saleslane.sources.sinks import write_report_version
from saleslane.sources.tables import read_layer

log = logging.getLogger(__name__)

DATASETS = (TRANSFORMED, *(summary.name for summary in SUMMARIES))


# Error conditions of a table that is absent or broken; any other error ends the job.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER")


class QualityFailure(RuntimeError):
    """Critical checks failed, or a table could not be checked."""


class CriticalFailure(QualityFailure):
    """Critical checks failed; the report is saved, and the same tables give it again."""


def is_unreadable(error: Exception) -> bool:
    """Whether a table cannot be read, as against a job that failed or lost its executors."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    text = condition or str(error)
    return any(name in text for name in UNREADABLE)


@dataclass
class Checked:
    """What was found in one dataset; without an audit it could not be read."""

    name: str
    audit: Measured | None = None
    duplicates: Sequence[Row] = ()


def audit_datasets(
    spark: SparkSession, input_path: str, as_of=None, schema: StructType | None = None
) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Check rows of all datasets, the profiles of those that could be checked, and the other names.

    The datasets are scanned side by side, each once, and their rows of measures kept on the driver: an
    unreadable dataset does not hide the others, and writing two reports costs one scan.
    """
    schemas = known_schemas(schema, spark)

    def audited(own: SparkSession, name: str) -> Checked:
        try:
            df = read_layer(own, f"{input_path}/{name}", if_empty=lambda: schemas[name])
            audit = audit_table(df, name, as_of).measured()
            with shuffles_sized_for(df, PARQUET_TARGET):
                return Checked(name, audit, check_referential_integrity(df, name).collect())  # a row at most
        except (PySparkException, Py4JError) as error:
            if not is_unreadable(error):
                raise
            log.warning("could not check %s: %s", name, error)
            return Checked(name)

    found = side_by_side(spark, audited, DATASETS)
    audits = [x.audit for x in found if x.audit is not None]
    unreadable = [x.name for x in found if x.audit is None]
    duplicates = [tuple(row) for x in found for row in x.duplicates]
    checks = [unreadable_dataset(spark, name) for name in unreadable]
    if audits:
        checks.append(measured_results(spark, audits))
        checks.append(spark.createDataFrame(duplicates, check_schema()))
    return union_checks(checks), measured_profiles(spark, audits) if audits else None, unreadable


def gate(results: DataFrame) -> None:
    """Stop the run if any check failed critically."""
    counts = results.agg(
        F.count_if(is_failed()).alias("failed"), F.count_if(is_critical()).alias("critical")
    ).first()
    log.info("%d quality checks failed, %d of them critically", counts.failed, counts.critical)
    if counts.critical:
        raise CriticalFailure(f"Critical data quality issues found: {counts.critical} checks failed")


def run_quality(
    spark: SparkSession,
    input_path: str,
    date: str,
    as_of=None,
    allow_unreadable: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Check the four tables under ``input_path`` and return the failed checks.

    Report and profiles are published together, before the gate may stop the run. It stops on critical
    failures and on tables that could not be checked; ``allow_unreadable`` goes on without those,
    as long as one table could be checked. ``schema`` is the raw one where it is not the sales schema.
    """
    checks, profiles, unreadable = audit_datasets(spark, input_path, as_of, schema)
    results_path = f"{input_path}/quality_results"
    with Publication(spark, input_path) as out:
        write_report_version(stamp(checks, date), out, "quality_results")
        if profiles is not None:
            write_report_version(profiles, out, "data_profiles")
    if profiles is None:
        raise QualityFailure(f"no dataset under {input_path} could be checked")

    if unreadable and not allow_unreadable:
        raise QualityFailure(f"could not be checked: {', '.join(unreadable)}")
    results = read_layer(spark, results_path, quality_results_schema())
    gate(results)
    return failed_checks(results)
