"""Sales ETL and data-quality checks as ordinary Spark DataFrame operators."""

from saleslane.operators.audit import (
    TableAudit,
    check_data_completeness,
    check_data_consistency,
    check_data_validity,
    check_rules,
    generate_data_profile,
)
from saleslane.operators.clean import clean_data
from saleslane.operators.enrich import transform_sales_data
from saleslane.operators.integrity import (
    check_foreign_key,
    check_referential_integrity,
    check_uniqueness,
    uniqueness_violations,
)
from saleslane.operators.missing import missing_pattern
from saleslane.operators.report import critical_failures, failed_checks, quality_results
from saleslane.operators.score import quality_score
from saleslane.operators.summaries import create_aggregations
from saleslane.plans.daily import run_day
from saleslane.plans.ingestion import run_ingestion
from saleslane.plans.quality import run_quality
from saleslane.plans.transformation import run_transformation
from saleslane.schema import define_schema
from saleslane.session import create_spark_session

__all__ = [
    "TableAudit",
    "check_data_completeness",
    "check_data_consistency",
    "check_data_validity",
    "check_foreign_key",
    "check_referential_integrity",
    "check_rules",
    "check_uniqueness",
    "clean_data",
    "create_aggregations",
    "create_spark_session",
    "critical_failures",
    "define_schema",
    "failed_checks",
    "generate_data_profile",
    "missing_pattern",
    "quality_results",
    "quality_score",
    "run_day",
    "run_ingestion",
    "run_quality",
    "run_transformation",
    "transform_sales_data",
    "uniqueness_violations",
]
