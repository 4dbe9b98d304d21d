"""Table schemas: the sales input and the report tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names, order and types of the sales table.
SALES_COLUMNS = {
    "id": "integer",
    "customer_id": "string",
    "product_id": "string",
    "quantity": "integer",
    "price": "double",
    "transaction_date": "timestamp",
    "category": "string",
    "region": "string",
}

# Columns of one quality check row. A key that a check does not use is null.
CHECK_COLUMNS = {
    "table_name": "string",
    "check_type": "string",
    "check_name": "string",
    "column_name": "string",
    "rule": "string",
    "total_records": "long",
    "null_count": "long",
    "failed_records": "long",
    "completeness_rate": "double",
}
STAMP_COLUMNS = {"check_timestamp": "timestamp", "processing_date": "string"}

# Columns of one profiled column in the long form.
PROFILE_COLUMNS = {
    "table_name": "string",
    "column_name": "string",
    "total_records": "long",
    "column_count": "integer",
    "min_val": "double",
    "max_val": "double",
    "avg_val": "double",
    "non_null_count": "long",
}

STAGE_METRIC_COLUMNS = {
    "stage": "string",
    "output": "string",
    "rows_in": "long",
    "rows_out": "long",
    "rows_rejected": "long",
    "rows_malformed": "long",
    "processing_date": "string",
}


def _nullable(columns: dict[str, str]) -> StructType:
    schema = StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name, nullable=True)
    return schema


def define_schema() -> StructType:
    """Schema of the sales input; every field is nullable."""
    return _nullable(SALES_COLUMNS)


def processed_schema(raw: StructType | None = None) -> StructType:
    """Columns of the cleaned layer; its partition column comes last."""
    fields = [f for f in raw or define_schema() if f.name != "region"]
    schema = StructType(fields).add("processed_at", "timestamp")
    return schema.add("region", "string")


def check_schema() -> StructType:
    return _nullable(CHECK_COLUMNS)


def quality_results_schema() -> StructType:
    return _nullable(CHECK_COLUMNS | STAMP_COLUMNS)


def profile_schema() -> StructType:
    return _nullable(PROFILE_COLUMNS)


def stage_metric_schema() -> StructType:
    return _nullable(STAGE_METRIC_COLUMNS)
