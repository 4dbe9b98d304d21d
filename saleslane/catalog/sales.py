"""The sales table, mapped from the retail test tables with deterministic defects."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from saleslane.operators.clean import clean_data
from saleslane.operators.enrich import (
    add_customer_total,
    add_line_facts,
    transform_sales_data,
)
from saleslane.operators.summaries import CUSTOMER, DAILY, PRODUCT, customer_summary_of_lines
from saleslane.schema import define_schema
from saleslane.session import PARQUET_TARGET, shared_folder, shuffles_sized_for

# Sales in one CSV file: some 40 MB of text. A file is read by one task, so small ones keep all tasks busy.
ROWS_IN_FILE = 500_000
# Fast compression: most of its time goes into the last tenth or two of the bytes.
GZIP_LEVEL = ("zlib.compress.level", "BEST_SPEED")

_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its footer is read for the schema once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def every(number: int, *columns: str) -> Column:
    """True where the sum of the columns is a multiple of ``number``."""
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return total % number == 0


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per order line. Spark picks the joins by size; nothing is forced."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    list_price = F.floor("p_retailprice")
    order_date = F.col("o_orderdate")
    # when() without otherwise() leaves null: the defects are missing, zero, negative or late
    return lines.select(
        # bigint: order keys of large tables do not fit the int of the CSV schema
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when(
            ~every(101, "l_orderkey", "l_linenumber"),
            F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")),
        ).alias("customer_id"),
        F.when(
            ~every(103, "l_orderkey", "l_partkey"),
            F.concat(F.lit("PROD"), F.col("l_partkey").cast("string")),
        ).alias("product_id"),
        F.when(every(107, "l_orderkey", "l_suppkey"), -F.col("l_quantity"))
        .when(every(109, "l_orderkey", "l_suppkey"), 0)
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("quantity"),
        F.when(every(113, "l_orderkey", "l_partkey"), -list_price / 100)
        .when(~every(127, "l_orderkey", "l_partkey"), list_price / 100)
        .alias("price"),
        F.when(
            every(131, "l_orderkey", "l_linenumber"),
            order_date + F.make_interval(years=F.lit(100)),
        )
        .when(~every(137, "l_orderkey", "l_linenumber"), order_date)
        .alias("transaction_date"),
        F.when(~every(139, "l_partkey"), F.col("p_type")).alias("category"),
        F.when(~every(149, "l_orderkey", "l_suppkey"), F.col("r_name")).alias("region"),
    )


def sales_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned sales without the time of processing, which no other engine can reproduce."""
    return clean_data(sales_raw(spark, sf_dir)).drop("processed_at")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned sales with amount and date parts; needs no shuffle beyond the source joins."""
    return add_line_facts(sales_clean(spark, sf_dir))


def sales_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts and customer totals only; the totals are aggregated before they meet the lines."""
    lines = sales_lines(spark, sf_dir).select("id", "customer_id", "total_amount")
    return add_customer_total(lines)


def sales_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_sales_data(sales_clean(spark, sf_dir))


def report_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The fact and its summaries, each by the plan that reads least.

    Only the fact needs the totals on its rows: the summaries come from the lines, and the customer
    summary takes its tier from its own groups.
    """
    lines = sales_lines(spark, sf_dir)
    return {
        "transformed_sales": sales_transformed(spark, sf_dir),
        DAILY.name: DAILY.of(lines),
        CUSTOMER.name: customer_summary_of_lines(lines),
        PRODUCT.name: PRODUCT.of(lines),
    }


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for queries that write: in the session's checkpoint folder, which executors share.

    Each run of a query replaces what the last one wrote there. A session that runs in one process
    may do without such a folder; then a temporary one is made once.
    """
    shared = shared_folder(spark)
    if shared is None:
        if not spark.conf.get("spark.master").startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/saleslane-{name}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="saleslane-")


def sales_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The raw sales as CSV files with a header each, as the daily job finds them."""
    path = f"{scratch(spark, name)}/raw"
    write_sales_csv(spark, sf_dir, path)
    return path


def write_sales_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The raw sales as compressed CSV. Such a file is read by one task, so its rows are bounded."""
    with shuffles_sized_for(table(spark, sf_dir, "lineitem"), PARQUET_TARGET):
        writer = sales_raw(spark, sf_dir).write.mode("overwrite").option(*GZIP_LEVEL)
        writer.option("maxRecordsPerFile", ROWS_IN_FILE).csv(path, header=True, compression="gzip")


def wide_schema() -> StructType:
    """The sales schema with ids that hold the order keys of large tables."""
    fields = [
        StructField(f.name, LongType()) if f.name == "id" else f for f in define_schema().fields
    ]
    return StructType(fields)
