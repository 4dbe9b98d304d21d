"""One query per operator, each over whole tables.

Sums of doubles depend on the order of addition, so the queries show money rounded to cents,
and averages as cents over rows. Both are exact, hence equal in any engine.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from contextlib import suppress
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.catalog.sales import (
    report_tables,
    sales_clean,
    sales_files,
    sales_lines,
    sales_raw,
    sales_totals,
    sales_transformed,
    scratch,
    table,
    wide_schema,
    write_sales_csv,
)
from saleslane.functions.rules import business_rule, castable, in_range, matches
from saleslane.jvm import Files, remove
from saleslane.operators.audit import (
    TableAudit,
    check_data_completeness,
    check_data_consistency,
    check_data_validity,
    check_rules,
    generate_data_profile,
    kept,
)
from saleslane.operators.clean import keep_usable_rows, usable_row
from saleslane.operators.enrich import add_customer_tier, add_customer_total
from saleslane.operators.history import KeyHistory
from saleslane.operators.integrity import (
    check_foreign_key,
    check_referential_integrity,
    check_uniqueness,
    orphan_keys,
    orphan_rows,
    repeated_rows,
    uniqueness_violations,
)
from saleslane.operators.missing import check_missing_pattern, missing_pattern
from saleslane.operators.precheck import check_input
from saleslane.operators.report import (
    critical_failures,
    failed_checks,
    quality_results,
    union_checks,
)
from saleslane.operators.running import merged_totals, partial_totals
from saleslane.operators.score import check_quality_score, quality_score, score_by_rules
from saleslane.operators.summaries import (
    CUSTOMER,
    DAILY,
    PRODUCT,
    Summary,
    customer_summary_of_lines,
    distinct_values,
)
from saleslane.plans.daily import run_day
from saleslane.plans.ingestion import run_ingestion
from saleslane.plans.ledger import fingerprint
from saleslane.plans.quality import QualityFailure
from saleslane.plans.stage import metrics_table
from saleslane.plans.transformation import run_transformation
from saleslane.session import PARQUET_TARGET, shuffles_sized_for
from saleslane.sources.sinks import write_layer
from saleslane.sources.tables import (
    count_mismatched_files,
    layer_path,
    read_layer,
    read_rejected,
    read_sales_csv,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed dates: the report is taken as of the first, and stamped with the second.
AS_OF = "2026-01-01 00:00:00"
PROCESSING_DATE = "2026-01-01"
# Fixed years: the last ones of the first two days, where sales are dealt into three.
LAST_YEARS = (1994, 1997)
URL_PATTERN = "^https://[a-z0-9.-]+/"
LINE_KEY = ["l_orderkey", "l_linenumber"]
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def cents(column: str) -> Column:
    return F.round(column, 2).alias(column)


def exact_average(average: str, rows: str) -> Column:
    """The average as cents over ``rows``, the number of values that went into it."""
    return (F.round(F.col(average) * F.col(rows), 2) / F.col(rows)).alias(average)


def counting(summary: Summary, average: str) -> Summary:
    """The summary with the number of values behind its average as ``_values``."""
    _, column = summary.measures[average]
    return replace(summary, measures={**summary.measures, "_values": ("count", column)})


def shown(df: DataFrame, **replaced: Column) -> DataFrame:
    return df.withColumns(replaced)


# --- scans, filters, projections ---------------------------------------------------------


@query("scan_sales")
def scan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_raw(spark, sf_dir)


@query("clean_sales")
def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_clean(spark, sf_dir)


@query("valid_keys_and_quantity")
def valid_keys_and_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_usable_rows(sales_raw(spark, sf_dir), positive=["quantity"])


@query("line_amount")
def line_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir).select("id", "quantity", "price", "total_amount")


@query("date_parts")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir).select("id", "transaction_date", "year", "month", "day")


@query("distinct_customers")
def distinct_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(sales_raw(spark, sf_dir), "customer_id")


# --- totals and tiers ----------------------------------------------------------------------


@query("customer_total_spent")
def customer_total_spent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(sales_totals(spark, sf_dir), customer_total_spent=cents("customer_total_spent"))


@query("customer_tier")
def customer_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = add_customer_tier(sales_totals(spark, sf_dir))
    return tiers.select("id", "customer_id", "customer_category")


@query("transformed_sales")
def transformed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    transformed = sales_transformed(spark, sf_dir)
    return shown(transformed, customer_total_spent=cents("customer_total_spent"))


# --- summaries -------------------------------------------------------------------------------


def daily(lines: DataFrame) -> DataFrame:
    average = "avg_transaction_amount"
    return shown(
        counting(DAILY, average).of(lines),
        daily_revenue=cents("daily_revenue"),
        avg_transaction_amount=exact_average(average, "_values"),
    ).drop("_values")


def by_customer(df: DataFrame) -> DataFrame:
    average = "avg_transaction_amount"
    return shown(
        df, total_spent=cents("total_spent"), avg_transaction_amount=exact_average(average, "_values")
    ).drop("_values")


def by_product(lines: DataFrame) -> DataFrame:
    return shown(
        counting(PRODUCT, "avg_price").of(lines),
        total_revenue=cents("total_revenue"),
        avg_price=exact_average("avg_price", "_values"),
    ).drop("_values")


@query("daily_sales_summary")
def daily_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(sales_lines(spark, sf_dir))


@query("customer_summary")
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = counting(CUSTOMER, "avg_transaction_amount")
    return by_customer(customer_summary_of_lines(sales_lines(spark, sf_dir), summary=summary))


@query("customer_summary_of_fact")
def customer_summary_of_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = counting(CUSTOMER, "avg_transaction_amount")
    return by_customer(summary.of(sales_transformed(spark, sf_dir)))


@query("product_summary")
def product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_product(sales_lines(spark, sf_dir))


# --- checks of one table ----------------------------------------------------------------------


@query("completeness")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_data_completeness(sales_raw(spark, sf_dir), "sales_raw")


@query("completeness_by_table")
def completeness_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_checks([check_data_completeness(table(spark, sf_dir, n), n) for n in TABLES])


@query("validity_checks")
def validity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_data_validity(sales_raw(spark, sf_dir), "sales_raw", AS_OF)


@query("consistency_check")
def consistency_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 151st id carries an amount that is five cents off."""
    off = F.when(F.col("id") % 151 == 0, 0.05).otherwise(0.0)
    sales = sales_lines(spark, sf_dir).withColumn("total_amount", F.col("total_amount") + off)
    return check_data_consistency(sales, "transformed_sales")


@query("duplicate_ids")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_referential_integrity(sales_raw(spark, sf_dir), "sales_raw")


@query("numeric_profile")
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tables, every numeric column, averages included."""
    tables = report_tables(spark, sf_dir)
    profiles = [generate_data_profile(df, name) for name, df in tables.items()]
    return shown(
        reduce(DataFrame.unionByName, profiles),
        min_val=cents("min_val"),
        max_val=cents("max_val"),
        avg_val=exact_average("avg_val", "non_null_count"),
    ).drop("profiled_at")


@query("wide_profile")
def wide_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = TableAudit(sales_raw(spark, sf_dir), "sales_raw", completeness=False)
    return shown(
        audit.wide_profile(), price_avg=exact_average("price_avg", "price_non_null_count")
    ).drop("timestamp")


@query("type_validation")
def type_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("l_orderkey") % 151 == 0, "bad").otherwise(
        F.col("l_linenumber").cast("string")
    )
    lines = table(spark, sf_dir, "lineitem").select(text.alias("line_text"))
    return check_rules(lines, [castable("line_text", "int")], "lineitem")


@query("range_check")
def range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [in_range("l_quantity", 1, 45), in_range("l_discount", high=0.08)]
    return check_rules(table(spark, sf_dir, "lineitem"), rules, "lineitem")


@query("format_check")
def format_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_rules(table(spark, sf_dir, "pages"), [matches("url", URL_PATTERN)], "pages")


@query("business_rules")
def business_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sales_lines(spark, sf_dir)
    rules = [
        business_rule(
            "bulk_has_category",
            (F.col("quantity") >= 40) & (F.col("category") == "UNKNOWN"),
            "lines of 40 pieces or more have a category",
            ["quantity", "category"],
        ),
        business_rule(
            "amount_covers_price",
            F.col("total_amount") < F.col("price"),
            "total_amount >= price",
            ["total_amount", "price"],
        ),
        business_rule(
            "region_has_date",
            (F.col("region") != "UNKNOWN") & F.col("transaction_date").isNull(),
            "lines with a region have a date",
            ["region", "transaction_date"],
        ),
    ]
    return check_rules(sales, rules, "transformed_sales")


@query("missing_pattern_check")
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_missing_pattern(sales_raw(spark, sf_dir), "sales_raw")


@query("missing_pattern")
def missing_pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_pattern(sales_raw(spark, sf_dir))


@query("quality_score_check")
def quality_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_quality_score(sales_raw(spark, sf_dir), usable_row(), "sales_raw")


@query("quality_score")
def quality_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_score(sales_raw(spark, sf_dir), usable_row(), "sales_raw")


@query("quality_score_by_rules")
def quality_score_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [in_range("l_quantity", 1, 45), in_range("l_discount", high=0.08)]
    return score_by_rules(table(spark, sf_dir, "lineitem"), rules, "lineitem")


# --- checks across rows and tables -------------------------------------------------------------


def paying_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return customers.select(
        F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("known_id")
    )


@query("referential_integrity")
def referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_foreign_key(
        sales_raw(spark, sf_dir),
        paying_customers(spark, sf_dir),
        ["customer_id"],
        ["known_id"],
        "sales_raw",
        "customer",
    )


@query("orphan_customers")
def orphan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = paying_customers(spark, sf_dir)
    return orphan_keys(sales_raw(spark, sf_dir), known, ["customer_id"], ["known_id"])


@query("orphan_rows")
def orphan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined twice, once for the keys; few keys meet the lines without a shuffle of those."""
    known = paying_customers(spark, sf_dir)

    def store(keys: DataFrame) -> DataFrame:
        return joined_once(keys, sf_dir, scratch(spark, "orphans"))

    return orphan_rows(sales_raw(spark, sf_dir), known, ["customer_id"], ["known_id"], store=store)


@query("repeated_rows")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of a part that the same supplier delivers again on the same day."""
    keys = ["l_partkey", "l_suppkey", "l_shipdate"]
    return repeated_rows(table(spark, sf_dir, "lineitem"), keys)


@query("uniqueness_check")
def uniqueness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_uniqueness(table(spark, sf_dir, "lineitem"), LINE_KEY, "lineitem")


@query("uniqueness_violations")
def uniqueness_violation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniqueness_violations(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query("input_precheck")
def input_precheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sales_files(spark, sf_dir, "precheck")
    raw = read_sales_csv(spark, path, wide_schema())
    bad_files = count_mismatched_files(spark, path)
    checks = kept(check_input(raw, "sales_raw", bad_files=bad_files))
    remove(spark, path)
    return checks


# --- the report and its gates -------------------------------------------------------------------


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = report_tables(spark, sf_dir)
    return quality_results(tables, PROCESSING_DATE, AS_OF).drop("check_timestamp")


@query("quality_results")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir)


@query("failed_checks")
def failed_report_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_checks(report(spark, sf_dir))


@query("critical_failures")
def critical_report_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return critical_failures(report(spark, sf_dir))


# --- through the files ------------------------------------------------------------------------


def without_zone(df: DataFrame) -> DataFrame:
    """Times as the test tables have them."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


@query("scan_sales_csv")
def scan_sales_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales written as CSV and read with the fixed schema."""
    path = sales_files(spark, sf_dir, "scan")
    return without_zone(read_sales_csv(spark, path, wide_schema()))


@query("layer_round_trip")
def layer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned layer as ingestion writes it by region, read back."""
    raw = sales_files(spark, sf_dir, "layer")
    layer = f"{scratch(spark, 'layer')}/processed"
    run_ingestion(spark, raw, layer, PROCESSING_DATE, schema=wide_schema())
    return without_zone(read_layer(spark, layer).drop("processed_at"))


@query("stage_row_counts")
def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the jobs count on their writes, from CSV files to the four tables."""
    raw = sales_files(spark, sf_dir, "counts")
    layers = [f"{scratch(spark, 'counts')}/{name}" for name in ("processed", "transformed")]
    schema = wide_schema()
    done = run_ingestion(spark, raw, layers[0], PROCESSING_DATE, schema=schema)
    done += run_transformation(spark, *layers, PROCESSING_DATE, schema=schema)
    for path in (raw, *layers):
        remove(spark, path)
    return metrics_table(spark, done)


# --- what the jobs of a day write, read back -----------------------------------------------------


def day_of(spark: SparkSession, sf_dir: str, stages: Sequence[str]) -> str:
    """The folder of a day that has run over the sales: the stages that have not finished are run.

    The folder is named after the files of the tables, so other tables are another day. Its files stay.
    """
    names = ("lineitem", "orders", "part", "supplier", "nation", "region")
    marks = [sf_dir, *(fingerprint(spark, f"{sf_dir}/{name}.parquet") for name in names)]
    base = scratch(spark, f"day-{hashlib.md5(json.dumps(marks).encode()).hexdigest()}")
    raw = layer_path(base, "raw", PROCESSING_DATE)
    files = Files.of(spark, base)
    if files is None or not files.exists(f"{raw}/_SUCCESS"):
        write_sales_csv(spark, sf_dir, raw)
    # ids are unique on purpose only in part, so the gate stops the run; the reports are written by then
    with suppress(QualityFailure):
        run_day(
            spark, base, PROCESSING_DATE, stages, as_of=AS_OF, schema=wide_schema(), keep_rejected=True
        )
    return base


def written(spark: SparkSession, sf_dir: str, name: str, quality: bool = False) -> DataFrame:
    """One of the transformed tables, or of the reports about them, as the jobs have written it."""
    stages = ("ingestion", "transformation", "quality") if quality else ("ingestion", "transformation")
    base = day_of(spark, sf_dir, stages)
    df = read_layer(spark, f"{layer_path(base, 'transformed', PROCESSING_DATE)}/{name}")
    stamps = ("processed_at", "check_timestamp", "profiled_at")
    return without_zone(df.drop(*stamps))


@query("job_fact")
def job_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = written(spark, sf_dir, "transformed_sales")
    return shown(fact, customer_total_spent=cents("customer_total_spent"))


@query("job_daily_summary")
def job_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = "avg_transaction_amount"
    return shown(
        written(spark, sf_dir, DAILY.name),
        daily_revenue=cents("daily_revenue"),
        avg_transaction_amount=exact_average(average, "daily_transactions"),
    )


@query("job_customer_summary")
def job_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = "avg_transaction_amount"
    return shown(
        written(spark, sf_dir, CUSTOMER.name),
        total_spent=cents("total_spent"),
        avg_transaction_amount=exact_average(average, "total_transactions"),
    )


@query("job_product_summary")
def job_product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        written(spark, sf_dir, PRODUCT.name),
        total_revenue=cents("total_revenue"),
        avg_price=exact_average("avg_price", "total_orders"),
    )


@query("job_report")
def job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "quality_results", quality=True)


@query("job_profiles")
def job_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        written(spark, sf_dir, "data_profiles", quality=True),
        min_val=cents("min_val"),
        max_val=cents("max_val"),
        avg_val=exact_average("avg_val", "non_null_count"),
    )


@query("rejected_lines")
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that ingestion has rejected, taken apart again, and why."""
    base = day_of(spark, sf_dir, ["ingestion"])
    lines = read_rejected(spark, layer_path(base, "rejected", PROCESSING_DATE))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wide_schema())
    rows = lines.select(F.from_csv("line", ddl).alias("line"), F.array_join("reasons", "; ").alias("reasons"))
    return without_zone(rows.select("line.*", "reasons"))


# --- several days -----------------------------------------------------------------------------


def with_day(lines: DataFrame) -> DataFrame:
    """Three days, each some years of orders; sales without a date come with the last."""
    year = F.year("transaction_date")
    day = F.when(year <= LAST_YEARS[0], 1).when(year <= LAST_YEARS[1], 2).otherwise(3)
    return lines.withColumn("sales_day", day)


def joined_once(lines: DataFrame, sf_dir: str, path: str) -> DataFrame:
    """The lines as a table of their own: several readers do not join and shuffle the order lines each."""
    spark = lines.sparkSession
    with shuffles_sized_for(table(spark, sf_dir, "lineitem"), PARQUET_TARGET):
        lines.write.mode("overwrite").parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


@query("running_customer_tier")
def running_customer_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and tiers day by day: each day from its own rows and the totals up to the day before."""
    folder = scratch(spark, "running")
    lines = with_day(sales_lines(spark, sf_dir)).select("id", "customer_id", "total_amount", "sales_day")
    lines = joined_once(lines, sf_dir, f"{folder}/lines")
    days, earlier = [], None
    for day in (1, 2, 3):
        today = lines.where(F.col("sales_day") == day)
        days.append(add_customer_tier(add_customer_total(today, earlier)))
        totals = partial_totals(today, "customer_id", "total_amount")
        with shuffles_sized_for(lines, PARQUET_TARGET):
            write_layer(totals if earlier is None else merged_totals([earlier, totals]), f"{folder}/{day}")
        earlier = read_layer(spark, f"{folder}/{day}")
    return shown(
        reduce(DataFrame.unionByName, days), customer_total_spent=cents("customer_total_spent")
    ).drop("total_amount")


@query("duplicate_ids_over_days")
def duplicate_ids_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day brings its sales, and every 97th of the day before once more."""
    folder = scratch(spark, "ids")
    remove(spark, folder)
    lines = with_day(sales_raw(spark, sf_dir)).select("id", "sales_day")
    # not below the history, which reads all that is in its folder
    kept_lines = scratch(spark, "ids-lines")
    lines = joined_once(lines, sf_dir, kept_lines)
    history, checks = KeyHistory(spark, folder), []
    for day in (1, 2, 3):
        again = lines.where((F.col("sales_day") == day - 1) & (F.col("id") % 97 == 0))
        with shuffles_sized_for(lines, PARQUET_TARGET):
            history.record(lines.where(F.col("sales_day") == day).unionByName(again), str(day))
        checks.append(history.check(str(day), f"sales_day_{day}"))
    remove(spark, folder)
    remove(spark, kept_lines)
    return union_checks(checks)
