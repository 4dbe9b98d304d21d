"""A daily run over all test sales, from CSV files to the reports, against SQL on the same tables."""

import os

import pytest
from conftest import TESTDATA
from oracle_compare import connect, differences
from pyspark.sql import functions as F

from saleslane.catalog.oracle import check, completeness, duplicates, sales_query, union
from saleslane.catalog.queries import cents, exact_average
from saleslane.catalog.sales import sales_clean, sales_raw
from saleslane.operators.enrich import transform_sales_data
from saleslane.plans.daily import run_day
from saleslane.plans.quality import QualityFailure
from saleslane.sources.tables import layer_path, read_layer

DATE = "2026-01-01"


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("sales"))
    raw = sales_raw(spark, sf_dir)
    raw.repartition(3).write.csv(layer_path(base, "raw", DATE), header=True)
    counts = run_day(spark, base, DATE, ["ingestion", "transformation"]).collect()
    with pytest.raises(QualityFailure, match="2 checks failed"):
        run_day(spark, base, DATE, ["quality"], as_of=f"{DATE} 00:00:00")
    return base, counts


def layer(spark, run, name):
    df = read_layer(spark, f"{layer_path(run[0], 'transformed', DATE)}/{name}")
    stamps = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def test_row_counts(run):
    assert [(x.output, x.rows_in, x.rows_out, x.rows_rejected) for x in run[1]] == [
        ("processed", 60000, 56830, 3170),
        ("transformed_sales", 56830, 56830, 0),
        ("daily_sales_summary", 56830, 12224, None),
        ("customer_summary", 56830, 7743, None),
        ("product_summary", 56830, 10245, None),
    ]


def test_fact(spark, run, con):
    fact = layer(spark, run, "transformed_sales").drop("processed_at")
    shown = fact.withColumn("customer_total_spent", cents("customer_total_spent"))
    assert differences(shown, con, sales_query("SELECT * FROM transformed_sales")) is None


@pytest.mark.parametrize(
    "name, money, average, rows",
    [
        ("daily_sales_summary", "daily_revenue", "avg_transaction_amount", "daily_transactions"),
        ("customer_summary", "total_spent", "avg_transaction_amount", "total_transactions"),
        ("product_summary", "total_revenue", "avg_price", "total_orders"),
    ],
)
def test_summaries(spark, run, con, name, money, average, rows):
    shown = layer(spark, run, name).withColumns(
        {money: cents(money), average: exact_average(average, rows)}
    )
    assert differences(shown, con, sales_query(f"SELECT * FROM {name}")) is None


def test_report(spark, run, con):
    report = layer(spark, run, "quality_results")
    kept = report.drop("check_timestamp", "processing_date").where(
        "check_type in ('completeness', 'integrity') and coalesce(column_name, '') <> 'processed_at'"
    )
    tables = ("transformed_sales", "daily_sales_summary", "customer_summary", "product_summary")
    expected = [
        completeness(table, [c for c in columns_of(report, table) if c != "processed_at"])
        for table in tables
    ]
    expected.append(duplicates("transformed_sales"))
    assert differences(kept, con, sales_query(union(expected))) is None
    assert {x.processing_date for x in report.select("processing_date").collect()} == {DATE}
    late = report.where("check_name = 'future_transaction_date'").first().failed_records
    late_sql = check(
        "transformed_sales", "t", "validity",
        failed=f"count(CASE WHEN transaction_date > TIMESTAMP '{DATE}' THEN 1 END)",
    )
    assert con.execute(sales_query(late_sql)).fetchdf().failed_records[0] == late > 100


def columns_of(report, table):
    names = report.where(F.col("table_name") == table).where("check_type = 'completeness'")
    return [x.column_name for x in names.collect()]


def test_profiles(spark, run):
    profiles = layer(spark, run, "data_profiles")
    tables = {x.table_name: x["count"] for x in profiles.groupBy("table_name").count().collect()}
    assert tables == {
        "transformed_sales": 8, "daily_sales_summary": 6, "customer_summary": 3,
        "product_summary": 4,
    }


def test_run_on_the_larger_tables(spark, tmp_path):
    """There some customers' totals lie at a bound of the tiers; query and job agree with SQL."""
    folder = f"{TESTDATA}/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip(f"no test tables in {folder}")
    base = str(tmp_path)
    sales_raw(spark, folder).write.csv(layer_path(base, "raw", DATE), header=True)
    run_day(spark, base, DATE, ["ingestion", "transformation"])
    fact = read_layer(spark, f"{layer_path(base, 'transformed', DATE)}/transformed_sales")
    counts = fact.groupBy("customer_category").count().collect()
    sql = "SELECT customer_category, count(*) FROM transformed_sales GROUP BY 1"
    expected = connect(folder).execute(sales_query(sql)).fetchall()
    assert sorted(tuple(r) for r in counts) == sorted(expected)


@pytest.mark.parametrize("limits", [
        {"heavy_rows": 45, "heavy_share": 1e-4},
        {"heavy_rows": 1, "heavy_share": 8e-4},
    ],
)
def test_heavy_customers_give_the_same_totals(spark, sf_dir, con, limits):
    totals = transform_sales_data(sales_clean(spark, sf_dir), money_scale=2, **limits)
    shown = totals.withColumn("customer_total_spent", cents("customer_total_spent"))
    assert differences(shown, con, sales_query("SELECT * FROM transformed_sales")) is None
