import math
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslane.functions.columns import spend_tier
from saleslane.operators.enrich import add_group_total, add_line_facts, transform_sales_data
from saleslane.operators.summaries import create_aggregations, customer_summary_of_lines


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_amount_and_date_parts(sample):
    rows = {r.id: r for r in transform_sales_data(sample).collect()}
    assert {i: r.total_amount for i, r in rows.items()} == pytest.approx(
        {11: 6.0, 12: 10.0, 13: 1.5, 14: 0.25, 15: 20.0}
    )
    assert [(r.year, r.month, r.day) for _, r in sorted(rows.items())] == [
        (2023, 3, 5), (2023, 3, 5), (2023, 3, 6), (2023, 4, 1), (2023, 4, 2)
    ]
    totals = {r.customer_id: r.customer_total_spent for r in rows.values()}
    assert totals == pytest.approx({"c1": 7.5, "c2": 30.0, "c3": 0.25})
    assert {r.customer_category for r in rows.values()} == {"Bronze"}


def test_column_order_and_types(sample):
    added = transform_sales_data(sample).dtypes[len(sample.columns) :]
    assert added == [
        ("total_amount", "double"),
        ("year", "int"),
        ("month", "int"),
        ("day", "int"),
        ("customer_total_spent", "double"),
        ("customer_category", "string"),
    ]


def test_null_date_gives_null_parts(sales):
    row = add_line_facts(sales([(1, "C", "P", 1, 1.0, None, "a", "b")])).first()
    assert (row.year, row.month, row.day) == (None, None, None)


def test_tier_bounds_are_strict(spark):
    totals = [10000.01, 10000.0, 5000.01, 5000.0, 1000.01, 1000.0, 0.0, None, float("nan")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(totals)], "i int, total double")
    tiers = [r[0] for r in df.orderBy("i").select(spend_tier(F.col("total"))).collect()]
    assert tiers == [
        "Premium", "Gold", "Gold", "Silver", "Silver", "Bronze", "Bronze", "Bronze", "Premium",
    ]


def test_tier_on_rounded_total(spark):
    df = spark.createDataFrame([(1000.0000000001,)], "total double")
    row = df.select(
        spend_tier(F.col("total"), money_scale=None).alias("raw"),
        spend_tier(F.col("total"), money_scale=2).alias("rounded"),
    ).first()
    assert (row.raw, row.rounded) == ("Silver", "Bronze")


def test_own_tiers(spark):
    df = spark.createDataFrame([(60.0,), (40.0,)], "total double")
    tiers = [r[0] for r in df.select(spend_tier(F.col("total"), [("Top", 50.0)], "Rest")).collect()]
    assert tiers == ["Top", "Rest"]


LIMITS = [
    {},  # no heavy customer
    {"heavy_rows": 2},  # some
    {"heavy_rows": 1},  # all
    {"heavy_rows": 1, "heavy_share": 0.3},  # those with a large share
    {"heavy_rows": 1, "heavy_share": 1.0},  # one that is the whole table
]


@pytest.mark.parametrize("limits", LIMITS)
def test_total_is_the_window_sum(spark, limits):
    rows = [("a", 1.0), ("a", 2.5), ("b", 4.0), (None, 8.0), (None, 0.5), ("c", None), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    result = add_group_total(df, "k", "v", "total", **limits).collect()
    expected = {"a": 3.5, "b": 4.0, None: 8.5, "c": None, "d": 1.0}
    assert sorted(map(repr, result)) == sorted(
        repr(r) for r in spark.createDataFrame(
            [(k, v, expected[k]) for k, v in rows], "k string, v double, total double"
        ).collect()
    )


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["a", "b", "", None]), st.integers(-5, 50)),
        min_size=1,
        max_size=40,
    ),
    limits=st.sampled_from(LIMITS),
)
def test_total_against_brute_force(spark, rows, limits):
    sums = defaultdict(int)
    for key, value in rows:
        sums[key] += value
    df = spark.createDataFrame(rows, "k string, v int")
    result = [tuple(r) for r in add_group_total(df, "k", "v", "total", **limits).collect()]
    expected = [(k, v, sums[k]) for k, v in rows]
    assert sorted(result, key=repr) == sorted(expected, key=repr)


def test_existing_total_is_replaced(spark):
    df = spark.createDataFrame([("a", 1.0, 99.0)], "k string, v double, total double")
    assert add_group_total(df, "k", "v", "total").collect() == [("a", 1.0, 1.0)]


def skewed(spark, tmp_path):
    """A third of the rows belongs to one customer, and all of them are copies."""
    path = str(tmp_path / "skewed")
    key = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 997))
    value = F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 7).cast("double")
    df = spark.range(0, 30000, numPartitions=6).select(key.alias("k"), value.alias("v"))
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_heavy_customer_is_not_shuffled(spark, tmp_path):
    df = skewed(spark, tmp_path)
    total = add_group_total(df, "k", "v", "total", heavy_rows=1000)
    rows = total.where("k = 'HOT'")
    assert rows.count() == 10000 and rows.select("total").distinct().collect() == [(20000.0,)]
    assert total.count() == 30000
    plan = executed_plan(total).split("Initial Plan")[0]
    heavy_branch = plan[: plan.index("SortMergeJoin")] if "SortMergeJoin" in plan else plan
    assert "Union" in plan and "Inner, BuildRight" in heavy_branch
    assert "ReusedExchange" in plan  # the totals are aggregated once for both branches


def test_many_rows_are_not_heavy_without_the_share(spark, tmp_path):
    total = add_group_total(
        skewed(spark, tmp_path), "k", "v", "total", heavy_rows=1000, heavy_share=0.5
    )
    assert "Union" not in executed_plan(total).split("Initial Plan")[0]
    assert total.where("k = 'HOT' and total = 20000").count() == 10000


def test_without_heavy_customer_one_branch_is_left(spark, tmp_path):
    total = add_group_total(skewed(spark, tmp_path), "k", "v", "total")
    final = executed_plan(total).split("Initial Plan")[0]
    assert "Union" not in final
    # the rows are scanned once; the totals come from the exchange of the empty branch
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_remaining_skew_is_split_by_adaptive_execution(spark, tmp_path):
    """Below the heavy limit a large customer is left to the skew join."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    path = str(tmp_path / "hot")
    key = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 997))
    lines = spark.range(0, 120000, numPartitions=8).select(key.alias("k"), F.rand(7).alias("v"))
    lines.write.parquet(path)
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        total = add_group_total(spark.read.parquet(path), "k", "v", "total")
        final = executed_plan(total).split("Initial Plan")[0]
        assert "skew=true" in final
        assert total.where("k = 'HOT'").count() == 40000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_filter_after_totals_reaches_the_scan(spark, tmp_path):
    total = add_group_total(skewed(spark, tmp_path), "k", "v", "total").where("v > 3")
    assert "GreaterThan(v,3.0)" in executed_plan(total)
    assert total.where("k = 'HOT'").count() == 0
    # the total still covers the rows that the filter hides
    one = total.where("k = 'C1'").first()
    assert one.total > total.where("k = 'C1'").agg(F.sum("v")).first()[0]


def test_summaries(sample):
    daily, customer, product = create_aggregations(transform_sales_data(sample))
    assert daily.columns == [
        "year", "month", "day", "region",
        "daily_revenue", "daily_transactions", "avg_transaction_amount",
    ]
    assert customer.columns == [
        "customer_id", "customer_category", "region", "total_spent",
        "total_transactions", "avg_transaction_amount", "last_purchase_date",
    ]
    assert product.columns == [
        "product_id", "category", "region",
        "total_quantity_sold", "total_revenue", "total_orders", "avg_price",
    ]
    by_day = {(r.region, r.month, r.day): r.daily_revenue for r in daily.collect()}
    assert by_day == {
        ("Coast", 3, 5): 6.0, ("Coast", 3, 6): 1.5, ("Hills", 3, 5): 10.0,
        ("Hills", 4, 2): 20.0, ("Plain", 4, 1): 0.25,
    }
    assert {r.daily_transactions for r in daily.collect()} == {1}
    assert customer.where("customer_id = 'c2'").first().total_transactions == 2
    sold = {(r.product_id, r.region): r.total_quantity_sold for r in product.collect()}
    assert sold[("p7", "Coast")] == 4 and sold[("p8", "Hills")] == 15


def test_customer_with_two_regions_has_two_rows_and_one_tier(sales):
    df = sales(
        [
            (1, "C", "P", 1, 900.0, "2024-01-01 00:00:00", "a", "North"),
            (None, "C", "P", 1, 200.0, "2024-01-02 00:00:00", "a", "South"),
        ]
    )
    _, customer, _ = create_aggregations(transform_sales_data(df))
    rows = {r.region: r for r in customer.collect()}
    assert {r.customer_category for r in rows.values()} == {"Silver"}
    assert (rows["North"].total_transactions, rows["South"].total_transactions) == (1, 0)


def test_customer_summary_of_lines_is_the_same(sales):
    rows = [
        (i if i % 4 else None, f"C{i % 5}" if i % 7 else None, "P", i, 37.5, day, "a", region)
        for i in range(1, 60)
        for region in ("North", None, "")
        for day in ("2024-01-01 00:00:00", None)
    ]
    lines = add_line_facts(sales(rows))
    _, expected, _ = create_aggregations(transform_sales_data(sales(rows)))
    actual = customer_summary_of_lines(lines)
    assert actual.dtypes == expected.dtypes
    assert sorted(map(repr, actual.collect())) == sorted(map(repr, expected.collect()))


def test_nan_price_makes_premium(sales):
    df = sales([(1, "C", "P", 1, float("nan"), None, "a", "b")])
    row = transform_sales_data(df).first()
    assert math.isnan(row.customer_total_spent) and row.customer_category == "Premium"


def test_empty_input(sales):
    assert transform_sales_data(sales([])).count() == 0
    assert [s.count() for s in create_aggregations(transform_sales_data(sales([])))] == [0, 0, 0]


def test_sums_agree_between_outputs(spark, sf_dir):
    from saleslane.catalog.sales import sales_transformed

    fact = sales_transformed(spark, sf_dir)
    daily, customer, product = create_aggregations(fact)
    revenue = [
        daily.agg(F.sum("daily_revenue")).first()[0],
        customer.agg(F.sum("total_spent")).first()[0],
        product.agg(F.sum("total_revenue")).first()[0],
    ]
    assert revenue[1:] == pytest.approx(revenue[:1] * 2, rel=1e-9)
    orders = {
        daily.agg(F.sum("daily_transactions")).first()[0],
        customer.agg(F.sum("total_transactions")).first()[0],
        product.agg(F.sum("total_orders")).first()[0],
    }
    assert orders == {56830}
    per_customer = customer.groupBy("customer_id").agg(F.sum("total_spent").alias("spent"))
    off = (
        fact.select("customer_id", "customer_total_spent")
        .distinct()
        .join(per_customer, "customer_id")
        .where(F.abs(F.col("spent") - F.col("customer_total_spent")) > F.col("spent") * 1e-9)
    )
    assert off.count() == 0
