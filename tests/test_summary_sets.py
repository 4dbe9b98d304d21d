import pytest
from pyspark.sql import functions as F

from saleslane.operators.enrich import transform_sales_data
from saleslane.operators.summaries import CUSTOMER, DAILY, PRODUCT, SUMMARIES, SummarySets


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(sorted(df.columns)).collect())  # NaN equals itself as text


def test_one_scan_gives_what_three_give(spark, sales, sample):
    more = [
        (None, "c1", "p7", 4, 1.50, None, "Tea", None),
        (16, "c9", "p7", 2, 0.50, "2023-03-05 08:30:00", None, "Coast"),
        (17, "c1", "p7", 2, float("nan"), "2023-04-05 08:30:00", "Tea", "Coast"),
    ]
    fact = transform_sales_data(sample.unionByName(sales(more)))
    sets = SummarySets()
    groups = sets.of(fact)
    for summary in SUMMARIES:
        assert sets.rows(groups, summary).columns == [*summary.keys, *summary.measures]
        assert rows(sets.rows(groups, summary)) == rows(summary.of(fact))
    empty = fact.where("false")
    assert [sets.rows(sets.of(empty), s).count() for s in SUMMARIES] == [0, 0, 0]


def test_some_summaries_only(spark, sample):
    fact = transform_sales_data(sample)
    sets = SummarySets([PRODUCT, DAILY])
    assert rows(sets.rows(sets.of(fact), DAILY)) == rows(DAILY.of(fact))
    with pytest.raises(ValueError, match="same keys"):
        SummarySets([CUSTOMER, CUSTOMER])


def test_plan_has_one_scan_and_one_exchange(spark, sample, tmp_path, capsys):
    path = str(tmp_path / "fact")
    transform_sales_data(sample).write.parquet(path)
    groups = SummarySets().of(spark.read.parquet(path).withColumn("year", F.col("year")))
    groups.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "customer_total_spent" not in plan.split("FileScan")[1]
