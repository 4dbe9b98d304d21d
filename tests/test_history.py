import pytest

from saleslane.operators.enrich import add_customer_total
from saleslane.operators.history import MOST_BITS, KeyHistory, bloom_filter_for
from saleslane.operators.running import merged_totals, partial_totals
from saleslane.session import setting


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def failed(history, day):
    (row,) = history.check(day, "t").collect()
    assert (row.check_type, row.check_name) == ("integrity", "duplicate_ids_over_days")
    return row.failed_records


def test_ids_of_earlier_days(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "ids"))
    days = {"2024-01-01": (1, 2, 2, None), "2024-01-02": (3, None, None), "2024-01-05": (2, 4, 4, 3, 5)}
    for day, values in days.items():
        assert history.record(ids(spark, *values), day) == len(set(values))
    assert [failed(history, day) for day in days] == [1, 2, 3]
    again = {r.key: r.row_count for r in history.repeated("2024-01-05").collect()}
    assert again == {2: 1, 3: 1}
    assert {r.key: r.row_count for r in history.repeated("2024-01-02").collect()} == {None: 2}
    # a day that is recorded again replaces what it had, and later days follow
    history.record(ids(spark, 9), "2024-01-01")
    assert [failed(history, day) for day in days] == [0, 1, 2]
    history.record(ids(spark).limit(0), "2024-01-06")
    assert failed(history, "2024-01-06") == 0


def test_days_are_compared_as_text(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "ids"))
    history.record(ids(spark, 1), "007")
    history.record(ids(spark, 1), "008")
    assert [failed(history, day) for day in ("007", "008")] == [0, 1]


def test_plan_filters_earlier_keys_by_those_of_the_day(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "ids"))
    for day, low in (("1", 0), ("2", 5000), ("3", 9990)):
        history.record(spark.range(low, low + 5000), day)
    before = dict(spark.conf.getAll)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        with bloom_filter_for(spark, 5000) as made:
            found = history.repeated("3")
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert made and found.count() == 10
        with bloom_filter_for(spark, MOST_BITS) as made:
            plain = history.repeated("3")._jdf.queryExecution().optimizedPlan().toString()
            assert not made and "might_contain" not in plain
    assert "5000, 50000" in plan  # a filter made for the keys of the day
    filtered = next(line for line in plan.splitlines() if "might_contain" in line)
    assert "day#" in filtered and "< 3" in filtered  # it is put before the earlier days
    assert dict(spark.conf.getAll) == before


def rows(df):
    return sorted((r.key is not None, r.key, r.total, r.rows) for r in df.collect())


def test_totals_of_parts_add_up(spark):
    values = [("a", 1.5), ("a", 2.5), ("b", 4.0), (None, 8.0), ("a", None), ("c", None)]
    df = spark.createDataFrame(values * 3, "k string, v double")
    whole = partial_totals(df, "k", "v")
    parts = [partial_totals(spark.createDataFrame(values, df.schema), "k", "v") for _ in range(3)]
    assert rows(merged_totals(parts)) == rows(whole)
    assert rows(merged_totals([merged_totals(parts[:2]), parts[2]])) == rows(whole)


@pytest.mark.parametrize("limits", [{}, {"heavy_rows": 2, "heavy_share": 0.1}])
def test_earlier_totals_count(spark, limits):
    sales = "customer_id string, total_amount double"
    before = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), ("z", 9.0), ("n", 3.0)], sales)
    today = spark.createDataFrame([("a", 10.0), ("a", 10.0), ("b", 1.0), (None, 1.0), ("n", None)], sales)
    earlier = partial_totals(before, "customer_id", "total_amount")
    found = add_customer_total(today, earlier, **limits).collect()
    assert sorted((str(r.customer_id), r.customer_total_spent) for r in found) == [
        ("None", 6.0), ("a", 23.0), ("a", 23.0), ("b", 1.0), ("n", 3.0),
    ]
    assert len(add_customer_total(today, earlier.where("false"), **limits).collect()) == 5
