import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslane.functions import rules as r
from saleslane.functions.columns import is_missing
from saleslane.operators.audit import (
    TableAudit,
    check_data_completeness,
    check_data_consistency,
    check_data_validity,
    check_rules,
    generate_data_profile,
)
from saleslane.operators.enrich import transform_sales_data
from saleslane.operators.integrity import (
    check_foreign_key,
    check_referential_integrity,
    check_uniqueness,
    orphan_keys,
    uniqueness_violations,
)
from saleslane.operators.missing import check_missing_pattern, missing_pattern
from saleslane.operators.precheck import (
    InputRejected,
    check_input,
    require_completeness,
    require_rows,
)
from saleslane.operators.report import (
    critical_failures,
    failed_checks,
    quality_results,
    union_checks,
    unreadable_dataset,
)
from saleslane.operators.score import check_quality_score, quality_score, score_by_rules
from saleslane.schema import check_schema, quality_results_schema
from saleslane.session import setting

NAN = float("nan")


@pytest.fixture
def dirty(sales):
    late, early = "2100-01-01 00:00:00", "2024-01-01 00:00:00"
    return sales(
        [
            (1, "C1", "P1", 2, 10.0, early, "a", "North"),
            (1, "C1", "P1", 2, 10.0, early, "a", "North"),
            (2, None, "P1", -1, -3.0, late, None, "South"),
            (None, "C2", None, 0, NAN, None, None, None),
            (None, "C3", "P2", None, None, late, "b", "NaN"),
        ]
    )


def by(df, *keys):
    rows = df.collect()
    out = {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row for row in rows}
    assert len(out) == len(rows)
    return out


def test_completeness(dirty):
    result = check_data_completeness(dirty, "t")
    assert result.schema.simpleString() == check_schema().simpleString()
    rows = by(result, "column_name")
    assert list(rows) == dirty.columns
    nulls = {name: row.null_count for name, row in rows.items()}
    assert nulls == {
        "id": 2, "customer_id": 1, "product_id": 1, "quantity": 1,
        "price": 2,  # one null, one NaN
        "transaction_date": 1, "category": 2,
        "region": 1,  # the text 'NaN' is present
    }
    assert rows["price"].completeness_rate == pytest.approx(60.0)
    assert {(x.table_name, x.check_type, x.total_records) for x in rows.values()} == {
        ("t", "completeness", 5)
    }
    assert {(x.check_name, x.failed_records, x.rule) for x in rows.values()} == {(None,) * 3}


def test_completeness_of_an_empty_table_is_zero(sales):
    rows = check_data_completeness(sales([])).collect()
    assert [(x.total_records, x.null_count, x.completeness_rate) for x in rows] == [(0, 0, 0.0)] * 8
    assert {x.table_name for x in rows} == {"unknown"}


def test_completeness_of_strings_and_timestamps_only(dirty):
    df = dirty.select("region", "transaction_date")
    assert check_data_completeness(df).count() == 2


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None), (None, 2.5)], "`a.b` int, rows double")
    rows = by(check_data_completeness(df), "column_name")
    assert {n: x.null_count for n, x in rows.items()} == {"a.b": 1, "rows": 1}
    assert by(generate_data_profile(df), "column_name")["a.b"].max_val == 1.0


def test_missing_predicate_is_typed(spark):
    df = spark.createDataFrame([("NaN", NAN)], "s string, d float")
    flags = df.select(*[is_missing(f).alias(f.name) for f in df.schema]).first()
    assert (flags.s, flags.d) == (False, True)


def test_validity(dirty):
    rows = by(check_data_validity(dirty, "t", as_of="2026-01-01 00:00:00"), "check_name")
    assert {n: (x.failed_records, x.rule) for n, x in rows.items()} == {
        "negative_quantity": (1, "quantity >= 0"),
        "negative_price": (1, "price >= 0"),
        "future_transaction_date": (2, "transaction_date <= current_date"),
    }
    assert {x.check_type for x in rows.values()} == {"validity"}
    assert {x.total_records for x in rows.values()} == {None}


def test_validity_defaults_to_now(dirty):
    assert by(check_data_validity(dirty), "check_name")["future_transaction_date"].failed_records == 2


def test_rules_on_missing_columns_give_no_row(dirty):
    df = dirty.drop("quantity")
    assert set(by(check_data_validity(df), "check_name")) == {
        "negative_price",
        "future_transaction_date",
    }
    nothing = check_data_validity(df.select("region"))
    assert nothing.count() == 0
    assert nothing.schema.simpleString() == check_schema().simpleString()
    assert check_data_consistency(dirty).count() == 0  # no total_amount
    assert check_referential_integrity(dirty.drop("id")).count() == 0


def test_consistency_tolerance_is_strict(spark):
    rows = [(2, 1.0, 2.0), (2, 1.0, 2.01), (2, 1.0, 2.02), (2, 1.0, 1.5), (2, 1.0, None)]
    df = spark.createDataFrame(rows, "quantity int, price double, total_amount double")
    row = check_data_consistency(df, "t").first()
    # 2.01 - 2.0 lies a hair below 0.01 in binary floating point
    assert (row.check_name, row.failed_records) == ("total_amount_calculation", 2)
    assert (row.check_type, row.rule) == ("consistency", "total_amount = quantity * price")


def test_duplicate_ids_count_null_as_one_value(dirty, sales):
    row = check_referential_integrity(dirty, "t").first()
    # five rows, distinct ids are 1, 2 and null
    assert (row.check_name, row.failed_records) == ("duplicate_ids", 2)
    assert (row.check_type, row.rule) == ("integrity", "id should be unique")
    assert check_referential_integrity(sales([])).first().failed_records == 0


def test_profile_long(dirty):
    rows = by(generate_data_profile(dirty, "t"), "column_name")
    assert list(rows) == ["id", "quantity", "price"]
    quantity = rows["quantity"]
    assert (quantity.total_records, quantity.column_count) == (5, 8)
    assert (quantity.min_val, quantity.max_val, quantity.avg_val) == (-1.0, 2.0, 0.75)
    assert quantity.non_null_count == 4
    assert math.isnan(rows["price"].max_val) and rows["price"].min_val == -3.0
    assert quantity.profiled_at is not None


def test_profile_types_and_empty_table(spark):
    df = spark.createDataFrame(
        [], "i int, b bigint, f float, d double, s smallint, t tinyint, c decimal(9,2), x string"
    )
    rows = by(generate_data_profile(df), "column_name")
    assert list(rows) == ["i", "b", "f", "d"]
    for row in rows.values():
        assert (row.min_val, row.max_val, row.avg_val, row.non_null_count) == (None, None, None, 0)
    assert generate_data_profile(df.select("x")).count() == 0


def test_profile_wide(dirty):
    row = TableAudit(dirty, "t").wide_profile().first()
    assert (row.table_name, row.total_records, row.column_count) == ("t", 5, 8)
    assert (row.id_min, row.id_max, row.id_non_null_count) == (1, 2, 3)
    assert row.timestamp is not None
    assert {f"price_{m}" for m in ("min", "max", "avg", "non_null_count")} <= set(row.asDict())


def test_audit_scans_once(spark, dirty, tmp_path, capsys):
    path = str(tmp_path / "t")
    transform_sales_data(dirty).write.parquet(path)
    df = spark.read.parquet(path)
    rules = [*r.sales_validity(), r.amount_agrees()]
    audit = TableAudit(df, "t", rules)
    audit.results().explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Scan parquet") == 2  # in the tree and in the details
    assert plan.count("Exchange") == 2
    assert "SinglePartition" in plan
    assert audit.results().count() == 14 + 4


def test_audit_equals_the_single_checks(dirty):
    df = transform_sales_data(dirty)
    audit = TableAudit(df, "t", [*r.sales_validity("2026-01-01"), r.amount_agrees()])
    single = union_checks(
        [
            check_data_completeness(df, "t"),
            check_data_validity(df, "t", "2026-01-01"),
            check_data_consistency(df, "t"),
        ]
    )
    assert sorted(map(str, audit.results().collect())) == sorted(map(str, single.collect()))


def test_type_range_format_and_business_rules(spark):
    rows = [("1", 5, "https://a.b/"), ("x", 0, "ftp://a"), (None, None, None), ("2.5", 11, "https:")]
    df = spark.createDataFrame(rows, "code string, n int, url string")
    checks = by(
        check_rules(
            df,
            [
                r.castable("code", "int"),
                r.in_range("n", 1, 10),
                r.matches("url", "^https://"),
                r.business_rule("small_is_secure", (F.col("n") < 3) & F.col("url").like("ftp%"), "t"),
                r.in_range("absent", 1),
            ],
            "t",
        ),
        "check_name",
    )
    failed = {n: (x.check_type, x.column_name, x.failed_records) for n, x in checks.items()}
    assert failed == {
        "code_is_int": ("type", "code", 2),
        "n_in_range": ("range", "n", 2),
        "url_format": ("format", "url", 2),
        "small_is_secure": ("business", None, 1),
    }
    assert checks["n_in_range"].rule == "1 <= n <= 10"


def test_rule_texts_survive_quotes_and_backslashes(spark):
    pattern = r"""^\d+"'é$"""
    df = spark.createDataFrame([("1\"'é",), ("x",)], "code string")
    row = check_rules(df, [r.matches("code", pattern)], "it's").first()
    assert (row.failed_records, row.rule, row.table_name) == (1, f"code matches {pattern}", "it's")


cell = st.one_of(st.none(), st.integers(-3, 3))
number = st.one_of(st.none(), st.just(NAN), st.sampled_from([-1.5, 0.0, 2.25]))
word = st.one_of(st.none(), st.sampled_from(["", "a", "NaN"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(cell, number, word), max_size=25))
def test_audit_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "id int, price double, name string")
    audit = TableAudit(df, "t", [r.not_negative("price"), r.not_negative("id")])
    checks = audit.results().collect()
    missing = {x.column_name: x.null_count for x in checks if x.check_type == "completeness"}
    gone = lambda v: v is None or (isinstance(v, float) and math.isnan(v))
    assert missing == {
        name: sum(gone(row[i]) for row in rows) for i, name in enumerate(("id", "price", "name"))
    }
    failed = {x.check_name: x.failed_records for x in checks if x.check_name}
    assert failed == {
        "negative_price": sum(p is not None and p < 0 for _, p, _ in rows),
        "negative_id": sum(i is not None and i < 0 for i, _, _ in rows),
    }
    duplicates = check_referential_integrity(df).first().failed_records
    assert duplicates == len(rows) - len({i for i, _, _ in rows})
    repeated = uniqueness_violations(df, ["id", "name"]).collect()
    counts = Counter((i, n) for i, _, n in rows)
    assert {(x.id, x.name): x.row_count for x in repeated} == {
        key: n for key, n in counts.items() if n > 1
    }


def test_foreign_key(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "id string")
    row = check_foreign_key(child, parent, ["k"], ["id"], "child", "parent").first()
    assert (row.check_name, row.failed_records) == ("orphan_k", 3)
    assert row.rule == "(k) should exist in parent"
    assert {tuple(x) for x in orphan_keys(child, parent, ["k"], ["id"]).collect()} == {
        ("b", 2),
        ("c", 1),
    }
    none_missing = check_foreign_key(child.where("k = 'a'"), parent, ["k"], ["id"])
    assert none_missing.first().failed_records == 0


def test_composite_foreign_key(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "n int, k string")
    parent = spark.createDataFrame([(1, "a")], "n int, k string")
    assert [tuple(x) for x in orphan_keys(child, parent, ["n", "k"]).collect()] == [(1, "b", 1)]


def test_foreign_key_join_reuses_the_shuffle_of_the_grouping(spark, capsys):
    child = spark.range(100).select((F.col("id") % 7).alias("k"))
    parent = spark.range(5).select(F.col("id").alias("p"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        check_foreign_key(child, parent, ["k"], ["p"]).explain()
    plan = capsys.readouterr().out
    # one exchange per side, before the join, and one for the single result row
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange SinglePartition") == 1


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "n int, k string")
    assert {tuple(x) for x in uniqueness_violations(df, ["n", "k"]).collect()} == {
        (1, "a", 2),
        (1, None, 2),
    }
    row = check_uniqueness(df, ["n", "k"], "t").first()
    assert (row.check_name, row.failed_records) == ("unique_n_k", 2)


def test_missing_pattern(dirty):
    assert {tuple(x) for x in missing_pattern(dirty).collect()} == {(0, 2), (2, 1), (6, 1), (3, 1)}
    checks = by(check_missing_pattern(dirty, "t"), "check_name")
    assert {n: x.failed_records for n, x in checks.items()} == {
        "rows_missing_2": 1,
        "rows_missing_3": 1,
        "rows_missing_6": 1,
    }
    some = missing_pattern(dirty, ["price", "region"])
    assert {tuple(x) for x in some.collect()} == {(0, 3), (1, 1), (2, 1)}


def test_quality_score(dirty, sales):
    good = F.col("quantity") > 0
    row = quality_score(dirty, good, "t").first()
    assert (row.total_records, row.passing_records, row.quality_score) == (5, 2, 40.0)
    assert quality_score(sales([]), good).first().quality_score == 0.0
    check = check_quality_score(dirty, good, "t").first()
    assert (check.check_type, check.total_records, check.failed_records) == ("score", 5, 3)
    by_rules = score_by_rules(dirty, [r.not_negative("quantity"), r.not_negative("absent")], "t")
    assert by_rules.first().passing_records == 4  # null passes


def test_report_schema_and_gates(dirty, sales):
    tables = {"sales": transform_sales_data(dirty), "empty": sales([])}
    results = quality_results(tables, "2024-01-01", as_of="2026-01-01")
    assert results.schema.simpleString() == quality_results_schema().simpleString()
    rows = results.collect()
    assert len(rows) == (14 + 3 + 1 + 1) + (8 + 3 + 1)
    assert {x.processing_date for x in rows} == {"2024-01-01"}
    assert len({x.check_timestamp for x in rows}) == 1

    failed = failed_checks(results).collect()
    assert all((x.failed_records or 0) > 0 or x.completeness_rate < 95 for x in failed)
    assert {x.check_name for x in failed if x.check_name} == {
        "negative_quantity", "negative_price", "future_transaction_date", "duplicate_ids",
        "total_amount_calculation",  # a NaN amount is above any tolerance
    }
    assert critical_failures(results).count() == 0
    assert critical_failures(results, threshold=1).count() == 2
    assert failed_checks(results, min_completeness=0).count() == 5


def test_bounds_of_the_gates_are_strict(spark):
    df = spark.createDataFrame(
        [(0, None), (1, None), (100, None), (101, None), (None, 95.0), (None, 94.9)],
        "failed_records bigint, completeness_rate double",
    )
    assert failed_checks(df).count() == 4
    assert critical_failures(df).count() == 1


def test_unreadable_dataset_row(spark):
    row = unreadable_dataset(spark, "t").first()
    assert (row.check_type, row.failed_records) == ("dataset_status", 1)


def test_precheck(dirty, sales):
    rows = by(check_input(dirty.drop("price", "id"), "raw"), "check_type", "check_name", "column_name")
    assert rows[("precheck", "missing_columns", None)].failed_records == 2
    assert by(check_input(dirty), "check_name", "column_name")[
        ("missing_columns", None)
    ].failed_records == 0
    assert rows[("precheck", "empty_input", None)].failed_records == 0
    assert rows[("completeness", None, "customer_id")].null_count == 1
    empty = by(check_input(sales([])), "check_name", "column_name")
    assert empty[("empty_input", None)].failed_records == 1

    spark = dirty.sparkSession
    spark.sparkContext.setJobGroup("first-row", "")
    require_rows(dirty)
    require_rows(spark.range(0, 1000, numPartitions=50))
    tracker = spark.sparkContext.statusTracker()
    last = tracker.getJobInfo(max(tracker.getJobIdsForGroup("first-row")))
    assert [tracker.getStageInfo(s).numTasks for s in last.stageIds] == [1]
    require_completeness(dirty, 80)
    with pytest.raises(InputRejected, match="no rows"):
        require_rows(sales([]))
    with pytest.raises(InputRejected, match="customer_id 80.00%"):
        require_completeness(dirty, 81)
