import glob
import os

import pytest
from conftest import HEADER
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from saleslane.catalog import queries
from saleslane.operators.audit import TableAudit
from saleslane.operators.enrich import transform_sales_data
from saleslane.operators.precheck import InputRejected, check_input
from saleslane.plans.daily import run_day
from saleslane.plans.ingestion import run_ingestion
from saleslane.plans.quality import DATASETS, QualityFailure, run_quality
from saleslane.plans.transformation import known_schemas, run_transformation
from saleslane.schema import define_schema
from saleslane.session import parallelism
from saleslane.sources.sinks import refuse_overlap, write_layer
from saleslane.sources.tables import (
    csv_header,
    layer_path,
    mismatched_files,
    read_layer,
    read_sales_csv,
)

GOOD = [
    "1,c1,p7,4,1.50,2023-03-05 08:30:00,Tea,Coast",
    "2,c2,p8,5,2.00,2023-03-05 09:00:00,Rice,Hills",
    "3,c1,p9,6,2.50,2023-03-05 10:15:00,Tea,Coast",
]
BAD = [
    "1,c1,p7,4,1.50,2023-03-05 08:30:00,Tea,Coast",
    "2,,p8,5,2.00,2023-03-05 09:00:00,Rice,Hills",
    "3,c1,,6,2.50,2023-03-05 10:15:00,Tea,Coast",
    "4,c3,p9,-7,0.25,2023-04-01 00:00:00,Salt,Plain",
]


def test_csv_types_and_bad_cells(spark, write_csv):
    path = write_csv(["1,C,P,two,1.5,2024-01-01 10:00:00,a,b", "2,C,P", ",,,,,,,", "3,C,P,1,2,x,a,b"])
    rows = read_sales_csv(spark, path).collect()
    assert [x.id for x in rows] == [1, 2, None, 3]
    assert rows[0].quantity is None and rows[0].price == 1.5
    assert rows[1].region is None and rows[2].customer_id is None
    assert rows[3].transaction_date is None


def test_csv_binds_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("region,id\n1,C\n")
    row = read_sales_csv(spark, str(tmp_path)).first()
    assert (row.id, row.customer_id) == (1, "C")


def test_csv_with_inferred_types(spark, write_csv):
    df = read_sales_csv(spark, write_csv(GOOD), infer=True)
    assert dict(df.dtypes)["quantity"] == "int" and dict(df.dtypes)["price"] == "double"
    assert df.count() == 3
    assert csv_header(spark, write_csv(GOOD)) == HEADER.split(",")


def test_ingestion(spark, write_csv, tmp_path):
    out = str(tmp_path / "processed")
    (metrics,) = run_ingestion(spark, write_csv(BAD), out, "2024-01-01")
    assert (metrics.rows_in, metrics.rows_out, metrics.rows_rejected) == (4, 1, 3)
    df = read_layer(spark, out)
    assert df.columns[-2:] == ["processed_at", "region"]
    assert df.first().customer_id == "c1"
    assert os.listdir(out) and glob.glob(f"{out}/region=Coast/*.parquet")


def stage_tasks(spark, group):
    """Number of tasks of each stage that the jobs of a group ran."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds]
    return [stage.numTasks for stage in stages if stage]


@pytest.mark.parametrize("rebalance", [True, False])
def test_ingestion_is_one_pass(spark, write_csv, tmp_path, rebalance):
    raw, out = write_csv(BAD + GOOD), str(tmp_path / "out")
    spark.sparkContext.setJobGroup(f"ingest-{rebalance}", "")
    (metrics,) = run_ingestion(spark, raw, out, "d", rebalance)
    assert (metrics.rows_in, metrics.rows_out) == (7, 4)
    # one stage looks at the headers
    assert len(stage_tasks(spark, f"ingest-{rebalance}")) == 1 + (3 if rebalance else 1)
    assert sorted(x.id for x in read_layer(spark, out).collect()) == [1, 1, 2, 3]


def test_ingestion_with_wide_ids(spark, write_csv, tmp_path):
    raw, out = write_csv([GOOD[0].replace("1,", "9000000000,", 1)]), str(tmp_path / "out")
    run_ingestion(spark, raw, out, "d")
    assert read_layer(spark, out).first().id is None  # does not fit an int
    wide = define_schema()
    wide["id"].dataType = LongType()
    run_ingestion(spark, raw, out, "d", schema=wide)
    assert read_layer(spark, out).first().id == 9000000000


@pytest.mark.parametrize("rebalance", [True, False])
def test_ingestion_of_nothing(spark, write_csv, tmp_path, rebalance):
    for folder, lines in (("raw1", []), ("raw2", BAD[1:])):
        out = str(tmp_path / f"out_{folder}")
        (metrics,) = run_ingestion(spark, write_csv(lines, folder), out, "d", rebalance)
        assert (metrics.rows_in, metrics.rows_out) == (len(lines), 0)


def test_overwrite_replaces_the_whole_layer(spark, write_csv, tmp_path):
    out = str(tmp_path / "processed")
    run_ingestion(spark, write_csv(GOOD, "one"), out, "d")
    run_ingestion(spark, write_csv(GOOD[1:2], "two"), out, "d")
    assert [x.id for x in read_layer(spark, out).collect()] == [2]


def test_output_inside_input_is_refused(spark, tmp_path):
    for source, target in (
        ("/a/b", "/a/b/"),
        ("/a/b", "/a/b/c"),
        ("/a/b/c", "/a/b"),
        ("file:/a/b", "/a//b"),
    ):
        with pytest.raises(ValueError, match="overlaps"):
            refuse_overlap(spark, source, target)
    refuse_overlap(spark, "/a/b", "/a/bc")
    with pytest.raises(ValueError):
        run_ingestion(spark, str(tmp_path), str(tmp_path), "d")


def test_partition_values_keep_their_text(spark, sales, tmp_path):
    df = sales(
        [
            (1, "C", "P", 1, 1.0, "2024-02-03 00:00:00", "a", "007"),
            (2, "C", "P", 1, 1.0, None, "a", ""),
            (3, "C", "P", 1, 1.0, "2024-02-03 00:00:00", "a", None),
        ]
    )
    path = str(tmp_path / "fact")
    fact = transform_sales_data(df)
    assert write_layer(fact, path, ["region", "year", "month"]) == 3
    for back in (read_layer(spark, path), read_layer(spark, path, fact.schema)):
        assert dict(back.dtypes)["region"] == "string" and dict(back.dtypes)["year"] == "int"
        rows = {x.id: (x.region, x.year, x.month, x.day) for x in back.collect()}
        assert rows == {1: ("007", 2024, 2, 3), 2: (None, None, None, None), 3: (None, 2024, 2, 3)}
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_partition_filters_prune_folders(spark, sample, tmp_path, capsys):
    path = str(tmp_path / "fact")
    fact = transform_sales_data(sample)
    write_layer(fact, path, ["region", "year", "month"])
    read_layer(spark, path).where("region = 'Coast' and year = 2023").explain("formatted")
    plan = capsys.readouterr().out
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "Coast" in filters and "2023" in filters


def test_rebalance_splits_a_large_folder(spark, tmp_path):
    df = spark.range(0, 200000, numPartitions=4).select(F.rand(1).alias("v"), F.lit("x").alias("region"))
    write_layer(df, str(tmp_path / "split"), ["region"], file_target="300KB")
    write_layer(df, str(tmp_path / "whole"), ["region"])
    assert len(glob.glob(f"{tmp_path}/split/region=x/*.parquet")) > 2
    assert len(glob.glob(f"{tmp_path}/whole/region=x/*.parquet")) == 1
    assert spark.read.parquet(str(tmp_path / "split")).count() == 200000


def test_folders_with_few_rows_are_dealt_out(spark, tmp_path):
    df = spark.range(0, 600).selectExpr("id", "cast(id % 60 as int) as month", "'x' as region")
    written = str(tmp_path / "t")
    spark.sparkContext.setJobGroup("deal", "deal")
    assert write_layer(df, written, ["region", "month"], few_rows=True) == 600
    assert parallelism(spark) in stage_tasks(spark, "deal")
    assert len(glob.glob(f"{written}/region=x/month=*/*.parquet")) == 60


def test_records_per_file(spark, tmp_path):
    write_layer(spark.range(10), str(tmp_path / "t"), max_records_per_file=2)
    assert len(glob.glob(f"{tmp_path}/t/*.parquet")) >= 5


def test_transformation(spark, write_csv, tmp_path):
    processed, out = str(tmp_path / "processed"), str(tmp_path / "transformed")
    run_ingestion(spark, write_csv(GOOD), processed, "d")
    metrics = run_transformation(spark, processed, out, "d")
    assert [(m.output, m.rows_in, m.rows_out, m.rows_rejected) for m in metrics] == [
        ("transformed_sales", 3, 3, 0),
        ("daily_sales_summary", 3, 2, None),
        ("customer_summary", 3, 2, None),
        ("product_summary", 3, 3, None),
    ]
    assert sorted(os.path.basename(p) for p in glob.glob(f"{out}/*")) == sorted(DATASETS)
    fact = read_layer(spark, f"{out}/transformed_sales")
    assert fact.columns[-3:] == ["region", "year", "month"]
    assert "total_amount" in fact.columns and "processed_at" in fact.columns
    daily = {x.region: x for x in read_layer(spark, f"{out}/daily_sales_summary").collect()}
    assert daily["Coast"].daily_revenue == pytest.approx(4 * 1.5 + 6 * 2.5)
    assert glob.glob(f"{out}/daily_sales_summary/region=Coast/year=2023/month=3/*.parquet")


@pytest.fixture
def day(spark, write_csv, tmp_path):
    write_csv(GOOD, "raw/2024-01-01")
    return str(tmp_path)


def test_daily_run(spark, day):
    counts = run_day(spark, day, "2024-01-01").collect()
    assert [(x.stage, x.output) for x in counts][:2] == [
        ("ingestion", "processed"),
        ("transformation", "transformed_sales"),
    ]
    assert {x.processing_date for x in counts} == {"2024-01-01"}
    transformed = layer_path(day, "transformed", "2024-01-01")
    results = spark.read.parquet(f"{transformed}/quality_results")
    assert {x.table_name for x in results.select("table_name").distinct().collect()} == set(DATASETS)
    # no table may fall out of the report for its strings or timestamps
    assert results.where("check_type = 'dataset_status'").count() == 0
    assert results.where("check_type = 'completeness'").count() == 15 + 7 + 7 + 7
    assert results.where("check_name = 'total_amount_calculation'").first().failed_records == 0
    profiles = spark.read.parquet(f"{transformed}/data_profiles")
    assert profiles.groupBy("table_name").count().count() == 4
    assert profiles.where("table_name = 'transformed_sales'").count() == 8
    saved = spark.read.parquet(f"{day}/run_metrics/2024-01-01/*")
    assert saved.count() == 5


def test_single_stage_and_unknown_stage(spark, day):
    run_day(spark, day, "2024-01-01", stages=["ingestion"])
    assert not os.path.exists(f"{day}/transformed")
    with pytest.raises(ValueError, match="unknown"):
        run_day(spark, day, "2024-01-01", stages=["cooking"])


def test_input_is_checked_before_ingestion(spark, day, tmp_path):
    folder = tmp_path / "raw" / "2024-01-02"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,customer_id\n1,C\n")
    with pytest.raises(InputRejected, match="product_id"):
        run_day(spark, day, "2024-01-02")
    (folder / "a.csv").write_text(HEADER + "\n")
    with pytest.raises(InputRejected, match="no rows"):
        run_day(spark, day, "2024-01-02")
    (folder / "a.csv").write_text("\n".join([HEADER, *BAD]) + "\n")
    with pytest.raises(InputRejected, match="completeness"):
        run_day(spark, day, "2024-01-02", min_completeness=90)
    assert not os.path.exists(f"{day}/processed/2024-01-02")


SWAPPED = HEADER.replace("quantity,price", "price,quantity")


@pytest.mark.parametrize("header", [SWAPPED, "id,customer_id", HEADER.removeprefix("id,")])
def test_every_file_needs_the_columns_in_order(spark, day, tmp_path, header):
    """Also the second file; the good file and its rows must not hide it."""
    folder = tmp_path / "raw" / "2024-01-01"
    (folder / "second.csv").write_text(header + "\n9,c9,p9,1.5,2,2023-03-05 08:30:00,Tea,Coast\n")
    with pytest.raises(InputRejected, match="second.csv"):
        run_day(spark, day, "2024-01-01")
    with pytest.raises(InputRejected, match="second.csv"):
        run_ingestion(spark, str(folder), str(tmp_path / "out"), "d")
    assert not os.path.exists(tmp_path / "out") and not os.path.exists(tmp_path / "processed")
    (metrics,) = run_ingestion(spark, str(folder), str(tmp_path / "out"), "d", by_position=True)
    assert metrics.rows_in == 4


def test_headers_that_are_the_same(spark, write_csv, tmp_path):
    path = write_csv(GOOD)
    (tmp_path / "raw" / "empty.csv").write_text("")
    (tmp_path / "raw" / "only.csv").write_text(HEADER.upper() + "\n")
    quoted = ",".join(f'"{name}"' for name in HEADER.split(","))
    (tmp_path / "raw" / "bom.csv").write_text("\ufeff" + quoted + ",more\n" + GOOD[0] + ",x\n")
    assert mismatched_files(spark, path) == []
    (tmp_path / "raw" / "swapped.csv").write_text(SWAPPED + "\n" * 100_000)
    ((file, header),) = mismatched_files(spark, path)
    assert file.endswith("swapped.csv") and ",".join(header) == SWAPPED
    (row,) = check_input(read_sales_csv(spark, path), bad_files=1).where(
        "check_name = 'mismatched_files'"
    ).collect()
    assert row.failed_records == 1


def test_all_mismatched_files_are_counted(spark, write_csv, tmp_path, monkeypatch):
    path = write_csv(GOOD)
    for i in range(25):
        (tmp_path / "raw" / f"swapped{i}.csv").write_text(SWAPPED + "\n")
    monkeypatch.setattr(queries, "sales_files", lambda *_: path)
    rows = queries.QUERIES["input_precheck"](spark, "").collect()
    found = {row["check_name"]: row["failed_records"] for row in rows}
    assert found["mismatched_files"] == 25


def test_malformed_lines_are_counted(spark, write_csv, tmp_path):
    lines = [*GOOD, "5,c1,p7,two,1.5,2023-03-05 08:30:00,Tea,Coast", "6,c1,p7", "99999999999" + GOOD[0][1:]]
    (metrics,) = run_ingestion(spark, write_csv(lines), str(tmp_path / "out"), "d")
    assert (metrics.rows_in, metrics.rows_out, metrics.rows_malformed) == (6, 4, 3)
    assert "_malformed" not in read_layer(spark, str(tmp_path / "out")).columns


@pytest.mark.parametrize("lines", [[], BAD[1:]])
def test_day_without_usable_rows(spark, tmp_path, write_csv, lines):
    write_csv(lines, "raw/2024-01-03")
    base = str(tmp_path)
    if not lines:
        with pytest.raises(InputRejected, match="no rows"):
            run_day(spark, base, "2024-01-03")
    counts = run_day(spark, base, "2024-01-03", allow_empty=True).collect()
    assert [x.rows_out for x in counts] == [0] * 5
    transformed = layer_path(base, "transformed", "2024-01-03")
    results = spark.read.parquet(f"{transformed}/quality_results")
    rates = results.where("check_type = 'completeness'").groupBy("table_name", "completeness_rate")
    assert {(x.table_name, x.completeness_rate) for x in rates.count().collect()} == {
        (name, 0.0) for name in DATASETS
    }
    for name, schema in known_schemas().items():
        back = read_layer(spark, f"{transformed}/{name}", if_empty=lambda schema=schema: schema)
        assert back.count() == 0
        assert sorted(back.dtypes) == sorted((f.name, f.dataType.simpleString()) for f in schema)


def test_wide_schema_through_the_day(spark, tmp_path, write_csv):
    wide = define_schema()
    wide["id"].dataType = LongType()
    write_csv(["9000000000" + GOOD[0][1:], *GOOD[1:]], "raw/d")
    counts = run_day(spark, str(tmp_path), "d", schema=wide).collect()
    assert counts[0].rows_malformed == 0
    fact = read_layer(spark, f"{tmp_path}/transformed/d/transformed_sales")
    assert sorted(x.id for x in fact.collect()) == [2, 3, 9000000000]
    write_csv(BAD[1:], "raw/e")
    run_day(spark, str(tmp_path), "e", schema=wide)
    empty = read_layer(spark, f"{tmp_path}/transformed/e/transformed_sales", if_empty=lambda: known_schemas(wide)[DATASETS[0]])
    assert dict(empty.dtypes)["id"] == "bigint"


def test_tiers_are_those_of_the_money_scale(spark, tmp_path, write_csv):
    """0.1 + 0.2 sums to a little more than 0.3, and so do amounts around a bound."""
    lines = [f"{i},c1,p7,1,{amount},2023-03-05 08:30:00,Tea,Coast" for i, amount in enumerate((999.7, 0.1, 0.2))]
    write_csv(lines, "raw/d")
    run_day(spark, str(tmp_path), "d")
    fact = read_layer(spark, f"{tmp_path}/transformed/d/transformed_sales")
    assert {x.customer_category for x in fact.collect()} == {"Bronze"}


def test_failed_step_stops_the_run(spark, day):
    with pytest.raises(Exception):
        run_day(spark, day, "1999-01-01", stages=["transformation", "quality"])
    assert not os.path.exists(f"{day}/transformed/1999-01-01/quality_results")


def test_unreadable_dataset_does_not_hide_the_others(spark, day):
    run_day(spark, day, "2024-01-01", stages=["ingestion", "transformation"])
    transformed = layer_path(day, "transformed", "2024-01-01")
    for file in glob.glob(f"{transformed}/product_summary/region=*/*.parquet"):
        with open(file, "wb") as broken:
            broken.write(b"not parquet")
    os.rename(f"{transformed}/customer_summary", f"{transformed}/elsewhere")
    with pytest.raises(QualityFailure, match="could not be checked: customer_summary, product_summary"):
        run_quality(spark, transformed, "d")
    checked = run_quality(spark, transformed, "d", allow_unreadable=True)
    failed = {(x.table_name, x.check_name) for x in checked.collect()}
    assert failed == {
        ("product_summary", "dataset_unreadable"),
        ("customer_summary", "dataset_unreadable"),
    }
    results = spark.read.parquet(f"{transformed}/quality_results")
    assert results.where("table_name = 'transformed_sales'").count() > 15


def test_broken_fact_stops_the_run_after_both_reports(spark, day):
    run_day(spark, day, "2024-01-01", stages=["ingestion", "transformation"])
    transformed = layer_path(day, "transformed", "2024-01-01")
    for file in glob.glob(f"{transformed}/transformed_sales/region=*/*/*/*.parquet"):
        with open(file, "wb") as broken:
            broken.write(b"not parquet")
    with pytest.raises(QualityFailure, match="transformed_sales"):
        run_day(spark, day, "2024-01-01", stages=["quality"])
    results = spark.read.parquet(f"{transformed}/quality_results")
    assert results.where("check_name = 'dataset_unreadable'").count() == 1
    assert spark.read.parquet(f"{transformed}/data_profiles").count() > 0


def test_failed_jobs_are_no_unreadable_tables(spark, day, monkeypatch):
    run_day(spark, day, "2024-01-01", stages=["ingestion", "transformation"])

    def broken(df, name, as_of):
        return TableAudit(df.where(F.raise_error(F.lit("lost"))), name)

    monkeypatch.setattr("saleslane.plans.quality.audit_table", broken)
    with pytest.raises(Exception, match="lost") as error:
        run_quality(spark, layer_path(day, "transformed", "2024-01-01"), "d", allow_unreadable=True)
    assert not isinstance(error.value, QualityFailure)
    assert not os.path.exists(f"{layer_path(day, 'transformed', '2024-01-01')}/quality_results")


def test_quality_without_any_dataset_fails(spark, tmp_path):
    with pytest.raises(QualityFailure, match="no dataset"):
        run_quality(spark, str(tmp_path), "d")
    assert spark.read.parquet(f"{tmp_path}/quality_results").count() == 4


def test_gate_saves_report_and_profiles_first(spark, sales, tmp_path):
    rows = [(1, "C", "P", 1, 1.0, "2024-01-01 00:00:00", "a", "North")] * 102
    processed, out = str(tmp_path / "p"), str(tmp_path / "t")
    write_layer(sales(rows), processed, ["region"])
    run_transformation(spark, processed, out, "d")
    with pytest.raises(QualityFailure, match="Critical data quality issues found: 1 checks failed"):
        run_quality(spark, out, "d")
    assert spark.read.parquet(f"{out}/quality_results").where("failed_records = 101").count() == 1
    assert spark.read.parquet(f"{out}/data_profiles").count() > 0


def test_hundred_failures_pass_the_gate(spark, sales, tmp_path):
    rows = [(1, "C", "P", 1, 1.0, "2024-01-01 00:00:00", "a", "North")] * 101
    processed, out = str(tmp_path / "p"), str(tmp_path / "t")
    write_layer(sales(rows), processed, ["region"])
    run_transformation(spark, processed, out, "d")
    failed = run_quality(spark, out, "d").collect()
    assert [(x.check_name, x.failed_records) for x in failed] == [("duplicate_ids", 100)]


def test_future_dates_are_taken_as_of(spark, day):
    run_day(spark, day, "2024-01-01")
    transformed = layer_path(day, "transformed", "2024-01-01")
    failed = run_quality(spark, transformed, "d", as_of="2000-01-01 00:00:00")
    assert {x.check_name for x in failed.collect()} == {"future_transaction_date"}
