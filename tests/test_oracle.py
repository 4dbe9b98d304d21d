"""Every query against its SQL counterpart, on whole tables."""

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as entry_points
from saleslane.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    """The text operators, which need not be there, have tests of their own."""
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = entry_points.queries()[name](spark, sf_dir)
    assert differences(df, con, entry_points.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["layer_round_trip", "stage_row_counts"])
def test_query_without_a_shared_folder(spark, sf_dir, con, name, monkeypatch):
    """A session in one process may name no folder that executors share."""
    monkeypatch.setattr("saleslane.catalog.sales.shared_folder", lambda session: None)
    df = entry_points.queries()[name](spark, sf_dir)
    assert differences(df, con, entry_points.oracle_sql()[name]) is None


def test_counting_queries_leave_no_files(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr("saleslane.catalog.sales.shared_folder", lambda session: str(tmp_path))
    for name in ("input_precheck", "stage_row_counts"):
        assert QUERIES[name](spark, sf_dir).count() > 0
    assert [file for file in tmp_path.rglob("*") if file.is_file()] == []


THROUGH_FILES = (
    "input_precheck", "scan_sales_csv", "layer_round_trip", "stage_row_counts", "job_fact",
    "job_daily_summary", "job_customer_summary", "job_product_summary", "job_report", "job_profiles",
    "rejected_lines", "running_customer_tier", "duplicate_ids_over_days",
)


def test_making_a_query_runs_no_job(spark, sf_dir):
    """Query functions only describe; those that go through files on purpose are left out."""
    spark.sparkContext.setJobGroup("describe", "describe")
    for name in QUERIES:
        if name not in THROUGH_FILES:
            QUERIES[name](spark, sf_dir)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getJobInfo(job).stageIds for job in tracker.getJobIdsForGroup("describe")]
    # reading the schema of a table takes one task
    assert all(tracker.getStageInfo(s).numTasks <= 1 for ids in stages for s in ids)
