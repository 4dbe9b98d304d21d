import pytest

from saleslane import jvm
from saleslane.__main__ import arguments, main
from saleslane.session import (
    INITIAL_PARTITIONS,
    JOB_SETTINGS,
    LARGEST_TARGET,
    SHUFFLE_TARGET,
    SKEW_FACTOR,
    SKEW_THRESHOLD,
    create_spark_session,
    partitions_for,
    setting,
    shuffles_sized_for,
)


def test_session_settings(spark):
    assert create_spark_session("again") is spark
    for key, value in JOB_SETTINGS.items():
        assert spark.conf.get(key) == value


def test_setting_is_put_back(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), setting(spark, key, "1MB"):
        assert spark.conf.get(key) == "1MB"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_shuffles_follow_the_size_of_the_input(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100000).write.parquet(path)
    df = spark.read.parquet(path)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    with shuffles_sized_for(df) as number:
        assert number == int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_sized_for(df, target=4096) as number:
        assert 50 < number < 1000
        assert spark.conf.get(INITIAL_PARTITIONS) == str(number)
        plan = df.groupBy((df.id % 7).alias("k")).count()
        assert f", {number})" in plan._jdf.queryExecution().executedPlan().toString()
    with setting(spark, INITIAL_PARTITIONS, "11"), shuffles_sized_for(df, target=1) as number:
        assert number == 11
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_partitions_hold_for_a_hundred_terabytes():
    number, each = partitions_for(100 * 10**12)
    assert each <= LARGEST_TARGET and number * each >= 100 * 10**12
    assert partitions_for(200 * 10**12)[0] == pytest.approx(2 * number, rel=0.01)
    assert partitions_for(10**12) == (-(-(10**12) // SHUFFLE_TARGET), SHUFFLE_TARGET)
    sizes = [10**k for k in range(18)]
    numbers = [partitions_for(size)[0] for size in sizes]
    assert numbers == sorted(numbers) and numbers[0] == 1


def test_plan_for_a_hundred_terabytes(spark, monkeypatch):
    monkeypatch.setattr("saleslane.session.estimated_bytes", lambda df: 100 * 10**12)
    df = spark.range(10)
    before = spark.conf.get(SKEW_THRESHOLD), spark.conf.get(SKEW_FACTOR)
    with shuffles_sized_for(df) as number:
        assert number == partitions_for(100 * 10**12)[0]
        plan = df.groupBy((df.id % 7).alias("k")).count()
        assert f", {number})" in plan._jdf.queryExecution().executedPlan().toString()
        assert spark.conf.get(SKEW_THRESHOLD) == f"{LARGEST_TARGET}b"
        assert spark.conf.get(SKEW_FACTOR) == "2.0"
    assert (spark.conf.get(SKEW_THRESHOLD), spark.conf.get(SKEW_FACTOR)) == before


def test_without_handles_of_the_jvm(spark):
    class Remote:
        """A session or frame as over Spark Connect."""

    assert jvm.estimated_bytes(Remote()) is None
    assert jvm.qualified(Remote(), "/a/b/") == "/a/b"
    assert jvm.qualified(spark, "/a//b") == jvm.qualified(spark, "file:/a/b")


def test_command_line(spark, write_csv, tmp_path, capsys):
    lines = ["1,C,P,2,10.50,2024-01-01 10:00:00,a,North", ",,,,,,,"]
    raw, out = write_csv(lines), str(tmp_path / "out")
    main(["ingestion", "--input-path", raw, "--output-path", out, "--date", "2024-01-01"])
    assert "processed" in capsys.readouterr().out
    assert spark.read.parquet(out).count() == 1  # a session that was there is left running
    for argv in (["ingestion", "--date", "d"], ["cooking"], ["quality", "--input-path", "x"]):
        with pytest.raises(SystemExit):
            arguments(argv)
    assert arguments(["day", "--base", "b", "--date", "d"]).stages == (
        "ingestion", "transformation", "quality",
    )
