from pyspark.sql import functions as F

from saleslane.operators.integrity import key_counts, matching_rows, orphan_rows, repeated_rows


def lines(spark):
    """Twelve thousand rows, a third of them with one key, one in six with none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 6 != 1, 100 + F.col("id") % 500)
    return spark.range(0, 12_000, numPartitions=6).select("id", key.alias("a.b"), F.lit("x").alias("row_count"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_rows_without_a_parent(spark):
    df = lines(spark)
    parents = spark.createDataFrame([(k,) for k in range(100, 400)] + [(None,)], "k long")
    expected = ids(df.where((F.col("`a.b`") == 7) | (F.col("`a.b`") >= 400)))
    assert 4000 < len(expected) < 12_000
    for rows_in_task in (10**6, 500, 7):
        found = orphan_rows(df, parents, ["a.b"], ["k"], rows_in_task)
        assert found.columns == df.columns and ids(found) == expected
    assert ids(orphan_rows(df.limit(0), parents, ["a.b"], ["k"])) == []
    assert ids(orphan_rows(df, parents.limit(0), ["a.b"], ["k"], 500)) == ids(df.where("`a.b` is not null"))


def test_rows_with_a_key_that_repeats(spark):
    rows = [(1, None, "x"), (2, None, "x"), (3, 1, "x"), (4, 1, "y"), (5, 1, "x"), (6, 2, None), (7, 2, None)]
    df = spark.createDataFrame(rows, "id long, k long, t string")
    for rows_in_task in (10**6, 1):
        assert ids(repeated_rows(df, ["k", "t"], rows_in_task)) == [1, 2, 3, 5, 6, 7]
        assert ids(repeated_rows(df, ["k"], rows_in_task)) == [1, 2, 3, 4, 5, 6, 7]


def test_a_heavy_key_is_spread_over_tasks(spark, capsys):
    """Without help from adaptive execution, which cannot split before it has seen a skewed partition."""
    df, options = lines(spark), {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in options}

    def tasks_of_seven(rows_in_task):
        found = matching_rows(df, ["a.b"], key_counts(df, ["a.b"]), rows_in_task)
        parts = found.where("`a.b` = 7").groupBy(F.spark_partition_id()).count().collect()
        found.explain()
        plan = capsys.readouterr().out
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
        assert "_salt" in plan.split("LeftSemi")[1]
        return [r["count"] for r in parts]

    try:
        for key, value in options.items():
            spark.conf.set(key, value)
        assert len(tasks_of_seven(10**6)) == 1
        spread = tasks_of_seven(100)  # 4,000 rows in 40 salts
        assert len(spread) >= 12 and max(spread) <= 4000 / 4 and sum(spread) == 4000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
