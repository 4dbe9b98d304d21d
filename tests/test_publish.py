import json
import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from saleslane.sources import publish
from saleslane.sources.publish import Publication, current
from saleslane.sources.sinks import write_layer, write_report, write_version
from saleslane.sources.tables import read_layer


def table(spark, *values):
    return spark.createDataFrame([(v, v % 2) for v in values], "v int, part int")


def values(df):
    return sorted(r.v for r in df.select("v").collect())


def hidden(tmp_path):
    folder = tmp_path / publish.HIDDEN
    return sorted(f for f in os.listdir(folder) if not f.endswith(".crc")) if folder.exists() else None


def test_layers_are_replaced_and_nothing_is_left(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ((1, 2), (3,), (4, 5, 6)):
        assert write_layer(table(spark, *rows), path, ["part"]) == len(rows)
        assert values(read_layer(spark, path)) == values(spark.read.parquet(path)) == list(rows)
    write_report(table(spark, 9), path)
    assert values(spark.read.parquet(path)) == [9]
    assert os.listdir(tmp_path) == ["t"]
    versions = [current(spark, path).version]
    write_report(table(spark, 9), path)
    assert versions[0] < current(spark, path).version


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(table(spark, 1, 2), path)
    broken = spark.range(0, 100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("v")
    )
    with pytest.raises(Exception, match="lost"):
        write_layer(broken, path)
    assert values(read_layer(spark, path)) == values(spark.read.parquet(path)) == [1, 2]
    assert hidden(tmp_path) is None


KILLED = """
import sys, time
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from saleslane.session import create_spark_session
from saleslane.sources.sinks import write_layer

spark = create_spark_session("killed", {"spark.master": "local[2]", "spark.ui.enabled": "false"})

@F.udf(IntegerType())
def slow(v):
    if v == 15:
        time.sleep(60)
    return v

rows = spark.range(0, 16, numPartitions=8).select(slow("id").alias("v"))
write_layer(rows, sys.argv[1])
"""


def test_a_writer_that_is_killed_leaves_the_old_layer(spark, tmp_path):
    """The first tasks have committed their files when the whole process is killed."""
    path = str(tmp_path / "t")
    write_layer(table(spark, 1, 2), path)
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)}
    writer = subprocess.Popen([sys.executable, "-c", KILLED, path], env=env, start_new_session=True)
    try:
        deadline = time.time() + 120
        while not list((tmp_path / publish.HIDDEN).rglob("part-*")) if hidden(tmp_path) else True:
            assert time.time() < deadline and writer.poll() is None
            time.sleep(0.2)
    finally:
        os.killpg(writer.pid, signal.SIGKILL)
        writer.wait()
    assert hidden(tmp_path)  # its version is there, but nothing points to it
    assert values(read_layer(spark, path)) == values(spark.read.parquet(path)) == [1, 2]
    write_layer(table(spark, 3), path)
    assert values(read_layer(spark, path)) == [3]
    assert hidden(tmp_path) is None  # the next writer has removed what was left


def steps(monkeypatch, stop):
    """Let the file system fail at the move or removal number ``stop``; returns how many there were."""
    done = []

    def counted(name):
        plain = getattr(publish.Files, name)

        def run(self, *paths):
            if len(done) == stop:
                raise KeyboardInterrupt
            done.append(name)
            return plain(self, *paths)

        monkeypatch.setattr(publish.Files, name, run)

    for name in ("move", "remove", "write"):
        counted(name)
    return done


def test_a_crash_at_any_step_of_publishing(spark, tmp_path):
    """Readers that follow pointers see all old or all new tables, and the next writer finishes."""
    finished, stop = False, 0
    while not finished:
        folder = tmp_path / str(stop)
        names = ("a", "b")
        for number, name in enumerate(names):
            write_layer(table(spark, number), str(folder / name))
        with pytest.MonkeyPatch.context() as patch:
            done = steps(patch, stop)
            try:
                with Publication(spark, str(folder)) as out:
                    for number, name in enumerate(names):
                        write_version(table(spark, 10 + number), out, name)
                finished = True
            except KeyboardInterrupt:
                pass
        seen = [values(read_layer(spark, str(folder / name))) for name in names]
        assert seen in ([[0], [1]], [[10], [11]]), (stop, done)
        assert (seen == [[10], [11]]) == any(current(spark, str(folder / n)).version == out.version for n in names)
        for number, name in enumerate(names):
            write_layer(table(spark, 20 + number), str(folder / name))
        assert [values(spark.read.parquet(str(folder / n))) for n in names] == [[20], [21]]
        assert sorted(os.listdir(folder)) == ["a", "b"]
        stop += 1
    assert stop > 10


def test_others_in_one_folder_are_left_alone(spark, tmp_path):
    """Two days are written at a time, below one parent."""
    with Publication(spark, str(tmp_path)) as first:
        write_version(table(spark, 1), first, "one")
        with Publication(spark, str(tmp_path)) as second:
            write_version(table(spark, 2), second, "two")
        assert values(read_layer(spark, str(tmp_path / "two"))) == [2]
        assert not (tmp_path / "one").exists()
    assert values(read_layer(spark, str(tmp_path / "one"))) == [1]
    assert sorted(os.listdir(tmp_path)) == ["one", "two"]


def test_without_handles_of_the_jvm(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish.Files, "of", lambda *_: None)
    path = str(tmp_path / "t")
    write_layer(table(spark, 1), path)
    write_layer(table(spark, 2), path, lossless=True)
    assert values(read_layer(spark, path)) == [2] and current(spark, path).version is None


ODD = ["", None, "__HIVE_DEFAULT_PARTITION__", "~", "~~", "~x", "007", "Coast", " ", "a/b=c%", "null"]


def test_lossless_partition_values(spark, tmp_path, capsys):
    rows = [(i, text, text) for i, text in enumerate(ODD)]
    df = spark.createDataFrame(rows, "id int, plain string, region string")
    path = str(tmp_path / "t")
    write_layer(df, path, ["region"], lossless=True)
    for back in (read_layer(spark, path), read_layer(spark, path, df.schema)):
        assert sorted(map(tuple, back.select(df.columns).collect())) == rows
    assert json.loads((tmp_path / "t" / publish.NOTE).read_text())["escaped"] == ["region"]
    assert (tmp_path / "t" / "region=Coast").is_dir()
    # only the folder of the value is read
    one = read_layer(spark, path).where("region = ''")
    assert [r.id for r in one.collect()] == [0] and len(one.inputFiles()) == len(ODD)
    one.explain("formatted")
    filters = [x for x in capsys.readouterr().out.splitlines() if "PartitionFilters" in x]
    assert filters and "region" in filters[0]
