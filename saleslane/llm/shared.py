"""Helpers of the text operators: the given tables and tables kept in the shared folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.jvm import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever the session's executors run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="package-")
    archive = shutil.make_archive(
        os.path.join(folder, package.name), "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a session that runs in one process may do without: then a temporary folder is named.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"name a folder that all executors share in {CHECKPOINT_DIR}")
        folder = tempfile.mkdtemp(prefix="saleslane-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# For each block of `only_result` that is open: the paths of the tables stored in it.
_open: list[list[str]] = []


@contextmanager
def only_result(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that are stored inside the block when it ends well, but for the last one.

    The last one must hold the result of all others; nothing that is read later may need them.
    """
    paths: list[str] = []
    _open.append(paths)
    try:
        yield paths
    finally:
        _open.remove(paths)
    for path in paths[:-1]:
        remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files.

    This cuts the lineage: a lost executor costs a scan, and work behind it is not done twice.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    for paths in _open:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def payload(column: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit("").cast("binary"))
