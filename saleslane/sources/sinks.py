"""Writing layers and reports."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from saleslane.functions.columns import escaped
from saleslane.jvm import qualified
from saleslane.session import parallelism, setting
from saleslane.sources.publish import Publication, split_path

log = logging.getLogger(__name__)

# Shuffled bytes per output file.
FILE_TARGET = "128MB"
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point of the plan while an action runs, without a scan."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def rows_of(observation: Observation) -> int:
    return observation.get["rows"]


def refuse_overlap(spark: SparkSession, source: str, target: str) -> None:
    """An overwrite clears the target first, so it must not hold the data being read."""
    read, written = f"{qualified(spark, source)}/", f"{qualified(spark, target)}/"
    if read.startswith(written) or written.startswith(read):
        raise ValueError(f"output {target} overlaps input {source}")


def write_layer(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    rebalance: bool = True,
    few_rows: bool = False,
    file_target: str = FILE_TARGET,
    max_records_per_file: int | None = None,
    lossless: bool = False,
) -> int:
    """Replace ``path`` by parquet and return the number of rows written.

    The new version is published when it is complete; until then, and if the write fails or is
    killed, the old one stays readable. See `write_version` for the other options.
    """
    parent, name = split_path(path)
    with Publication(df.sparkSession, parent) as out:
        return write_version(
            df, out, name, partitions, rebalance, few_rows, file_target, max_records_per_file, lossless
        )


def write_version(
    df: DataFrame,
    out: Publication,
    name: str,
    partitions: Sequence[str] = (),
    rebalance: bool = True,
    few_rows: bool = False,
    file_target: str = FILE_TARGET,
    max_records_per_file: int | None = None,
    lossless: bool = False,
) -> int:
    """Write the version of a folder that ``out`` will publish; return the number of rows.

    Without rebalancing, every task writes a file into every partition folder it has rows for.
    Rebalancing brings rows of a folder together, while adaptive execution splits large folders
    and merges small ones to ``file_target``; a large folder is never held by one task.
    Where folders hold a handful of rows each (``few_rows``), the time goes into creating files;
    then folders are dealt out over all tasks that the cluster runs at once, not merged into one.
    The count sits right below the write, where Spark counts each task once, so it stays exact
    when executors are lost. ``lossless`` writes text that folder names cannot hold, such as the empty
    text, in another form, which `read_layer` turns back; other values keep their folder names.
    """
    spark = df.sparkSession
    texts = [c for c in partitions if df.schema[c].dataType == StringType()]
    escapes = texts if lossless and out.files is not None else []
    df = df.withColumns({c: escaped(c) for c in escapes}) if escapes else df
    if partitions and few_rows:
        df = df.repartition(parallelism(spark), *partitions)
    elif partitions and rebalance:
        df = df.hint("rebalance", *partitions)
    df, written = counted(df, "written")
    writer = df.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with setting(spark, ADVISORY_SIZE, file_target):
        writer.parquet(out.stage(name, escaped=escapes))
    rows = rows_of(written)
    log.info("wrote %d rows to %s/%s", rows, out.parent, name)
    return rows


OUTCOME, KEPT, REJECTED = "_outcome", "kept", "rejected"
LINE, REASONS = "_line", "_reasons"


def write_split(
    rows: DataFrame,
    why: str,
    text: str,
    out: Publication,
    name: str,
    rejects: Publication,
    rejects_name: str,
    partitions: Sequence[str],
    rebalance: bool = False,
) -> tuple[int, int]:
    """Write a layer and the lines that do not belong to it in one pass; return how many of each.

    Column ``why`` says why a row is rejected, as texts. A row without a reason goes to the layer, with its
    other columns, and any other to the lines: column ``text`` as LINE, and its REASONS. Nothing
    is shuffled unless ``rebalance`` asks for it.
    """
    spark = rows.sparkSession
    plain = [c for c in rows.columns if c not in (why, text)]
    escapes = [c for c in partitions if rows.schema[c].dataType == StringType()]
    is_kept = F.size(why) == 0
    rows = rows.select(
        *(F.when(is_kept, escaped(c) if c in escapes else F.col(c)).alias(c) for c in plain),
        F.when(~is_kept, F.col(text)).alias(LINE),
        F.when(~is_kept, F.col(why)).alias(REASONS),
        F.when(is_kept, KEPT).otherwise(REJECTED).alias(OUTCOME),
    )
    folders = [OUTCOME, *partitions]
    if rebalance:
        rows = rows.hint("rebalance", *folders)
    # right below the write, where Spark counts each task once
    written = Observation("written")
    rows = rows.observe(
        written,
        F.count_if(F.col(OUTCOME) == KEPT).alias(KEPT),
        F.count_if(F.col(OUTCOME) == REJECTED).alias(REJECTED),
    )
    folder = out.work(name)
    with setting(spark, ADVISORY_SIZE, FILE_TARGET):
        rows.write.partitionBy(*folders).parquet(folder)
    internal = [LINE, REASONS]
    out.adopt(name, f"{folder}/{OUTCOME}={KEPT}", escaped=escapes, internal=internal)
    rejects.adopt(rejects_name, f"{folder}/{OUTCOME}={REJECTED}")
    counts = written.get
    log.info("wrote %d rows to %s/%s, %d rejected", counts[KEPT], out.parent, name, counts[REJECTED])
    return counts[KEPT], counts[REJECTED]


def write_report(df: DataFrame, path: str) -> None:
    """Replace ``path`` by a report of few rows (checks, profiles, metrics) as one file."""
    parent, name = split_path(path)
    with Publication(df.sparkSession, parent) as out:
        write_report_version(df, out, name)


def write_report_version(df: DataFrame, out: Publication, name: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(out.stage(name))
