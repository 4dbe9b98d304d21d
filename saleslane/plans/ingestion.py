"""Ingestion job: raw CSV to the cleaned layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslane.operators.clean import clean_data, fill_missing, rejections, with_processing_time
from saleslane.operators.precheck import require_headers
from saleslane.plans.stage import StageMetrics
from saleslane.session import setting, shuffles_sized_for
from saleslane.sources.publish import Publication, split_path
from saleslane.sources.sinks import counted, refuse_overlap, rows_of, write_layer, write_split
from saleslane.sources.tables import MALFORMED, read_sales_csv

# Bytes of raw text per task on large inputs. A task writes one file per region, so larger
# splits mean larger files; what a task buffers while writing is bounded by its split.
SPLIT_SIZE = "512MB"
# Region files a task keeps open at once, instead of sorting its rows by region first.
OPEN_REGIONS = 32


def run_ingestion(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    date: str,
    rebalance: bool = False,
    schema: StructType | None = None,
    by_position: bool = False,
    rejected_path: str | None = None,
) -> list[StageMetrics]:
    """Clean one day of raw CSV and write it by region: one pass, no shuffle, no sort.

    ``rebalance=True`` shuffles the rows to fill larger files; it pays off for small inputs on
    large clusters, where each split is small. ``schema`` replaces the sales schema, for example
    where ids need more than an int. Files whose header has other columns, or another order, are
    refused before anything is written; ``by_position`` binds them by position instead. Lines
    with a cell that does not fit, or with too few cells, are counted as malformed.

    With ``rejected_path`` the lines that are not usable are written there in the same pass, each with
    the reasons, so that every line read is in one of the two; `read_rejected` reads them.
    """
    refuse_overlap(spark, input_path, output_path)
    if rejected_path is not None:
        refuse_overlap(spark, input_path, rejected_path)
        refuse_overlap(spark, output_path, rejected_path)
    if not by_position:
        require_headers(spark, input_path, schema and schema.fieldNames())
    lines = read_sales_csv(spark, input_path, schema, keep_malformed=True)
    read = Observation("read")
    raw = lines.observe(
        read,
        F.count(F.lit(1)).alias("rows"),
        F.count(MALFORMED).alias("malformed"),
    )
    with (
        shuffles_sized_for(raw),
        setting(spark, "spark.sql.files.maxPartitionBytes", SPLIT_SIZE),
        setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_REGIONS)),
    ):
        if rejected_path is None:
            kept, usable = counted(clean_data(raw.drop(MALFORMED)), "usable")
            rows_out = write_layer(kept, output_path, ["region"], rebalance, lossless=True)
            exact, rejected = rows_of(usable) == rows_out, None
        else:
            rows_out, rejected = _split(spark, raw, output_path, rejected_path, rebalance)
            exact = read.get["rows"] == rows_out + rejected
    rows_in, malformed = read.get["rows"], read.get["malformed"]
    if not exact:
        # Before a shuffle, a task that ran again after a lost executor is counted twice.
        rows_in, malformed = lines.agg(F.count(F.lit(1)), F.count(MALFORMED)).first()
    done = [
        StageMetrics("ingestion", "processed", rows_in, rows_out, date, rows_malformed=malformed)
    ]
    if rejected is not None:
        if rows_in != rows_out + rejected:
            raise RuntimeError(f"{rows_in} lines read, but {rows_out} written and {rejected} rejected")
        done.append(StageMetrics("ingestion", "rejected", rows_in, rejected, date, filters=False))
    return done


def _split(
    spark: SparkSession, raw: DataFrame, output_path: str, rejected_path: str, rebalance: bool
) -> tuple[int, int]:
    """Write usable rows and rejected lines; return how many of each."""
    (parent, name), (rejects_parent, rejects_name) = map(split_path, (output_path, rejected_path))
    columns = [c for c in raw.columns if c != MALFORMED]
    text = F.coalesce(MALFORMED, F.to_csv(F.struct(*columns)))
    # rules and text are those of the line as it was read, before gaps are filled
    tagged = raw.withColumns({"_why": rejections(), "_text": text}).drop(MALFORMED)
    rows = with_processing_time(fill_missing(tagged))
    # the lines are published first: a layer is never there without those that it lacks
    with Publication(spark, parent) as out, Publication(spark, rejects_parent) as rejects:
        return write_split(rows, "_why", "_text", out, name, rejects, rejects_name, ["region"], rebalance)
