"""Reading sales files and written layers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from saleslane.functions.columns import unescaped
from saleslane.schema import define_schema
from saleslane.session import setting
from saleslane.sources.publish import Layer, current

# Partition columns that hold whole numbers.
NUMBER_PARTITIONS = ("year", "month")
WHOLE_FILES = str(2**62)
PARTITION_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def layer_path(base: str, layer: str, date: str) -> str:
    """Folder of one layer (raw, processed, transformed) for one run date."""
    return f"{base.rstrip('/')}/{layer}/{date}"


# Column that holds the text of a line with a cell that does not fit, or with too few cells.
MALFORMED = "_malformed"


def read_sales_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """CSV with a header line. Columns bind by position to the schema (the sales schema by
    default); a cell that does not fit becomes null. ``mismatched_files`` tells which files have
    another order. ``infer`` reads the types from the data instead, which costs an extra pass;
    ``keep_malformed`` adds the text of lines that do not fit as column MALFORMED."""
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    schema = StructType(list((schema or define_schema()).fields))
    if keep_malformed:
        schema = schema.add(MALFORMED, StringType())
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    return reader.schema(schema).csv(path)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the header line of one file; reads no further than that."""
    return spark.read.option("header", True).csv(path).columns


@contextmanager
def _mismatches(
    spark: SparkSession, path: str, columns: Sequence[str] | None
) -> Iterator[DataFrame]:
    """(file, header) of the files whose header does not begin with ``columns`` in order.

    To be read within the block. One task for each file reads its first lines and stops. The first
    line that is not blank is the header; files without one have no rows and are not listed. Names
    are compared without regard to case, as Spark does.
    """
    expected = [name.lower() for name in columns or define_schema().fieldNames()]

    def headers(batches: Iterator) -> Iterator:
        import csv

        import pyarrow

        for batch in batches:
            for line, file in zip(batch[0], batch[1], strict=True):
                text = line.as_py().lstrip("\ufeff").strip()
                if not text:
                    continue
                names = [x.strip() for x in next(csv.reader([text]))]
                if [x.lower() for x in names[: len(expected)]] != expected:
                    found = {"file": [file.as_py()], "header": [names]}
                    yield pyarrow.RecordBatch.from_pydict(found)
                return  # the rest of the file is not read

    # a file is one split, and shares its task with no other
    with (
        setting(spark, "spark.sql.files.maxPartitionBytes", WHOLE_FILES),
        setting(spark, "spark.sql.files.openCostInBytes", WHOLE_FILES),
    ):
        lines = spark.read.text(path).select("value", "_metadata.file_path")
        yield lines.mapInArrow(headers, "file string, header array<string>")


def mismatched_files(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, most: int = 20
) -> list[tuple[str, list[str]]]:
    """(file, header) of up to ``most`` files whose header does not begin with ``columns`` in order."""
    with _mismatches(spark, path, columns) as found:
        return sorted((row["file"], row["header"]) for row in found.take(most))


def count_mismatched_files(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> int:
    """How many files have a header that does not begin with ``columns`` in order."""
    with _mismatches(spark, path, columns) as found:
        return found.count()


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    if_empty: Callable[[], StructType] | None = None,
) -> DataFrame:
    """Parquet layer with its partition columns last.

    The published version is read, also while it still waits to be moved into place.
    Partition values keep their text (region ``007`` stays ``007``); year and month are
    numbers. With a schema, nothing is inferred and no footer is read for it. A partitioned layer
    without rows has no files to infer from; it is read with the schema that ``if_empty`` gives.
    """
    return read_version(spark, current(spark, path), schema, if_empty)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """(line, reasons) of the lines that ingestion has rejected: their text as read, and why.

    Lines that fit the schema are written anew as CSV, the others are kept to the letter.
    """
    lines = spark.read.schema("_line string, _reasons array<string>").parquet(current(spark, path).path)
    return lines.select(F.col("_line").alias("line"), F.col("_reasons").alias("reasons"))


def read_version(
    spark: SparkSession,
    layer: Layer,
    schema: StructType | None = None,
    if_empty: Callable[[], StructType] | None = None,
) -> DataFrame:
    """One version of a layer, published or not, as `read_layer` reads it."""
    df = _read(spark, layer.path, schema, if_empty).drop(*layer.note.get("internal", ()))
    columns = {c: unescaped(c) for c in layer.note.get("escaped", ()) if c in df.columns}
    return df.withColumns(columns) if columns else df


def _read(
    spark: SparkSession,
    path: str,
    schema: StructType | None,
    if_empty: Callable[[], StructType] | None,
) -> DataFrame:
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    try:
        with setting(spark, PARTITION_INFERENCE, "false"):
            df = spark.read.parquet(path)
    except AnalysisException as error:
        if if_empty is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(if_empty()).parquet(path)
    numbers = {
        f.name: F.col(f.name).cast("int")
        for f in df.schema
        if f.name in NUMBER_PARTITIONS and isinstance(f.dataType, StringType)
    }
    return df.withColumns(numbers) if numbers else df
