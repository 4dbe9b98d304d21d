"""Transformation job: cleaned layer to the sales fact and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from saleslane.functions.columns import MONEY_SCALE
from saleslane.operators.enrich import transform_sales_data
from saleslane.operators.running import merged_totals, partial_totals
from saleslane.operators.summaries import SUMMARIES, SUMMARY_SET, Summary, SummarySets
from saleslane.plans.stage import StageMetrics
from saleslane.schema import processed_schema
from saleslane.session import PARQUET_TARGET, shuffles_sized_for
from saleslane.sources.publish import Publication
from saleslane.sources.sinks import refuse_overlap, write_layer, write_version
from saleslane.sources.tables import read_layer, read_version

TRANSFORMED = "transformed_sales"
TRANSFORMED_PARTITIONS = ("region", "year", "month")


# What every customer spent on the day: groups that the totals over days are made of.
DAY_TOTALS = Summary(
    name="day_totals",
    keys=("customer_id",),
    measures={"_spent": ("sum", "total_amount"), "_lines": ("count", "total_amount")},
    partitions=(),
)


def known_schemas(
    raw: StructType | None = None, spark: SparkSession | None = None
) -> dict[str, StructType]:
    """Schemas of the transformed tables, for those that hold no row to infer them from."""
    spark = spark or SparkSession.active()
    fact = transform_sales_data(spark.createDataFrame([], processed_schema(raw)))
    tables = {TRANSFORMED: fact} | {summary.name: summary.of(fact) for summary in SUMMARIES}
    return {name: df.schema for name, df in tables.items()}


def run_transformation(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    date: str,
    rebalance: bool = True,
    schema: StructType | None = None,
    money_scale: int | None = MONEY_SCALE,
    earlier_totals: str | None = None,
    totals_path: str | None = None,
) -> list[StageMetrics]:
    """Write the sales fact and, from one scan of it, the three summaries; publish all four at once.

    ``schema`` is the raw one where it is not the sales schema; it tells the columns of a day without
    usable rows. ``money_scale`` is the precision at which totals are compared with tier bounds.
    Totals and tiers cover the day; with ``earlier_totals`` they also count what customers spent on the
    days up to that table, and with ``totals_path`` the totals up to this day are written there.

    The join behind the customer totals runs once. The summaries come from the written fact in one
    shuffle, and their groups are kept beside them until all are written, so an executor lost
    meanwhile costs no more than a part of that. Readers see four new tables or four old ones.
    """
    refuse_overlap(spark, input_path, output_path)
    processed = read_layer(spark, input_path, if_empty=lambda: processed_schema(schema))
    rows_in = processed.count()  # answered from parquet footers, no column is read
    earlier = read_layer(spark, earlier_totals) if earlier_totals else None
    transformed = transform_sales_data(processed, money_scale=money_scale, earlier=earlier)
    with Publication(spark, output_path) as out:
        with shuffles_sized_for(processed, PARQUET_TARGET):
            rows = write_version(
                transformed, out, TRANSFORMED, TRANSFORMED_PARTITIONS, rebalance, lossless=True
            )
        metrics = [StageMetrics("transformation", TRANSFORMED, rows_in, rows, date)]

        fact = read_version(spark, out.layer(TRANSFORMED), transformed.schema)
        sets = SummarySets((*SUMMARIES, DAY_TOTALS) if totals_path else SUMMARIES)
        with shuffles_sized_for(fact, PARQUET_TARGET):
            groups = sets.of(fact)
            groups.write.partitionBy(SUMMARY_SET).parquet(out.work("summaries"))
        groups = spark.read.schema(groups.schema).parquet(out.work("summaries"))
        for summary in SUMMARIES:
            found = sets.rows(groups, summary)
            with shuffles_sized_for(found, PARQUET_TARGET):
                written = write_version(
                    found, out, summary.name, summary.partitions, rebalance, summary.few_rows,
                    lossless=True,
                )
            metrics.append(
                StageMetrics("transformation", summary.name, rows, written, date, filters=False)
            )
        if totals_path is not None:
            _write_totals(sets.rows(groups, DAY_TOTALS), earlier, totals_path)
    return metrics


def _write_totals(groups: DataFrame, earlier: DataFrame | None, path: str) -> None:
    """The totals up to this day, from groups by customer: no line is read for them.

    They are published before the tables that count them in, and depend on the day before alone, so
    a run that is done again gives the same.
    """
    today = partial_totals(groups, "customer_id", "_spent", "_lines")
    write_layer(today if earlier is None else merged_totals([earlier, today]), path)
