"""Keys of earlier days: which ids of a day were there before, without reading the days again.

A day's keys are kept once, with their numbers of rows, in a folder of their own. A new day is compared
with the earlier folders by an exact join, in front of which Spark puts a Bloom filter of the day's
keys: of all earlier keys only those that may be among them are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.operators.audit import kept, report_row
from saleslane.operators.integrity import key_counts
from saleslane.schema import check_schema
from saleslane.session import setting, shuffles_sized_for
from saleslane.sources.sinks import write_layer
from saleslane.sources.tables import PARTITION_INFERENCE

# The filter has so many bits for each key of the day, up to a size that the driver and every task hold.
# For more keys than that it would let too much pass, so none is made.
BITS_PER_KEY = 10
MOST_BITS = 2**30
RUNTIME_FILTER = "spark.sql.optimizer.runtime.bloomFilter"


@contextmanager
def bloom_filter_for(spark: SparkSession, keys: int) -> Iterator[bool]:
    """Let joins planned inside the block filter their left side by so many keys of the right side."""
    bits = max(1024, keys * BITS_PER_KEY)
    options = {
        "enabled": str(bits <= MOST_BITS).lower(),
        "applicationSideScanSizeThreshold": "0",
        "creationSideThreshold": str(2**62),
        "expectedNumItems": str(max(1, keys)),
        "maxNumItems": str(max(1, keys)),
        "numBits": str(min(bits, MOST_BITS)),
        "maxNumBits": str(MOST_BITS),
    }
    with ExitStack() as stack:
        for name, value in options.items():
            stack.enter_context(setting(spark, f"{RUNTIME_FILTER}.{name}", value))
        yield bits <= MOST_BITS


class KeyHistory:
    """The keys of all days below one folder, in order of the text of the day."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def record(self, df: DataFrame, day: str) -> int:
        """Keep the keys of a day; recording it again replaces them. Null keys are copies of one another.

        Where ``df`` is a large table, call this inside `shuffles_sized_for`.
        """
        counts = key_counts(df, [self.key]).withColumnRenamed(self.key, "key")
        return write_layer(counts, f"{self.path}/day={day}")

    def days(self) -> DataFrame:
        """(key, row_count, day) of all days."""
        with setting(self.spark, PARTITION_INFERENCE, "false"):
            return self.spark.read.parquet(self.path)

    def repeated(self, day: str) -> DataFrame:
        """(key, row_count) of the day's keys that earlier days had, null among them.

        The plan is best made inside `bloom_filter_for`; see `check`.
        """
        all_days = self.days()
        today = all_days.where(F.col("day") == day).select("key", "row_count")
        earlier = all_days.where(F.col("day") < day).select("key")
        # the earlier keys are the left side, which the filter of the day's keys makes small
        found = earlier.join(today, "key").distinct()
        missing = (
            all_days.where(F.col("key").isNull() & (F.col("day") <= day))
            .groupBy("key")
            .agg(
                F.count_if(F.col("day") < day).alias("before"),
                F.max(F.when(F.col("day") == day, F.col("row_count"))).alias("row_count"),
            )
            .where((F.col("before") > 0) & F.col("row_count").isNotNull())
        )
        return found.unionByName(missing.select("key", "row_count"))

    def check(self, day: str, table_name: str = "unknown") -> DataFrame:
        """Rows of a recorded day that are not the first with their key, counting earlier days.

        One check row, which is computed at once.
        """
        today = self.days().where(F.col("day") == day)
        rows, keys = today.agg(F.coalesce(F.sum("row_count"), F.lit(0)), F.count(F.lit(1))).first()
        with bloom_filter_for(self.spark, keys), shuffles_sized_for(self.days()):
            # the first row of a key counts too where an earlier day had the key
            again = self.repeated(day).agg(F.count(F.lit(1)).alias("again"))
            row = report_row(
                table_name=table_name,
                check_type="integrity",
                check_name=f"duplicate_{self.key}s_over_days",
                rule=f"{self.key} should be unique over days",
                failed_records=F.lit(rows - keys) + F.col("again"),
            ).alias("row")
            return kept(again.select(row).select("row.*").to(check_schema()))
