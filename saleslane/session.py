"""Session settings shared by every job."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from saleslane.jvm import estimated_bytes

T, R = TypeVar("T"), TypeVar("R")

# Cluster size, memory and the number of shuffle partitions belong to spark-submit;
# only settings the jobs depend on are named here.
# The last size lets adaptive execution hash a join side instead of sorting both sides, where
# every measured partition of that side fits; it must not be below the file target of the sinks.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SKEW_THRESHOLD = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
SKEW_FACTOR = "spark.sql.adaptive.skewJoin.skewedPartitionFactor"
MIB = 1024**2
# Bytes read per shuffle partition. Blocks grow with map tasks times partitions, so beyond this many
# partitions they get larger, up to the most that a task should sort.
SHUFFLE_TARGET = 256 * MIB
# The same for rows that come from Parquet: in a sort they take some ten times the bytes of their files.
PARQUET_TARGET = 32 * MIB
MANY_PARTITIONS = 25_000
LARGEST_TARGET = 1024 * MIB
# Partitions this many times the median, and larger than the target, are split in joins.
SPLIT_FROM = "2.0"


def create_spark_session(
    app_name: str = "SalesLane", settings: Mapping[str, str] | None = None
) -> SparkSession:
    """Return a session with the job settings, reusing a running one if there is one."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**JOB_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one option for the plans made inside the block, then put the old value back.

    Options belong to the session: two jobs at a time need ``spark.newSession()`` each.
    """
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def child_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with options of its own, which begin as those of ``spark``."""
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and child.conf.get(key, None) != value:
            child.conf.set(key, value)
    return child


def side_by_side(
    spark: SparkSession, work: Callable[[SparkSession, T], R], items: Sequence[T], at_once: int = 4
) -> list[R]:
    """``work`` on every item, up to ``at_once`` at a time, each in a child session.

    The jobs share the cluster; options that one of them sets hold for that one alone. Results are in the
    order of the items. The first error, in that order, is raised when all have ended.
    """
    with ThreadPoolExecutor(max(1, min(at_once, len(items)))) as pool:
        started = [
            pool.submit(inheritable_thread_target(spark)(work), child_session(spark), item)
            for item in items
        ]
    return [one.result() for one in started]


def partitions_for(size: int, target: int = SHUFFLE_TARGET) -> tuple[int, int]:
    """(number of shuffle partitions, bytes in each) for an input of ``size`` bytes.

    The number grows with the bytes, without a limit: by ``target`` each up to MANY_PARTITIONS, then
    with larger partitions, and from LARGEST_TARGET on again in proportion.
    """
    each = min(max(target, size // MANY_PARTITIONS), max(target, LARGEST_TARGET))
    return max(1, -(-size // each)), each


@contextmanager
def shuffles_sized_for(df: DataFrame, target: int = SHUFFLE_TARGET) -> Iterator[int]:
    """Start the shuffles planned inside the block with partitions to suit the size of ``df``.

    Adaptive execution merges partitions but cannot add any, so a fixed number that suits a small
    day does not suit a large one. The number never falls below ``spark.sql.shuffle.partitions``,
    and a number set by the user stays. Where joins split skewed partitions follows the size too.
    """
    spark = df.sparkSession
    configured = spark.conf.get(INITIAL_PARTITIONS, None)
    if configured:
        yield int(configured)
        return
    number, each = partitions_for(estimated_bytes(df) or 0, target)
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), number)
    with (
        setting(spark, INITIAL_PARTITIONS, str(number)),
        setting(spark, SKEW_THRESHOLD, f"{each}b"),
        setting(spark, SKEW_FACTOR, SPLIT_FROM),
    ):
        yield number


def shared_folder(spark: SparkSession) -> str | None:
    """The folder for intermediate data that the session names; all executors share it."""
    return spark.conf.get("spark.checkpoint.dir", None)


def parallelism(spark: SparkSession) -> int:
    """Tasks that the cluster can run at once, as far as the session knows."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    context = getattr(spark, "_sc", None)
    return max(least, context.defaultParallelism) if context is not None else least
