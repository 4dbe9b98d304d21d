"""Checks across rows and tables: duplicates, composite keys, foreign keys.

All of them collapse equal keys before the shuffle, so a key with a third of the rows, or a
third of the rows being copies, costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.functions.columns import quoted
from saleslane.jvm import estimated_bytes
from saleslane.operators.audit import report_row
from saleslane.schema import check_schema


# Rows of one key that a task should get in a join, and the most keys that may have more; of further ones
# each goes to one task, which changes no result.
ROWS_IN_TASK = 1_000_000
MOST_HEAVY = 1000
# Bytes of a stored table of keys that is broadcast whole, as Spark does by itself with a small table.
FEW_KEYS = 10 * 1024**2


def _one_check(df: DataFrame, failed: Column, **values: str) -> DataFrame:
    """Aggregate ``df`` to a single check row."""
    counted = df.agg(failed.alias("failed"))
    row = report_row(failed_records=F.col("failed"), **values).alias("row")
    return counted.select(row).select("row.*").to(check_schema())


def _empty_checks(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], check_schema())


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"))


def check_referential_integrity(
    df: DataFrame, table_name: str = "unknown", key: str = "id"
) -> DataFrame:
    """Rows beyond the first of each id; null ids are copies of one another.

    Total minus distinct, both from one grouping by the key alone. It stays out of the one-pass
    audit on purpose: there every measure of the table would be carried through the shuffle
    once per id.
    """
    if key not in df.columns:
        return _empty_checks(df)
    surplus = F.coalesce(F.sum("row_count"), F.lit(0)) - F.count(F.lit(1))
    return _one_check(
        key_counts(df, [key]),
        surplus,
        table_name=table_name,
        check_type="integrity",
        check_name=f"duplicate_{key}s",
        rule=f"{key} should be unique",
    )


def uniqueness_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key values that occur more than once, with their number of rows."""
    return key_counts(df, keys).where(F.col("row_count") > 1)


def check_uniqueness(df: DataFrame, keys: Sequence[str], table_name: str = "unknown") -> DataFrame:
    """Number of key values that occur more than once, as a check row."""
    return _one_check(
        uniqueness_violations(df, keys),
        F.count(F.lit(1)),
        table_name=table_name,
        check_type="integrity",
        check_name="unique_" + "_".join(keys),
        rule=f"({', '.join(keys)}) should be unique",
    )


def orphan_keys(
    df: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """Foreign key values without a parent row, with their number of rows. Null keys pass.

    Both sides are reduced to their distinct keys first; the shuffle of that reduction already
    places them for the join, and adaptive execution broadcasts the smaller side if it measures
    small enough.
    """
    parent_keys = parent_keys or keys
    for key in keys:
        df = df.where(quoted(key).isNotNull())
    children = key_counts(df, keys)
    parents = parent.select(
        *[quoted(p).alias(f"_parent_{i}") for i, p in enumerate(parent_keys)]
    ).distinct()
    found = [quoted(k) == F.col(f"_parent_{i}") for i, k in enumerate(keys)]
    return children.join(parents, found, "left_anti")


def matching_rows(
    df: DataFrame,
    keys: Sequence[str],
    counts: DataFrame,
    rows_in_task: int = ROWS_IN_TASK,
    stored: bool = False,
) -> DataFrame:
    """The rows of ``df`` whose key is among ``counts``, which has each key once with its ``row_count``.

    Here rows cannot be collapsed, so a key with a third of them must not go to one task. The join is
    salted in two steps: a key with more rows than a task should get has as many salts as its count
    asks for, and these keys, few and bounded, are made known to the rows by broadcast; then rows and
    keys meet by key and salt. All other keys have one salt. Null keys match null keys.
    Where ``counts`` is ``stored``, its size is known; with at most FEW_KEYS bytes, all its keys are
    broadcast and no row is shuffled.
    """
    names = [f"_key_{i}" for i in range(len(keys))]
    counts = counts.select(*[quoted(k).alias(n) for k, n in zip(keys, names, strict=True)], "row_count")
    salts = F.ceil(F.col("row_count") / rows_in_task).cast("int").alias("_salts")
    heavy = (
        counts.where(F.col("row_count") > rows_in_task)
        .orderBy(F.desc("row_count"), *names)
        .limit(MOST_HEAVY)
        .select(*names, salts)
    )
    same = [quoted(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    size = estimated_bytes(counts) if stored else None
    if size is not None and size <= FEW_KEYS:
        return df.join(F.broadcast(counts.select(*names)), same, "left_semi")
    # any number will do for a row's salt, as each salt of a key says the same
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("_salts", F.lit(1)))
    rows = df.join(F.broadcast(heavy), same, "left").withColumn("_salt", salt.cast("int"))
    spread = [F.col(f"found.{n}").eqNullSafe(F.col(f"heavy.{n}")) for n in names]
    known = (
        counts.alias("found")
        .join(F.broadcast(heavy.alias("heavy")), spread, "left")
        .select(
            *[F.col(f"found.{n}").alias(n) for n in names],
            F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_known_salt"),
        )
    )
    met = [*same, F.col("_salt") == F.col("_known_salt")]
    return rows.drop(*names).join(known, met, "left_semi").select(*[quoted(c) for c in df.columns])


def orphan_rows(
    df: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
    rows_in_task: int = ROWS_IN_TASK,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The rows whose foreign key has no parent row, whole; rows with a null key pass.

    ``store`` writes a table and reads it back. With it the keys are found first, so that rows are not
    shuffled to meet them where they are few.
    """
    found = orphan_keys(df, parent, keys, parent_keys)
    if store is None:
        return matching_rows(df, keys, found, rows_in_task)
    return matching_rows(df, keys, store(found), rows_in_task, stored=True)


def repeated_rows(
    df: DataFrame, keys: Sequence[str], rows_in_task: int = ROWS_IN_TASK
) -> DataFrame:
    """The rows, whole, whose key occurs more than once."""
    return matching_rows(df, keys, uniqueness_violations(df, keys), rows_in_task)


def check_foreign_key(
    df: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
    table_name: str = "unknown",
    parent_name: str = "parent",
) -> DataFrame:
    """Rows whose foreign key has no parent row, as a check row."""
    return _one_check(
        orphan_keys(df, parent, keys, parent_keys),
        F.coalesce(F.sum("row_count"), F.lit(0)),
        table_name=table_name,
        check_type="integrity",
        check_name="orphan_" + "_".join(keys),
        rule=f"({', '.join(keys)}) should exist in {parent_name}",
    )
