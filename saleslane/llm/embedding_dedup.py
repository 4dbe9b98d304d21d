"""Near-duplicate vectors: sign hashing in several tables, exact cosines, connected components.

Random hyperplanes cut the space; the sides on which a vector lies name its bucket, in each of several
tables. Vectors that share a bucket are compared exactly, in cells of bounded size, and the links
found are joined to components in Spark rounds. Equal vectors are one class with a number of copies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from saleslane.llm.components import local_forest, roots
from saleslane.llm.shared import stored

THRESHOLD = 0.9
# Least share of pairs right at the threshold that some table finds; closer pairs are found more often.
RECALL = 0.99
# A bucket of evenly spread vectors has at most so many rows; the number of hyperplanes follows.
BUCKET_ROWS = 1024
LEAST_BITS, MOST_BITS = 6, 30
# Rows on one side of a cell. A larger bucket is dealt into blocks, which meet two at a time.
BLOCK_ROWS = 2048
TILE_ROWS = 1024
SEED = 2026
# Rows of a broadcast: some 30 bytes each. A longer list of large buckets is joined by shuffle.
MOST_BROADCAST = 100_000

FOUND = "uid long, links long, root long"
BUCKET = ["dim", "table", "bucket"]


def bits_for(rows: int) -> int:
    """Hyperplanes of a table, so that buckets stay small however many rows there are."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS))))


def tables_for(bits: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Tables so that a pair at the threshold shares a bucket in one of them with this probability."""
    same_side = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(1 - recall) / math.log(1 - same_side**bits))


def hyperplanes(dim: int, bits: int, tables: int) -> np.ndarray:
    """Directions in columns, the same ones in every task."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Doubles of the same directions, brought near 1 by powers of two, which changes no digit."""
    vectors = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    half = -exponent // 2  # in two steps, as one may leave the range of doubles
    return np.ldexp(np.ldexp(vectors, half[:, None]), (-exponent - half)[:, None])


def buckets_of(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket of every row in every table: its sides as the bits of a number."""
    sides = scaled(vectors) @ hyperplanes(vectors.shape[1], bits, tables) >= 0
    weights = 1 << np.arange(bits, dtype=np.int32)
    return sides.reshape(len(vectors), tables, bits) @ weights


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _signer(bits: int, tables: int) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pc.list_value_length(batch["vector"]).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                made = buckets_of(_matrix(part["vector"], dim), bits, tables)
                flat, ends = pa.array(made.ravel()), np.arange(0, made.size + 1, tables)
                buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat.cast(pa.int32()))
                columns = [part[name] for name in ("uid", "least", "copies", "vector")]
                yield pa.record_batch(
                    [*columns, pa.array(np.full(len(made), dim)), buckets],
                    names=["uid", "least", "copies", "vector", "dim", "buckets"],
                )

    return sign


def _vector(df: DataFrame, column: str) -> Column:
    """The vector as it is if it holds floats, else in doubles."""
    kind = df.schema[column].dataType
    same = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    return F.col(f"`{column}`").cast("array<float>" if same else "array<double>")


def _usable() -> Column:
    """Whether a vector has a direction: no component is null, NaN or infinite, and one is not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", finite)
        & F.exists("vector", lambda x: x != 0)
    )


def linked(
    unit: np.ndarray, norms: np.ndarray, buckets: np.ndarray, table: int, threshold: float,
    rows: slice, others: slice,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, other) of a tile at the threshold or above that share no bucket in an earlier table."""
    cosines = (unit[rows] @ unit[others].T) / (norms[rows, None] * norms[None, others])
    a, b = np.nonzero(cosines >= threshold)
    a, b = a + rows.start, b + others.start
    for earlier in range(table):
        new = buckets[a, earlier] != buckets[b, earlier]
        a, b = a[new], b[new]
    return a, b


def _comparer(threshold: float) -> Callable[[pa.Table], pa.Table]:
    def compare(group: pa.Table) -> pa.Table:
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        group = group.sort_by("own")  # the lower block first
        uid, copies = group["uid"].to_numpy(), group["copies"].to_numpy()
        vectors = scaled(_matrix(group["vector"], group["dim"][0].as_py()))
        norms = np.sqrt((vectors**2).sum(axis=1))
        table = group["table"][0].as_py()
        buckets = _matrix(group["buckets"], len(group["buckets"][0]))
        size = len(uid)
        within = low == high
        first = size if within else int(np.searchsorted(group["own"].to_numpy(), high))
        links = np.zeros(size, np.int64)
        members, tops = [], []
        for at in range(0, first, TILE_ROWS):
            rows = slice(at, min(at + TILE_ROWS, first))
            # within one block a tile meets itself and later tiles, else all tiles of the other block
            for other in range(at if within else first, size, TILE_ROWS):
                others = slice(other, min(other + TILE_ROWS, size))
                a, b = linked(vectors, norms, buckets, table, threshold, rows, others)
                if within:
                    a, b = a[a < b], b[a < b]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                member, top = local_forest(uid[a], uid[b])
                members.append(member)
                tops.append(top)
        member, top = local_forest(np.concatenate([*members, uid[:0]]), np.concatenate([*tops, uid[:0]]))
        root_of = dict(zip(member.tolist(), top.tolist(), strict=True))
        found = np.flatnonzero(links)
        return pa.table(
            {
                "uid": pa.array(uid[found], pa.int64()),
                "links": pa.array(links[found], pa.int64()),
                "root": pa.array([root_of.get(u) for u in uid[found].tolist()], pa.int64()),
            }
        )

    return compare


def _cells(classes: DataFrame) -> DataFrame:
    """Every class once for each cell in which one of its buckets is compared.

    A bucket of up to BLOCK_ROWS rows is one cell. A larger one is dealt into blocks by a hash, and every
    two blocks meet in a cell, so no task sees more than two blocks.
    """
    exploded = F.posexplode("buckets").alias("table", "bucket")
    sizes = classes.select("dim", exploded).groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("size"))
    large = stored(sizes.where(F.col("size") > BLOCK_ROWS), "large-buckets")
    if large.count() <= MOST_BROADCAST:
        large = F.broadcast(large)
    blocks = F.coalesce(F.ceil(F.col("size") / BLOCK_ROWS), F.lit(1)).cast("int")
    dealt = (
        classes.select("uid", "copies", "dim", "vector", "buckets", exploded)
        .join(large, BUCKET, "left")
        .withColumn("own", F.pmod(F.xxhash64("uid"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    )
    return dealt.select(
        *("uid", "copies", "vector", "buckets", *BUCKET, "own"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
    )


def near_duplicates(
    df: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows link whose cosine, in doubles, is ``threshold`` or more; n_links counts the other rows that a
    row links with, component_id is the smallest id that links reach, itself included, and a row is
    kept if that is its own. A pair at the threshold is found with probability ``recall``, a closer
    one more often, equal directions always; no pair below the threshold links.

    Vectors that are null, empty, zero, or hold a null, NaN or infinite component link with nothing,
    nor do rows without an id, whose component_id is null and which are kept. Vectors of different
    lengths never link. Equal rows link with one another, and all are returned; rows with one id and
    different vectors are separate. An empty table gives an empty table; other columns are ignored,
    and vectors of any length are compared whole.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), _vector(df, vector_col).alias("vector"))
    usable = F.coalesce(_usable(), F.lit(False))
    bits = bits_for(df.count())  # from the footers of stored tables
    tables = tables_for(bits, threshold, recall)
    vector_type = rows.schema["vector"].dataType.simpleString()
    signed = f"uid long, least long, copies long, vector {vector_type}, dim int, buckets array<int>"
    classes = stored(
        rows.where(usable)
        .groupBy("vector")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("uid", F.monotonically_increasing_id())
        .mapInArrow(_signer(bits, tables), signed),
        "vector-classes",
    )
    # read from files on both sides, so that the rows of one common vector can be split
    members = stored(
        rows.where(usable).join(classes.select("vector", "uid", "copies"), "vector").drop("vector"),
        "vector-members",
    )
    cell = [*BUCKET, "low", "high"]
    found = stored(
        _cells(classes).groupBy(*cell).applyInArrow(_comparer(threshold), FOUND), "vector-links"
    )
    links = found.where(F.col("root").isNotNull())
    forest = roots(links.select(F.col("uid").alias("node"), F.col("root").alias("next")))
    named = stored(
        classes.select("uid", "least")
        .join(forest.withColumnRenamed("node", "uid"), "uid", "left")
        .withColumn("root", F.coalesce("root", "uid")),
        "vector-roots",
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    marks = (
        named.select("uid", "root")
        .join(least, "root")
        .join(found.groupBy("uid").agg(F.sum("links").alias("links")), "uid", "left")
        .drop("root")
    )
    linked_rows = members.join(marks, "uid").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    alone = rows.where(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked_rows.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
