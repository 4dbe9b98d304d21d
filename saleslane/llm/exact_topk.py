"""Exact top-k inner products: tiled matrix products, selection per tile, tree merge.

Candidates are packed into shards and queries into blocks, one row each. Both are dealt over a grid
of cells (query block x group of shards); a cell multiplies its block with each of its shards,
selects the best of every tile, and hands on one short list per query. These lists are merged in
rounds, a fixed number of cells at a time, so no task sees all lists of a query at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslane.llm.shared import stored

SHARD_ROWS = 4096
BLOCK_ROWS = 2048
TILE_ROWS = 256
SHARDS_PER_CELL = 8
FAN_IN = 8
SALTS = 16
EXACT_FLOAT = 2**53
EXACT_INT = 2**62
# The score of a pair that is left out, where it does not fit: no other score is as large.
LARGEST = 2**63 - 1

PACKED = "dim int, part int, number int, rows int, ids binary, keys binary, vectors binary"
LISTS = "query_id bigint, query_key bigint, vec_id bigint, score bigint, own boolean"


def whole_components(df: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, key): components become floor(scale * x); unusable rows are left out.

    Left out are rows without an id, null vectors, and vectors with a null, NaN or infinite component.
    """
    x = F.col("_vector")
    usable = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return (
        df.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("_vector"),
        )
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & usable)
        .select("vec_id", F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))
        .withColumn("key", F.xxhash64("vector"))
    )


def _packer(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs the rows of a task into matrices of at most ``most`` rows, by vector length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple]] = {}
        number = 0

        def packed(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, keys, vectors = zip(*waiting.pop(dim), strict=True)
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            matrix = np.array(vectors, np.int64).reshape(len(ids), dim)[order]
            number += 1
            row = {
                "dim": dim, "part": part, "number": number, "rows": len(ids),
                "ids": np.array(ids, np.int64)[order].tobytes(),
                "keys": np.array(keys, np.int64)[order].tobytes(),
                "vectors": matrix.tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=_packed_schema())

        for batch in batches:
            for vec_id, vector, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = waiting.setdefault(len(vector), [])
                rows.append((vec_id, key, vector))
                if len(rows) == most:
                    yield packed(len(vector))
        for dim in list(waiting):
            yield packed(dim)

    return pack


def _packed_schema() -> pa.Schema:
    return pa.schema(
        [("dim", pa.int32()), ("part", pa.int32()), ("number", pa.int32()), ("rows", pa.int32())]
        + [(name, pa.binary()) for name in ("ids", "keys", "vectors")]
    )


def tile_best(
    queries: np.ndarray, vectors: np.ndarray, most: int, own: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the places and scores of the ``most`` best rows, earlier rows first in ties.

    Scores are whole numbers. They are computed in floating point where that is exact, else in
    64-bit integers; scores of LARGEST or more, or below -LARGEST, raise OverflowError, but those of
    ``own`` pairs become LARGEST.
    """
    rows = len(vectors)
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (queries, vectors)]
    bound = (largest[0] * largest[1] * max(1, queries.shape[1]) + 1) * rows
    if bound >= EXACT_INT:
        scores = _wide_scores(queries, vectors, own)
        # the complement reverses the order, of all 64-bit integers
        places = np.argsort(~scores, axis=1, kind="stable")[:, :most]
        return places, np.take_along_axis(scores, places, axis=1)
    kind = np.float64 if bound < EXACT_FLOAT else np.int64
    scores = queries.astype(kind) @ vectors.astype(kind).T
    # one sortable key for score and place, so that equal scores are cut in order of the ids
    keys = scores * rows - np.arange(rows, dtype=kind)
    if rows > most:
        places = np.argpartition(-keys, most - 1, axis=1)[:, :most]
    else:
        places = np.broadcast_to(np.arange(rows), keys.shape)
    return places, np.take_along_axis(scores, places, axis=1).astype(np.int64)


def _wide_scores(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray | None) -> np.ndarray:
    """All scores in 64-bit integers, however large the components; see `tile_best`."""
    if any(x.max(initial=0) == LARGEST or x.min(initial=0) < -LARGEST for x in (queries, vectors)):
        raise OverflowError("components of these vectors do not fit 64 bits")
    scores = queries @ vectors.T
    sizes = np.abs(queries.astype(np.float64)) @ np.abs(vectors.astype(np.float64)).T
    # Below this size no sum on the way leaves 64 bits; the few others are summed without bounds.
    for i, j in np.argwhere(sizes >= EXACT_INT):
        score = sum(a * b for a, b in zip(queries[i].tolist(), vectors[j].tolist(), strict=True))
        if -LARGEST <= score < LARGEST:
            scores[i, j] = score
        elif own is not None and own[i, j]:
            scores[i, j] = LARGEST
        else:
            raise OverflowError("inner products of these vectors do not fit 64 bits")
    return scores


def _cell(most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def matrix(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, keys, flat = (np.frombuffer(row[x], np.int64) for x in ("ids", "keys", "vectors"))
        return ids, keys, flat.reshape(row["rows"], row["dim"])

    def multiply(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        out = [pa.table({f.name: pa.array([], f.type) for f in _lists_schema()})]
        for block in blocks.to_pylist():
            query_ids, query_keys, queries = matrix(block)
            for at in range(0, len(query_ids), TILE_ROWS):
                of = slice(at, at + TILE_ROWS)
                best: list[tuple[np.ndarray, ...]] = []
                for shard in range(shards.num_rows):
                    ids, keys, vectors = matrix(shards.slice(shard, 1).to_pylist()[0])
                    own = (query_ids[of, None] == ids) & (query_keys[of, None] == keys)
                    places, scores = tile_best(queries[of], vectors, most, own)
                    best.append((scores, ids[places], keys[places]))
                if best:
                    lists = [np.concatenate(x, axis=1) for x in zip(*best, strict=True)]
                    out.append(_shortened(query_ids[of], query_keys[of], *lists, most))
        return pa.concat_tables(out)

    return multiply


def _shortened(query_ids, query_keys, scores, ids, keys, most: int) -> pa.Table:
    """The ``most`` best of each row, as rows of LISTS."""
    width = scores.shape[1]
    line = np.repeat(np.arange(len(query_ids)), width)
    order = np.lexsort((ids.ravel(), ~scores.ravel(), line))
    chosen = order[np.tile(np.arange(width) < most, len(query_ids))]
    line, ids, keys = line[chosen], ids.ravel()[chosen], keys.ravel()[chosen]
    columns = [query_ids[line], query_keys[line], ids, scores.ravel()[chosen]]
    columns.append((columns[0] == ids) & (columns[1] == keys))
    return pa.table(dict(zip(_lists_schema().names, columns, strict=True)), _lists_schema())


def _lists_schema() -> pa.Schema:
    names = ("query_id", "query_key", "vec_id", "score")
    return pa.schema([(name, pa.int64()) for name in names] + [("own", pa.bool_())])


def block_name() -> Column:
    """A name in 64 bits; part and number are below 2^31, so no two blocks share one."""
    return F.shiftleft(F.col("part").cast("long"), 31) + F.col("number")


def top_k(
    df: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query, best first.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own. Ties go to the smaller id; fewer candidates give a shorter list, possibly none. Rows without
    an id and vectors that are null or hold null or non-finite components take no part. Vectors are
    compared with those of the same length; empty vectors score 0. Components and scores that do not fit
    64 bits stop the job; a query's score with itself may. Equal rows under one id are
    several candidates of others and of one another, and as a query have one list; rows with one id
    and different vectors are separate queries. An empty table gives an empty table. Other columns are ignored.
    """
    vectors = whole_components(df, scale, id_col, vector_col)
    is_query = F.col("vec_id") % every == 0
    shards = stored(vectors.mapInArrow(_packer(SHARD_ROWS), PACKED), "shards")
    queries = vectors.where(is_query).dropDuplicates(["vec_id", "key"])
    width = -(-queries.count() // BLOCK_ROWS) or 1
    blocks = stored(
        queries.repartition(width, "vec_id").mapInArrow(_packer(BLOCK_ROWS), PACKED), "blocks"
    )
    # A shard's group and a block's number say in which cells they meet.
    groups = -(-shards.count() // SHARDS_PER_CELL) or 1
    names = block_name()
    block_names = blocks.select("dim", names.alias("block")).distinct()
    left = blocks.withColumns(
        {"block": names, "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))}
    )
    salted = block_names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    right = (
        shards.withColumn("group", F.pmod(F.hash("part", "number"), F.lit(groups)))
        .withColumn("salt", F.pmod(F.xxhash64("part", "number"), F.lit(SALTS)).cast("int"))
        .join(salted, ["dim", "salt"])  # every shard meets every block, as one row for each cell
        .drop("salt")
    )
    cell = ["dim", "block", "group"]
    lists = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInArrow(_cell(k + 1), LISTS)
    )
    return _merged(lists, k, groups)


def _merged(lists: DataFrame, k: int, groups: int) -> DataFrame:
    query = ["query_id", "query_key"]
    best_first = [F.col("score").desc(), F.col("vec_id")]
    # Lists of a query are merged FAN_IN at a time until few are left.
    while groups > FAN_IN:
        groups = -(-groups // FAN_IN)
        bucket = F.pmod(F.xxhash64("vec_id"), F.lit(groups))
        lists = lists.withColumn("bucket", bucket)
        order = Window.partitionBy(*query, "bucket").orderBy(*best_first)
        lists = lists.withColumn("place", F.row_number().over(order))
        lists = lists.where(F.col("place") <= k + 1).drop("place", "bucket")
    ranked = lists.withColumn(
        "place", F.row_number().over(Window.partitionBy(*query).orderBy(*best_first))
    ).where(F.col("place") <= k + 1)
    # Of the k + 1 best, the query's own row goes if it is there: one of several equal rows.
    place, own = F.col("place"), F.col("own_place")
    own_place = F.min(F.when(F.col("own"), place)).over(Window.partitionBy(*query))
    rank = F.when(own < place, place - 1).otherwise(place)
    score = F.when(
        F.col("score") == LARGEST,
        F.raise_error(F.lit("inner products of these vectors do not fit 64 bits")),
    ).otherwise(F.col("score"))
    return (
        ranked.withColumn("own_place", own_place)
        .where(own.isNull() | (place != own))
        .withColumn("rank", rank.cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", score.alias("score"))
    )
