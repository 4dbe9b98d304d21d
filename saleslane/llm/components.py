"""Connected components of links between rows, in Spark rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.llm.shared import stored


def _with_smallest(links: DataFrame) -> DataFrame:
    """(node, next, smallest): each link with the smallest of the node's neighbours.

    The smallest is aggregated first and joined back, so the links of a hub are never one group.
    """
    smallest = links.groupBy("node").agg(F.min("next").alias("smallest"))
    return links.join(smallest, "node")


def large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of node and neighbours."""
    both = links.unionByName(links.select(F.col("next").alias("node"), F.col("node").alias("next")))
    root = F.least("node", "smallest")
    larger = _with_smallest(both).where(F.col("next") > F.col("node"))
    return larger.select(F.col("next").alias("node"), root.alias("next")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of those."""
    smaller = _with_smallest(links)  # links lead from the larger to the smaller node
    chosen = smaller.select("node", F.col("smallest").alias("next")).unionByName(
        smaller.select(F.col("next").alias("node"), F.col("smallest").alias("next"))
    )
    return chosen.where(F.col("node") != F.col("next")).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots; a root is the smallest of its component.

    ``links`` holds pairs (node, next) of longs in any direction, repeated or not. Large and small
    stars alternate until nothing changes; each round is kept in the shared folder.
    """
    links = links.select(
        F.greatest("node", "next").alias("node"), F.least("node", "next").alias("next")
    )
    links = stored(links.where(F.col("node") != F.col("next")).distinct(), "links")
    before = None
    while True:
        links = stored(small_star(large_star(links)), "links")
        mix = F.xxhash64("node", "next")
        after = links.agg(
            F.count(F.lit(1)), F.bit_xor(mix), F.sum(F.shiftright(mix, 24))
        ).first()
        if after == before:
            return links.select("node", F.col("next").alias("root"))
        before = after


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with fewer links: (member, root) for all members but the roots."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    member = root != np.arange(len(names))
    return names[member], names[root[member]]
