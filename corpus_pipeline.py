"""From documents to packed training sequences, as a row of stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saleslane.jvm import remove
from saleslane.llm.shared import only_result, ship_package, stored, table
from saleslane.llm.stages import (
    near_dedup_stage,
    packing_stage,
    quality_rules_stage,
    substring_dedup_stage,
    toxicity_stage,
)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_rules_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

# Trained scores and packing are beyond SQL; the run is tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what all stages keep of ``documents``.

    Each stage's result is written; when the next one is, all that was stored on the way to it goes.
    """
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        with only_result(spark) as made:
            docs = stored(stage(spark, docs, sf_dir), name)
        for path in before:
            remove(spark, path)
        before = made[-1:]
    return docs
