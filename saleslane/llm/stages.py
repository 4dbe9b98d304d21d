"""The stages of the corpus pipeline: each applies one operator to the documents it is given.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``, in their order;
columns that no operator knows are handed through. Where a text changes, ``n_chars`` follows it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.llm import harmonic_packing, quality_rules, simhash_dedup, substring_dedup, toxicity
from saleslane.llm.shared import ship_package, table

TOKENIZER = "word_bpe_49k.json"


def _with_text(rows: DataFrame, like: DataFrame, text: Column, changed: Column) -> DataFrame:
    """The columns of ``like`` from the struct ``row``, with ``text`` where it has changed."""
    values = {
        "text": F.when(changed, text).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.length(text)).otherwise(F.col("row.n_chars"))
        if "n_chars" in like.columns
        else None,
    }
    columns = []
    for name, kind in like.dtypes:
        value = values.get(name)
        columns.append((F.col(f"row.`{name}`") if value is None else value.cast(kind)).alias(name))
    return rows.select(*columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5 stay. The model is fitted on these documents' labels.

    Null and empty texts and null ids have a score too; an empty table stays empty.
    """
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(docs, model) < 0.5)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules stay, without boilerplate lines.

    Null and empty texts have too few words and go; repeated rows share one verdict; an empty table stays empty.
    """
    rows = quality_rules.passed(docs)
    changed = ~F.col("_text").eqNullSafe(F.col("row.text"))
    return _with_text(rows, docs, F.col("_text"), changed)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays.

    Null and empty texts are one group; a row without an id stays only where its group has none with one; of
    repeated rows one stays. An empty table stays empty.
    """
    ship_package(spark)
    return simhash_dedup.survivors(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated stretches go; a text that loses words keeps the others, joined by one space.

    A document may be left with an empty text; a null text comes back as an empty one.
    """
    ship_package(spark)
    rows = substring_dedup.deduplicated(docs)
    others = [F.col(f"_row.`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(*others, F.col("_text").cast("string").alias("text"))
    kept, lost = F.col("kept").cast("string"), F.col("n_removed") > 0
    return _with_text(rows.withColumn("row", row), docs, kept, lost)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids.

    A null or empty text is a document of one id, the end mark; an empty table gives no pieces.
    """
    ship_package(spark)
    packed = harmonic_packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return packed.withColumn("ids_crc32", F.crc32("ids"))
