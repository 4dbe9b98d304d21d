"""Quality rules with cross-document line frequencies, in DataFrame functions alone.

Lines are normalised and hashed together with their host. Lines that stand in many distinct documents
of their host are boilerplate and are removed; a document that consists mostly of them, or that
fails a rule on its own text, is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm.shared import stored

# A line is boilerplate in more than this many documents, and this share of documents, of its host.
MOST_DOCUMENTS = 20
MOST_SHARE = 0.001
# A document is depleted where fewer of its words than this are left.
LEAST_LEFT = 0.3
# The rules on a document by itself.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SPACE = "[\\x20\\x09-\\x0D]+"
NO_SYMBOL = "[^#*$%&|<>]+"


def line_words(text: Column) -> Column:
    """The words of every ``\\n``-split line."""
    return F.transform(
        F.split(text, "\n"), lambda line: F.array_remove(F.split(line, SPACE), F.lit(""))
    )


def line_key(host: Column, words: Column) -> Column:
    """60 bits of the MD5 of a line: its words in lower case, whatever white space is between."""
    normal = F.lower(F.array_join(words, " "))
    name = F.coalesce(F.concat(F.lit("="), host), F.lit(""))
    digest = F.md5(F.concat(name, F.lit("\n"), normal).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _windows(words: Column, of: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """``of`` the three words of every window and its place; an empty array for fewer words."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    made = F.transform(
        places, lambda i: of(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2), i)
    )
    return F.when(F.size(words) >= 3, made)


def with_rules(df: DataFrame) -> DataFrame:
    """Add the measures of the text by itself and ``base_failed`` to rows with ``text``.

    ``lines`` holds the key and number of words of every line. Arrays that are used more than once are
    columns of their own, so that each is made once.
    """
    words, sorted_ = F.col("_words"), F.col("_sorted")
    full_lines = F.filter(
        F.split("text", "\n"), lambda line: F.length(F.regexp_replace(line, SPACE, "")) > 0
    )
    repeats = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    # Equal windows have equal hashes, so without equal hashes there is nothing to sort.
    window = _windows(
        words, lambda a, b, c, i: F.struct(F.concat_ws(" ", a, b, c).alias("w"), i.alias("at"))
    )
    is_double = lambda row, j: (
        F.coalesce(F.get(sorted_, j + 1)["w"] == row["w"], F.lit(False))
        | F.coalesce(F.get(sorted_, j - 1)["w"] == row["w"], F.lit(False))
    )
    under = F.flatten(
        F.transform(F.col("_double.at"), lambda at: F.array(at, at + 1, at + 2))
    )
    return (
        df.withColumn("_line_words", line_words(F.col("text")))
        .withColumn("_words", F.flatten("_line_words"))
        .withColumn("_lines", full_lines)
        .withColumn("_hashes", _windows(words, lambda a, b, c, i: F.xxhash64(a, b, c)))
        .withColumn("_sorted", F.when(repeats, F.array_sort(window)))
        .withColumn("_double", F.filter(sorted_, is_double))
        .select(
            *df.columns,
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("text", NO_SYMBOL, "")).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(F.size(F.array_distinct(under)), F.lit(0)).cast("long").alias("n_repeat_words"),
            F.filter(
                F.transform(
                    "_line_words",
                    lambda line: F.struct(
                        line_key(F.col("host"), line).alias("key"), F.size(line).alias("words")
                    ),
                ),
                lambda line: line["words"] > 0,
            ).alias("lines"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        )
    )


def boilerplate_lines(rows: DataFrame) -> DataFrame:
    """(key): lines above the limits of their host.

    Documents are told apart by a hash of all their lines in order, so exact copies (but for case and
    white space) count as one document of the host, and everything else, near copies too, by itself.
    Both counts are aggregated within tasks before a shuffle; no line or host is gathered anywhere.
    """
    marked = rows.where(F.size("lines") > 0).select(
        "host", "lines", F.xxhash64(F.col("lines.key")).alias("document")
    )
    hosts = marked.groupBy("host").agg(F.count_distinct("document").alias("host_documents"))
    lines = (
        marked.select("host", "document", F.explode(F.array_distinct(F.col("lines.key"))).alias("key"))
        .groupBy("host", "key")
        .agg(F.count_distinct("document").alias("documents"))
        .where(F.col("documents") > MOST_DOCUMENTS)
    )
    return (
        lines.join(hosts, lines["host"].eqNullSafe(hosts["host"]))
        .where(F.col("documents") > MOST_SHARE * F.col("host_documents"))
        .select("key")
        .distinct()
    )


def row_key(doc_id: str, host: str, text: str) -> Column:
    """The MD5 of what a verdict depends on, so that repeated rows share one verdict."""
    parts = [F.col(doc_id).cast("string"), F.col(host), F.col(text)]
    named = [F.coalesce(F.concat(F.lit("="), part), F.lit("")) for part in parts]
    return F.md5(F.concat_ws("\n", *named).cast("binary"))


def judged(
    docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """The verdict on every row, with the keys of the lines to remove.

    Returns doc_id, row_key, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed (keys of boilerplate lines in the text), n_removed (their
    words) and kept. A null text has no words, and fails like any text of fewer than LEAST_WORDS
    words; a text of any length is measured whole; a null host is a host like others. Repeated rows are judged alike and all returned, and an
    empty table gives an empty table. Other columns are ignored.
    """
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    slim = slim.withColumn("row_key", row_key("doc_id", "host", "text"))
    rows = stored(with_rules(slim).drop("text"), "rules")
    in_text = rows.select("row_key", "lines").dropDuplicates(["row_key"])
    found = (
        in_text.select("row_key", F.inline("lines"))
        .join(boilerplate_lines(rows), "key")
        .groupBy("row_key")
        .agg(F.sum("words").alias("n_removed"), F.collect_set("key").alias("removed"))
    )
    left = F.col("n_words") - F.col("n_removed")
    return (
        rows.drop("host", "lines")
        .join(found, "row_key", "left")
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & (left >= LEAST_LEFT * F.col("n_words")))
    )


def without_lines(host: Column, text: Column, removed: Column) -> Column:
    """The text without the lines whose keys are ``removed``; null or no keys leave it as it is."""
    rest = F.filter(
        F.split(text, "\n"),
        lambda line: ~F.array_contains(
            removed, line_key(host, F.array_remove(F.split(line, SPACE), F.lit("")))
        ),
    )
    return F.when(F.size(removed) > 0, F.array_join(rest, "\n")).otherwise(text)


def passed(
    docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are kept, without the boilerplate lines in their texts."""
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("row_key", row_key("doc_id", "host", "text"))
    kept = judged(docs, id_col, host_col, text_col).where("kept").select("row_key", "removed")
    met = packed.join(kept.dropDuplicates(["row_key"]), "row_key").select("row", "host", "removed")
    old = F.col("row")[text_col]
    text = without_lines(F.col("host"), old, F.col("removed"))
    return met.withColumn("text", text).select("row", F.col("text").alias("_text"))


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    return judged(docs).drop("row_key", "removed", "n_removed")
