"""SimHash near-duplicates by meeting in the middle.

Two fingerprints within R bits have a value between them that is near to both. Every fingerprint
therefore emits the variants within half of R, rounded down or up by its parity so that all
variants have one parity, and the largest part of the fingerprints emits few. Fingerprints that
meet in a variant at distances whose sum is R or less are linked; each link is verified.

The shuffle is on the variants' first bits: a fingerprint goes once to every prefix that its
variants have, and the rest of each variant is made where that prefix is worked on.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm.components import local_forest, roots
from saleslane.llm.shared import payload, stored

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
# Variants that one task works on at a time; the number of prefix bits follows from it.
VARIANTS_PER_PREFIX = 4_000_000
LEAST_PREFIX_BITS = 8
# Prefixes with more variants than this are split, by so many bits at a time.
MOST_VARIANTS = 2 * VARIANTS_PER_PREFIX
FURTHER_BITS = 6
# Rows of a broadcast list of large prefixes, 8 bytes each; a longer one is joined by shuffle.
MOST_BROADCAST = 100_000
CHUNK = 2_000_000


def fingerprint(text: bytes, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The majority of each bit over the XXH64 of all shingles, as an unsigned number.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than a shingle count as one
    shingle; without words the result is zero.
    """
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[words_in_shingle - 1 :] or [len(line)]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=False)])
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8), axis=1)
    majority = bits.sum(axis=0, dtype=np.int32) * 2 > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def fingerprint_column(text: str = "text", words_in_shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a signed long; null counts as an empty text."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        made = [fingerprint(bytes(x), words_in_shingle) for x in texts]
        return pd.Series(np.array(made, np.uint64).view(np.int64))

    return of(payload(text))


def distances(parity: int, most: int) -> list[int]:
    """At which distances a fingerprint of this parity emits variants.

    For an even radius: all up to its half. For an odd one, variants share the parity that odd
    fingerprints reach at half the radius rounded down; even ones go one bit further.
    """
    half = most // 2
    if most % 2 == 0:
        return list(range(half + 1))
    reach = half if parity else half + 1
    return list(range(reach % 2, reach + 1, 2))


def _masks(prefix_bits: int, parity: int, most: int) -> list[tuple[int, int]]:
    """(mask, flips) of all ways to flip bits of the prefix."""
    found = []
    for flips in range(min(max(distances(parity, most)), prefix_bits) + 1):
        for places in combinations(range(BITS - prefix_bits, BITS), flips):
            found.append((sum(1 << place for place in places), flips))
    return found


def _flips(width: int, count: int) -> np.ndarray:
    """All numbers of ``width`` bits with ``count`` ones."""
    if count == 0:
        return np.zeros(1, np.uint64)
    places = np.array(list(combinations(range(width), count)), np.uint64).reshape(-1, count)
    return np.bitwise_or.reduce(np.uint64(1) << places, axis=1)


def meet(fps: np.ndarray, flips: np.ndarray, prefix_bits: int, most: int) -> tuple:
    """Links (a, b) between fingerprints that meet in a variant with one given prefix.

    ``flips`` says how many bits of a fingerprint's prefix differ from the given one. Links of one
    variant start from the member nearest to it, so their number grows with the members alone.
    """
    width = BITS - prefix_bits
    low = fps & np.uint64((1 << width) - 1)
    parity = np.bitwise_count(fps) & 1

    def variants(of: int, apart: int, rows: np.ndarray):
        """Chunks of (variant, row) for rows of one parity at one distance."""
        for used in range(apart + 1):
            chosen = rows[(parity[rows] == of) & (flips[rows] == used)]
            masks = _flips(width, apart - used) if apart - used <= width else None
            if masks is None or not len(chosen):
                continue
            step = max(1, CHUNK // len(masks))
            for at in range(0, len(chosen), step):
                part = chosen[at : at + step]
                yield (low[part, None] ^ masks).ravel(), np.repeat(part, len(masks))

    every = np.arange(len(fps))
    # Those near enough to be the middle of a link, nearest first.
    near: list[tuple] = []
    for apart in range(most // 2 + 1):
        for of in (0, 1):
            if apart in distances(of, most):
                made = variants(of, apart, every)
                near += [(v, r, np.full(len(v), apart, np.int8)) for v, r in made]
    if not near:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    value, row, apart = (np.concatenate(x) for x in zip(*near, strict=True))
    order = np.lexsort((apart, value))
    value, row = value[order], row[order]
    first = np.concatenate([[True], value[1:] != value[:-1]])
    head = np.flatnonzero(first)
    centre = row[np.repeat(head, np.diff([*head, len(value)]))]
    pairs = [np.stack([centre[~first], row[~first]])]
    # The others look up a centre: a table of marks first, then a search in what is left.
    names, owner, nearness = value[head], row[head], apart[order][head]
    bits = max(10, int(len(names)).bit_length() + 3)
    marks = np.zeros(1 << bits, bool)
    spread = lambda v: (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    marks[spread(names)] = True
    for of in (0, 1):
        for far in (x for x in distances(of, most) if x > most // 2):
            for v, r in variants(of, far, every):
                maybe = np.flatnonzero(marks[spread(v)])
                v, r = v[maybe], r[maybe]
                at = np.minimum(np.searchsorted(names, v), len(names) - 1)
                met = (names[at] == v) & (nearness[at] + far <= most)
                pairs.append(np.stack([owner[at[met]], r[met]]))
    a, b = np.concatenate(pairs, axis=1)
    a, b = fps[a], fps[b]
    close = (np.bitwise_count(a ^ b) <= most) & (a != b)
    return a[close], b[close]


def links_between(distinct: DataFrame, most: int = MAX_DISTANCE) -> DataFrame:
    """(node, next): links that connect all of ``distinct`` (column ``fp``) within ``most`` bits.

    Where one prefix has far more variants than others, as in a large family of near copies, it is
    split by further bits until none has more than a task may work on.
    """
    variants = max(sum(comb(BITS, x) for x in distances(p, most)) for p in (0, 1))
    number = distinct.count()
    prefix_bits = ceil(log2(max(1, number * variants / VARIANTS_PER_PREFIX)))
    prefix_bits = min(max(LEAST_PREFIX_BITS, prefix_bits), BITS // 2)

    whole = distinct.select(
        "fp", F.lit(0).cast("byte").alias("flips"), F.lit(0).cast("long").alias("prefix")
    )
    dealt, found = _dealt(whole, 0, prefix_bits, most), []
    while True:
        large = stored(_large_prefixes(dealt, prefix_bits, most), "large")
        number = large.count()
        if prefix_bits == BITS or not number:
            return reduce(DataFrame.unionByName, [*found, _links(dealt, prefix_bits, most)])
        if number <= MOST_BROADCAST:
            large = F.broadcast(large)
        found.append(_links(dealt.join(large, "prefix", "left_anti"), prefix_bits, most))
        more = min(FURTHER_BITS, BITS - prefix_bits)
        dealt = _dealt(dealt.join(large, "prefix", "left_semi"), prefix_bits, more, most)
        dealt = stored(dealt, "dealt")
        prefix_bits += more


def _dealt(rows: DataFrame, prefix_bits: int, more: int, most: int) -> DataFrame:
    """``rows`` (fp, flips, prefix) by prefixes that are ``more`` bits longer.

    A fingerprint goes once to each longer prefix that its variants have.
    """

    def masks(parity: int) -> Column:
        ways = [
            F.struct(
                F.lit(mask >> (BITS - more)).cast("long").alias("mask"), F.lit(flips).alias("used")
            )
            for mask, flips in _masks(more, parity, most)
        ]
        return F.array(*ways)

    odd = F.bit_count("fp") % 2 == 1
    reach = F.when(odd, max(distances(1, most))).otherwise(max(distances(0, most)))
    rest = F.shiftrightunsigned("fp", BITS - prefix_bits - more)
    bits = rest.bitwiseAND(F.lit((1 << more) - 1).cast("long"))
    flips = F.col("flips") + F.col("way.used")
    return (
        rows.withColumn("way", F.explode(F.when(odd, masks(1)).otherwise(masks(0))))
        .where(flips <= reach)
        .select(
            "fp",
            flips.cast("byte").alias("flips"),
            F.shiftleft("prefix", more)
            .bitwiseOR(bits.bitwiseXOR(F.col("way.mask")))
            .alias("prefix"),
        )
    )


def _large_prefixes(dealt: DataFrame, prefix_bits: int, most: int) -> DataFrame:
    """(prefix): those with more than MOST_VARIANTS variants to be made."""
    width = BITS - prefix_bits
    made = F.lit(0)
    for parity in (0, 1):
        for flips in range(max(distances(parity, most)) + 1):
            number = sum(comb(width, x - flips) for x in distances(parity, most) if x >= flips)
            like = (F.bit_count("fp") % 2 == parity) & (F.col("flips") == flips)
            made = F.when(like, number).otherwise(made)
    counted = dealt.groupBy("prefix").agg(F.sum(made.cast("long")).alias("variants"))
    return counted.where(F.col("variants") > MOST_VARIANTS).select("prefix")


def _links(dealt: DataFrame, prefix_bits: int, most: int) -> DataFrame:
    """The links that each prefix of ``dealt`` gives."""

    def work(group: pa.Table) -> pa.Table:
        fps = group["fp"].to_numpy().view(np.uint64)
        a, b = meet(fps, group["flips"].to_numpy(), prefix_bits, most)
        member, root = local_forest(a.view(np.int64), b.view(np.int64))
        return pa.table({"node": member, "next": root})

    return dealt.groupBy("prefix").applyInArrow(work, "node bigint, next bigint")


def classes_of(rows: DataFrame, most: int = MAX_DISTANCE) -> DataFrame:
    """(fp, component_id, survivor) for every fingerprint of ``rows`` (fp, doc_id, uid).

    ``component_id`` is the smallest id that links reach, and ``survivor`` the ``uid`` of a row that has
    it: the least, if several have. Of rows without ids alone, the least ``uid`` survives.
    """
    # nulls come last: a row without an id is first only where there is no other
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    # Equal fingerprints are one node, however many documents share it.
    nodes = stored(rows.groupBy("fp").agg(first.alias("first")), "nodes")
    rooted = roots(links_between(nodes.select("fp"), most)).withColumnRenamed("node", "fp")
    named = stored(
        nodes.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named"
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("first"))
    return named.select("fp", "root").join(smallest, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.uid").alias("survivor")
    )


def near_duplicates(
    docs: DataFrame,
    most: int = MAX_DISTANCE,
    words_in_shingle: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``fingerprint`` has 16 lower-case hex digits. ``component_id`` is the smallest id among all rows
    that links of at most ``most`` bits reach, the row itself included; null ids do not count, and
    a component of such rows alone has a null ``component_id``. Null and empty texts have fingerprint
    zero and are linked like others; a text of any length is read whole. Repeated rows are all returned,
    and an empty table gives an empty table. Other columns are ignored.
    """
    marked = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            fingerprint_column(text_col, words_in_shingle).alias("fp"),
            F.lit(0).cast("long").alias("uid"),
        ),
        "fingerprints",
    )
    classes = stored(classes_of(marked, most), "classes")
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def survivors(
    docs: DataFrame,
    most: int = MAX_DISTANCE,
    words_in_shingle: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay: of every component one, that with the smallest id.

    Rows are numbered as they are stored, so that of repeated rows, or rows without ids, one stays.
    """
    marked = stored(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            fingerprint_column(text_col, words_in_shingle).alias("fp"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "fingerprints",
    )
    classes = stored(classes_of(marked.select("fp", "doc_id", "uid"), most), "classes")
    # one row for each class: the shuffle of the documents is by a key that none of them share
    winners = classes.select(F.col("survivor").alias("uid")).distinct()
    return marked.join(winners, "uid", "left_semi").select("row.*")
