import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from saleslane.llm import lexical_search
from saleslane.llm.lexical_search import damping, search, terms_of

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, most=10):
    found = [(i, Counter(TERM.findall(lowered(text)))) for i, text in docs]
    found = [(i, c) for i, c in found if c]
    documents, total = len(found), sum(c.total() for _, c in found)
    df = Counter(term for _, c in found for term in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in found:
            m = 100 - 75 + 75 * c.total() * documents // total
            score = 0
            for term, times in Counter(TERM.findall(lowered(text))).items():
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1)))
                score += times * w * (10**9 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:most], 1)]
    return sorted(out, key=str)


def result(spark, docs, items, parts=3, **how):
    found = search(spark.createDataFrame(docs, DOCS).repartition(parts), spark.createDataFrame(items, ITEMS), **how)
    return sorted(map(tuple, found.collect()), key=str)


def corpus(rng, count):
    """Texts over a vocabulary with common and rare words, of very different lengths."""
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 3, 10, 40, 200]))) for _ in range(count)]
    return texts + texts[:5]


def test_against_all_scores(spark):
    rng = random.Random(1)
    docs = list(enumerate(corpus(rng, 150)))
    docs += [(500 + i, "w1 w2 w3 same") for i in range(30)]  # ties
    docs += [(500, "w1 w2 w3 same"), (900, None), (901, ""), (902, " \n.,;"), (None, "w5 w6"), (None, "w5 w6")]
    docs += [(903, "É-é W1_w2\x00w3\x7fw4 漢字 漢字"), (904, "AbC déjà"), (905, "x" * 50_000 + " w7")]
    items = list(enumerate(corpus(rng, 25))) + [(3, "w1 w1 same same"), (None, "w5 W6 w5"), (70, None), (71, "?!")]
    items += [(72, "é É 漢字 w3"), (73, "unknown"), (74, "ABC déjà nothing")]
    expected = brute(docs, items)
    assert result(spark, docs, items) == expected
    assert result(spark, docs, items, most=3) == brute(docs, items, 3)


def test_buckets_blocks_and_thresholds(spark, monkeypatch):
    rng = random.Random(2)
    docs, items = list(enumerate(corpus(rng, 300))), list(enumerate(corpus(rng, 30)))
    expected = brute(docs, items)
    for name, value in {"BUCKET_DOCS": 7, "QUERY_TERMS": 100, "FIRST_SHARE": 4, "TEXT_BYTES": 10}.items():
        monkeypatch.setattr(lexical_search, name, value)
    assert result(spark, docs, items) == expected


def test_pruning_passes_over_most_texts():
    """Buckets that cannot reach a threshold are not scored, and in others few texts are."""
    rng = np.random.default_rng(3)
    queries = lexical_search.Queries([{"item": 0, "item_id": 0, "terms": [b"a", b"b", b"c"], "counts": [1, 1, 1]}])
    weights = np.array([5000, 4000, 10])
    scored = []

    def bucket(size, top):
        import pyarrow as pa

        impacts = rng.integers(1, top, (size, 3))
        terms = [[0, 1, 2] if i % 50 == 0 else [2] for i in range(size)]
        lists = [impacts[i, : len(t)].tolist() for i, t in enumerate(terms)]
        lengths = [math.sqrt(sum(weights[t] * x * x for t, x in zip(a, b, strict=True))) for a, b in zip(terms, lists, strict=True)]
        return lexical_search.Bucket(
            pa.record_batch(
                {
                    "doc_id": pa.array(range(size), pa.int64()), "length": pa.array(lengths),
                    "terms": pa.array(terms, pa.list_(pa.int32())), "impacts": pa.array(lists, pa.list_(pa.int32())),
                }
            )
        )

    class Counting(lexical_search.Search):
        def scored(self, bucket, query):
            found = super().scored(bucket, query)
            scored.append(len(found[1]))
            return found

    work = Counting(queries, weights, 10, np.zeros(1, np.int64))
    work.show(bucket(1000, 1_000_000))
    assert work.least[0] > 1
    work.show(bucket(1000, 1000))  # too short altogether
    assert len(scored) == 1
    work.show(bucket(1000, 1_000_000))
    assert len(scored) == 2 and scored[1] <= 20


def test_few_or_no_rows(spark):
    some = [(1, "a b"), (2, "c")]
    assert result(spark, some, [(7, "a c c")]) == brute(some, [(7, "a c c")])
    assert result(spark, [], [(7, "a")]) == result(spark, some, []) == result(spark, [(1, None)], [(7, "a")]) == []
    assert result(spark, some, [(7, "z"), (8, "")]) == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 9, "x", 1.0)], DOCS + ", item long, terms string, length double")
    items = spark.createDataFrame([(5, "a", 1, "y")], ITEMS + ", doc_id long, counts string")
    assert [r[:3] for r in search(docs, items).collect()] == [(5, 1, 1)]


def test_long_texts_are_split_between_terms(monkeypatch):
    text = " ".join(str(i) for i in range(1000)).encode() + b" " + b"y" * 100
    monkeypatch.setattr(lexical_search, "TEXT_BYTES", 16)
    parts = list(terms_of(text))
    assert len(parts) > 100 and sum(parts, []) == text.split()


def test_damping_beyond_64_bits():
    words = np.array([1, 10**9])
    assert damping(words, 10**12, 10**15).tolist() == [25, 25 + 75 * 10**9 * 10**12 // 10**15]
    assert damping(np.array([500]), 10, 5000).tolist() == [100]


@pytest.mark.parametrize("most", [1, 4])
def test_many_copies(spark, most):
    docs = [(i, "w1 w2") for i in range(400)] + [(1000 + i, f"w1 z{i}") for i in range(10)]
    items = [(1, "w1 w2"), (2, "z3 w1"), (3, "w2")]
    assert result(spark, docs, items, most=most) == brute(docs, items, most)
