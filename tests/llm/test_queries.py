import corpus_pipeline
import public_tokenizers
import pytest
from llm.brute import near_duplicates, sha, without_repeats
from oracle_compare import connect, differences

import __spark_entry__ as entry_points
from saleslane.llm.catalog import ORACLE_SQL, QUERIES

NAMES = [f"op{n}" for n in range(1, 14)]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def run(spark, sf_dir, number):
    name = next(name for name in QUERIES if name.startswith(f"{number}_"))
    return QUERIES[name](spark, sf_dir)


def test_all_are_registered():
    registered = entry_points.queries()
    assert [sum(name.startswith(f"{n}_") for name in registered) for n in NAMES] == [1] * 13
    assert registered["pipeline"] is corpus_pipeline.run
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) is None


def test_near_duplicates(spark, sf_dir, texts):
    found = run(spark, sf_dir, "op1").collect()
    assert sorted(map(tuple, found)) == sorted(near_duplicates(texts))


def test_substring_dedup(spark, sf_dir, texts):
    found = run(spark, sf_dir, "op6").collect()
    expected = [(i, n, gone, sha(kept)) for i, n, gone, kept in without_repeats(texts)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_byte_bpe(spark, sf_dir, texts):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text in texts:
        ids = library.encode_ordinary(text)
        expected.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text)))
    assert sorted(map(tuple, run(spark, sf_dir, "op7").collect())) == sorted(expected)
