import random

import corpus_pipeline
import public_tokenizers
import pytest
from llm.brute import check_packing, near_duplicates, rules, without_repeats
from tokenizers import Tokenizer

from saleslane.llm import quality_rules, simhash_dedup, stages, toxicity
from saleslane.llm.shared import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_are_named_in_order():
    names = ["toxicity", "quality_rules", "near_dedup", "substring_dedup", "packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names


def test_every_stage_against_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == COLUMNS
        after = docs.collect()
        expected = PLAIN[name](spark, before, sf_dir)
        assert sorted((r["doc_id"], r["text"]) for r in after) == sorted(expected), name
        assert all(r["n_chars"] == len(r["text"]) for r in after)
        before = after
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: [*library.encode(r["text"], add_special_tokens=False).ids, 2] for r in before}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert check_packing(packed, ids) <= 0.02 * sum(map(len, ids.values()))


def plain_toxicity(spark, rows, sf_dir):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scores = model.score([r["text"] for r in rows])
    return [(r["doc_id"], r["text"]) for r, score in zip(rows, scores, strict=True) if score < 0.5]


def plain_rules(spark, rows, sf_dir):
    """No line of these few documents is above the limits, so the rules on single texts decide."""
    kept = []
    for r in rows:
        measured = rules(r["text"])
        if measured[0] >= quality_rules.LEAST_WORDS and 100 * measured[4] <= 50 * measured[0]:
            kept.append((r["doc_id"], r["text"]))
    return kept


def plain_near_dedup(spark, rows, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in rows}
    return [(i, texts[i]) for i, _, c in near_duplicates(list(texts.items())) if i == c]


def plain_substring_dedup(spark, rows, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in rows}
    made = without_repeats(list(texts.items()))
    return [(i, kept if gone else texts[i]) for i, _, gone, kept in made]


PLAIN = {
    "toxicity": plain_toxicity,
    "quality_rules": plain_rules,
    "near_dedup": plain_near_dedup,
    "substring_dedup": plain_substring_dedup,
}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_odd_rows_and_columns(spark, sf_dir, documents, stage):
    rng = random.Random(5)
    text = " ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(90))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "x" * 50_000), (None, None)]
    docs = documents(rows, clashing=True)
    kept = stage(spark, docs, sf_dir)
    assert kept.dtypes == docs.dtypes
    assert {r["doc_id"] for r in kept.collect()} <= {1, 2, 3, 4, None}
    assert 1 in {r["doc_id"] for r in kept.collect()}
    assert stage(spark, documents([]), sf_dir).collect() == []


def test_packing_of_odd_rows(spark, documents):
    docs = documents([(1, "a"), (1, "a"), (None, None), (2, "")], clashing=True)
    assert sum(r["length"] for r in stages.packing_stage(spark, docs, "").collect()) == 6


def test_survivors_agree_with_classes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    classes = simhash_dedup.near_duplicates(docs).where("doc_id = component_id").select("doc_id")
    assert rows_of(simhash_dedup.survivors(docs).select("doc_id")) == rows_of(classes)
