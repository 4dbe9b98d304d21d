import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm.brute import check_packing
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saleslane.llm import harmonic_packing
from saleslane.llm.harmonic_packing import WordEncoder, class_sizes, cut, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def pieces(df, **how):
    return pack(df, PATH, **how).withColumn("ids_crc32", F.crc32("ids")).select(NAMES).collect()


def test_ids_are_those_of_the_library(library):
    rng = random.Random(4)
    alphabet = [*"  \n\t''stmABΣςσİIक़ß.,.,1²!é漢\x1c\x85　😀́क़Å", "<|endoftext|>", " the ", " don't ", " End. "]
    for most in (100, 10**6):
        encoder = WordEncoder(PATH, most)
        for _ in range(40):
            texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(20)]
            for made, text in zip(encoder.encode(texts), texts, strict=True):
                assert np.frombuffer(made, "<u4").tolist() == ids_of(library, text)[:-1], repr(text)


def test_texts_that_change_when_made_small(library):
    texts = ["a <|ENDOFTEXT|> b", "A<|EndOfText|><|endoftext|>B", "J\u030c", "xH\u0331 y", "É J\u030c Ab <|Startoftext|>"]
    texts += [f"{first}{second}" for first in "HJTWY" for second in "\u030c\u0331\u0308\u030a"]
    encoder = WordEncoder(PATH)
    for made, text in zip(encoder.encode(texts), texts, strict=True):
        assert np.frombuffer(made, "<u4").tolist() == ids_of(library, text)[:-1], repr(text)


def test_cuts():
    sizes = class_sizes()
    assert sizes[0] == 4096 and sizes[-1] == 1
    assert all(4096 - 4096 // size * size < 64 for size in sizes)
    for length in [*range(300), 4095, 4096, 4097, 10_000]:
        assert sum(cut(length)) == length
        assert set(cut(length)) <= set(sizes)


def test_cases(documents, library):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = {i: " ".join(word() for _ in range(int(rng.paretovariate(0.7) * 20))) for i in range(300)}
    texts |= {1000: None, 1001: "", 1002: " \n", 1003: "long " * 30_000, None: "no id, here."}
    ids = {i: ids_of(library, text) for i, text in texts.items()}
    for clashing in (False, True):
        df = documents(list(texts.items()), clashing).repartition(7)
        padding = check_packing(pieces(df), ids)
        assert padding <= 0.01 * sum(map(len, ids.values())) + 4096


def test_small_capacities(documents, library):
    texts = {i: "a b c d e f g h i j k"[: 2 * i] for i in range(12)}
    ids = {i: ids_of(library, text) for i, text in texts.items()}
    for capacity in (1, 7, 10):
        found = pieces(documents(list(texts.items())), capacity=capacity)
        check_packing(found, ids, capacity)


def test_repeated_rows_and_empty_table(documents, library):
    rows = pieces(documents([(1, "one two three")] * 3))
    assert sum(r["length"] for r in rows) == 3 * len(ids_of(library, "one two three"))
    whole = zlib.crc32(np.array(ids_of(library, "x"), "<u4").tobytes())
    assert {r["ids_crc32"] for r in pieces(documents([(1, "x"), (2, "x")]))} <= {whole, *(zlib.crc32(np.array([i], "<u4").tobytes()) for i in ids_of(library, "x"))}
    assert pieces(documents([])) == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="treat words apart"):
        harmonic_packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
