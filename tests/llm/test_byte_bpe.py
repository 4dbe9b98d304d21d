import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from saleslane.llm import byte_bpe, byte_bpe_tables

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def check(encoder, library, texts):
    for made, text in zip(encoder.encode(texts), texts, strict=True):
        assert made.ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(made.ids, made.offsets) == text.encode()
        assert made.decimals == " ".join(map(str, made.ids))


def test_random_texts(library):
    rng = random.Random(3)
    alphabet = [*"  \n\t'''stmdrevlaE1²,!é漢　\x1c\x85😀ß́", "'re", "'ll", "'s", " '", " the"]
    encoder = byte_bpe.Encoder(PATH)
    for _ in range(40):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(30)]
        check(encoder, library, texts)


def test_pieces_at_the_ends(library):
    check(
        byte_bpe.Encoder(PATH, most=50),
        library,
        ["", " ", "  ", "'", "'s", "'r", "x'r", "x're", "x'l", " 's", "\n's", "a  ", "a \n b", "  'll", "''s", "a'sb'tc", "1'd", "<|endoftext|>"],
    )


def test_long_runs(library):
    check(byte_bpe.Encoder(PATH), library, ["a" * 30_000 + " " + "ab" * 20_000 + " " * 9999 + "é" * 5000])


def test_code_points_of_the_basic_plane(library):
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    check(byte_bpe.Encoder(PATH), library, ["a" + chr(c) + "1" + chr(c) + "," for c in points])


def test_blocks_that_stay_undecided():
    kinds = byte_bpe.classes()[[ord(c) for c in "a" + "'" * 600 + "re"]]
    whole = byte_bpe.piece_starts(kinds)
    assert whole.tolist() == [0, 1, 601]


def test_table(documents, library):
    texts = [(1, "Hello  world's end"), (2, None), (3, ""), (None, "x"), (1, "x" * 70_000), (4, "é ١٢")]
    expected = []
    for doc_id, text in texts:
        ids = library.encode_ordinary(text or "")
        sha = lambda data: hashlib.sha256(data.encode()).hexdigest()
        expected.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    for clashing in (False, True):
        found = byte_bpe_tables.digests(documents(texts, clashing), PATH).collect()
        assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    back = byte_bpe_tables.decode(byte_bpe_tables.encode(documents(texts), PATH), PATH).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in texts), key=str)
    assert byte_bpe_tables.digests(documents([]), PATH).collect() == []
