"""Plain versions of what the operators compute, over few rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    found = words(lowered(text))
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)]
    shingles = shingles or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = (1 << b for b in range(64))
    return sum(bit for bit in bits if 2 * sum(h & bit > 0 for h in hashes) > len(hashes))


def classes(fingerprints, most=3):
    """For every row the least row number that links reach."""
    parent = list(range(len(fingerprints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= most:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fingerprints))]


def near_duplicates(rows, most=3):
    """(doc_id, fingerprint, component_id) of rows (doc_id, text)."""
    marks = [fingerprint(text) for _, text in rows]
    of = classes(marks, most)
    least = {}
    for (doc_id, _), c in zip(rows, of, strict=True):
        if doc_id is not None:
            least[c] = min(doc_id, least.get(c, doc_id))
    return [
        (row[0], f"{mark:016x}", least.get(c)) for row, mark, c in zip(rows, marks, of, strict=True)
    ]


def without_repeats(rows, size=50):
    """(doc_id, n_words, n_removed, kept words) of rows (doc_id, text)."""
    found = [words(text) for _, text in rows]
    first = {}
    for (doc_id, _), w in zip(rows, found, strict=True):
        if doc_id is not None:
            for p in range(len(w) - size + 1):
                window = tuple(w[p : p + size])
                first[window] = min(doc_id, first.get(window, doc_id))
    out = []
    for (doc_id, _), w in zip(rows, found, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - size + 1 if doc_id is not None else 0):
            if first[tuple(w[p : p + size])] < doc_id:
                gone[p : p + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((doc_id, len(w), sum(gone), " ".join(kept)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    counts = Counter(windows)
    under = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(under)


def check_packing(pieces, docs, capacity=4096):
    """Every id lies in one piece, every sequence is gapless; returns the padding."""
    at, used = {}, {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"] is None, p["doc_id"], p["start"])):
        ids = docs[p["doc_id"]]
        assert p["start"] == at.get(p["doc_id"], 0)
        part = ids[p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] > 0
        assert p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        at[p["doc_id"]] = p["start"] + p["length"]
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert at == {doc_id: len(ids) for doc_id, ids in docs.items()}
    padding = 0
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    return padding
