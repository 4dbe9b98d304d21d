"""URL rules as one bit-parallel wildcard automaton (multiword Shift-And).

Every rule is a glob over the canonical URL ``.host/path``. A glob with m literal bytes takes m + 1
neighbouring bits of a row of 64-bit words: bit j says that j literals have matched. One step over
a byte c is ``((D & STEP[c]) << 1) | (D & LOOP[c])``, with the shifted-out bits carried into the
next word; it advances all rules at once, for all URLs of an Arrow batch at once.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64
URLS_PER_STEP = 4096


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the start of a path there."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


@dataclass(frozen=True)
class Automaton:
    """Globs of literal bytes, ``*`` (any bytes but ``/``) and ``**`` (any bytes)."""

    start: np.ndarray
    step: np.ndarray
    loop: np.ndarray
    accept: tuple[tuple[int, int], ...]

    @classmethod
    def of(cls, globs: Sequence[str]) -> Automaton:
        parsed = [_tokens(glob) for glob in globs]
        words = -(-sum(len(literals) + 1 for literals, _ in parsed) // WORD) or 1
        start = np.zeros(words, np.uint64)
        step = np.zeros((256, words), np.uint64)
        loop = np.zeros((256, words), np.uint64)
        accept, first = [], 0
        for literals, stars in parsed:
            start[first // WORD] |= _bit(first)
            for j, byte in enumerate(literals):
                step[byte, (first + j) // WORD] |= _bit(first + j)
            for j, crosses_slash in stars.items():
                at = first + j
                loop[:, at // WORD] |= _bit(at)
                if not crosses_slash:
                    loop[ord("/"), at // WORD] &= ~_bit(at)
            last = first + len(literals)
            accept.append((last // WORD, last % WORD))
            first = last + 1
        return cls(start, step, loop, tuple(accept))

    def matches(self, urls: Sequence[bytes]) -> np.ndarray:
        """A row for each URL, a column for each glob."""
        out = np.zeros((len(urls), len(self.accept)), bool)
        for at in range(0, len(urls), URLS_PER_STEP):
            out[at : at + URLS_PER_STEP] = self._run(urls[at : at + URLS_PER_STEP])
        return out

    def _run(self, urls: Sequence[bytes]) -> np.ndarray:
        lengths = np.array([len(url) for url in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")  # those that still have bytes come first
        data = np.frombuffer(b"".join(urls), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state = np.tile(self.start, (len(urls), 1))
        alive = len(urls)
        for t in range(int(lengths[0]) if alive else 0):
            alive = int(np.searchsorted(-lengths[:alive], -t, side="left"))
            byte = data[begins[:alive] + t]
            moved = state[:alive] & self.step[byte]
            shifted = moved << np.uint64(1)
            shifted[:, 1:] |= moved[:, :-1] >> np.uint64(WORD - 1)
            state[:alive] = shifted | (state[:alive] & self.loop[byte])
        found = np.empty((len(urls), len(self.accept)), bool)
        for k, (word, bit) in enumerate(self.accept):
            found[order, k] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
        return found


def _bit(at: int) -> np.uint64:
    return np.uint64(1 << (at % WORD))


def _tokens(glob: str) -> tuple[bytes, dict[int, bool]]:
    """The literal bytes, and at which count of literals a star loops (True: over ``/`` too)."""
    literals, stars, at = bytearray(), {}, 0
    raw = glob.encode()
    while at < len(raw):
        if raw[at : at + 1] != b"*":
            literals.append(raw[at])
            at += 1
            continue
        run = len(raw[at:]) - len(raw[at:].lstrip(b"*"))
        stars[len(literals)] = run > 1 or stars.get(len(literals), False)
        at += run
    return bytes(literals), stars


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_behind_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """From the end of the host to ``?`` or ``#``; empty without ``://``."""
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def judge_urls(
    df: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row; nothing is shuffled.

    A rule fits its host and all subdomains where the path starts with the rule's path. The longest
    fitting rule wins; of equally long ones that with the longer host, then the one listed first.
    Where none fits, ``rule`` is null and the verdict is ``default``. A null URL, or one without
    ``://``, has an empty host and path; a URL of any length is read whole. Repeated rows are judged one by one,
    an empty table gives an empty table. Columns that already have one of the four names are replaced.
    """
    ranked = sorted(rules, key=lambda rule: (-len(rule.name), -len(rule.host)))
    automaton = Automaton.of([rule.glob for rule in ranked])

    @F.pandas_udf("int")
    def best_rule(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for urls in batches:
            found = automaton.matches([bytes(x) for x in urls])
            any_rule = found.any(axis=1) if ranked else np.zeros(len(urls), bool)
            best = found.argmax(axis=1) if ranked else any_rule
            yield pd.Series(np.where(any_rule, best, -1).astype(np.int32))

    names = {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    parts = df.select(*(c for c in df.columns if c not in (*names, "rule", "verdict")), *(
        value.alias(name) for name, value in names.items()
    ))
    canonical = F.concat(F.lit("."), "host", "path").cast("binary")
    number = F.col("_rule_number")
    of = lambda field: F.get(F.array(*(F.lit(x) for x in field)), number)
    none = F.lit(None).cast("string")
    rule = of([r.name for r in ranked]) if ranked else none
    verdict = of([r.verdict for r in ranked]) if ranked else none
    return (
        parts.withColumn("_rule_number", best_rule(canonical))
        .withColumn("rule", F.when(number >= 0, rule))
        .withColumn("verdict", F.coalesce(F.when(number >= 0, verdict), F.lit(default)))
        .drop("_rule_number")
    )
