from __future__ import annotations

import pytest

from saleslane.llm.shared import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return, with other types.
CLASHING = (
    "fp", "uid", "row", "host", "key", "row_key", "score", "kept", "fingerprint", "removed",
    "_row", "_text", "_id", "spans", "opened", "ids", "length", "n_words", "positive", "first",
)


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source)."""

    def build(rows, clashing=False):
        full = []
        for row in rows:
            doc_id, text, source = (*row, "src0")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        schema = DOCS
        if clashing:
            full = [(*row, *("x" for _ in CLASHING)) for row in full]
            schema += "".join(f", {name} string" for name in CLASHING)
        return spark.createDataFrame(full, schema)

    return build
