from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A documents table from texts, ids from 0, or from (id, text) pairs."""
    def build(*texts):
        rows = [text if isinstance(text, tuple) else (at, text) for at, text in enumerate(texts)]
        return spark.createDataFrame([(key, text, "en", "s", len(text or "")) for key, text in rows], DOCUMENTS)
    return build


@pytest.fixture
def clashing():
    """Adds columns named like those the operators use inside or give out."""
    names = (
        "_id", "_text", "_digest", "_print", "_mark", "_words", "_tokens", "row", "d", "v", "kept", "keep_id", "group_size", "digest", "score",
        "component_id", "fingerprint", "contaminated", "n_words", "labels", "start", "length", "sequence_id", "offset", "key", "base", "added", "page", "path",
    )

    def widen(df):
        for name in names:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return widen
