from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source), with clashing extra columns."""
    from newsmart.llm.common import ready

    ready(spark)

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None, 1, 2, "x", 3.5)
            for r in rows
        ]
        clashing = ", key int, n int, _text string, place double"
        return spark.createDataFrame(full, DOCUMENTS + clashing)

    return make
