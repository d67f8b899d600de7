from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the settings of the package."""
    from tenderlake.llm.common import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def documents(llm):
    """Rows of documents with columns whose names the operators use themselves."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "score double, row string, `k.x` int, text_hash long, node long"
    )

    def make(rows):
        full = [
            (i, t, lang, source, None if t is None else len(t), 9.0, "r", 1, 2, 3)
            for i, t, lang, source in rows
        ]
        return llm.createDataFrame(full, schema)

    return make
