"""Small tables for the operators' tests; the session comes from the tests above."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents given as (doc_id, text, source)."""

    def make(*entries):
        data = [(i, text, "en", source, None if text is None else len(text)) for i, text, source in entries]
        return spark.createDataFrame(data, DOCUMENTS)

    return make
