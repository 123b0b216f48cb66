"""Small tables for the training-data operators."""

import pytest


@pytest.fixture
def documents(spark):
    def build(rows, **extra):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        full = [
            (i, text, lang, "s", len(text) if text else None)
            for i, text, *rest in rows
            for lang in [rest[0] if rest else "en"]
        ]
        return spark.createDataFrame(full, schema)

    return build
