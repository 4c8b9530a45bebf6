import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))



@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from rows (doc_id, text, lang, source), with extra columns of clashing names."""

    def make(rows):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "id string, row string, size string, shard string, spans string, fp string, tokens string"
        )
        full = [
            (i, t, la, s, None if t is None else len(t), "x", "r", "s", "h", "p", "f", "t") for i, t, la, s in rows
        ]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 997} the {i}" for i in range(30000))
    return docs_of(
        [
            (1, None, None, None),
            (2, "", "en", "a"),
            (3, "   \n\t", "en", "a"),
            (4, long, "en", "b"),
            (5, long, "en", "b"),
            (6, "same text in some rows of it", "en", None),
            (6, "same text in some rows of it", "en", None),
            (7, "same text in some rows of it", None, "a"),
            (None, "no id here but words", "de", "a"),
            (8, "é à ü ñ 12345 !!! " * 40, "fr", "a"),
        ]
    )
