from __future__ import annotations

import pytest

CLASHING = "_row string, _text string, _id long, _norm string, score double, kept string, node string, sig string, key long, ids string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
LONG = "der lange text wiederholt sich nicht " * 20_000


def rows_of(*pairs):
    """Rows of (doc_id, text) with every other column set to something in the way."""
    return [(i, t, "en", None, 0, "r", "t", 7, "n", 0.5, "k", "no", "si", 3, "x") for i, t in pairs]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, an emoji, control characters."""
    text = "one two three four five six seven eight nine ten"
    pairs = [
        (1, text), (2, text.upper()), (3, text), (3, text), (None, text), (4, None), (5, ""), (6, "   \n\t "), (7, "a b"), (8, "A  b"),
        (9, LONG), (10, LONG), (11, "🚀 é ▁x \x00 end"), (None, None), (12, "x" * 5000), (13, "eins zwei drei vier fünf sechs"),
    ]
    return spark.createDataFrame(rows_of(*pairs), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (1, 1, 0), (7, 0, None), (None, 0, 1), (13, 1, 0)], "doc_id long, quality int, toxic int")
