from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "word " * 30_000 + "end"
TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "one two",
    "A b C d e f g h i j k l",
    "a b c d e f g h i j  k l",
    "abcdefghijkl",
    "The End\nThe End\n\nthe end\n \nThe End",
    "café    \U0001f600 ▁ x\u0000y <s> </s>",
    LONG,
    LONG + " more",
]


@pytest.fixture
def docs(spark):
    """Documents with nulls everywhere, empty and long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(n, text, "en", f"s{n % 3}" if n % 4 else None, 0) for n, text in enumerate(TEXTS)]
    rows += [(n + 100, text, None, "s0", None) for n, text in enumerate(TEXTS)]
    rows += [(5, TEXTS[5], "en", "s2", 0), (3, "one", None, None, 1), (None, "one two", None, None, None)]
    rows += [(None, None, None, None, None)] * 2
    frame = spark.createDataFrame(rows, SCHEMA)
    clashes = ("size", "shard", "slot", "bucket", "key", "bits", "kept", "score", "row", "copies", "place", "_row1", "before", "_before", "n")
    for n, name in enumerate(clashes):
        frame = frame.withColumn(name, frame.n_chars + n)
    return frame


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
