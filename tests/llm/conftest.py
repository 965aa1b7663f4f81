import pytest
from pyspark.sql import functions as F

#: Texts that make every operator meet its edge cases.
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 4),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (5, "The quick brown fox jumps over the lazy dog. " * 4),
    (6, "one two"),
    (7, LONG),
    (8, LONG + " and an end of its own"),
    (9, "ünï 中文 🙂 \x00 \\n </turn> <|endoftext|> it's we'll  ###"),
    (10, "line\nline\n\n  \nline again and again and again and again"),
    (11, "!!! ### $$$"),
    (12, "one two"),
    (13, "The quick brown fox jumps over the lazy dog. " * 3 + LONG[:400]),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, extra columns with the operators' names."""
    rows = spark.createDataFrame([(i, t, "en" if i % 2 else None, None if i % 3 else "s") for i, t in TEXTS], "doc_id long, text string, lang string, source string")
    rows = rows.unionByName(rows.where("doc_id = 1")).unionByName(spark.createDataFrame([(None, "a row without an id " * 9, None, None)], rows.schema))
    return rows.withColumns({c: F.lit(c) for c in ("score", "ids", "items", "kept", "shard", "node", "row", "at", "n", "start", "cluster", "host", "label", "value")}).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
