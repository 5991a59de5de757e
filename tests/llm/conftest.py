import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text) or (id, text, lang), with further columns whose names the operators use inside."""

    def build(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        docs = spark.createDataFrame(full, COLUMNS)
        if clash:
            for name in ("kept", "score", "digest", "shard", "size", "length", "words", "base", "label", "_bucket", "rank", "_locator", "_metadata", "_spans", "_place", "_n", "_row", "row", "hits", "block"):
                docs = docs.withColumn(name, F.lit("x"))
        return docs

    return build


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, and a very long text."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    return [
        (1, "Some plain words in a row here, nothing else to see."),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, "Some plain words in a row here, nothing else to see."),
        (5, "Some plain words in a row here, nothing else to see."),
        (None, "Some PLAIN words in a row here, nothing else to see."),
        (None, None),
        (6, "é"),
        (7, long_text),
        (8, "x" * 50_000),
        (9, "日本語 テキスト 😀 mixed with words"),
    ]


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))
