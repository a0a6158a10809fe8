import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text[, source]) rows, with columns named like the operators' own."""

    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, DOC_SCHEMA)
        for name in ("start", "length", "ids", "target", "component_id", "spans", "score", "fingerprint", "_row", "size"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls, empty and blank texts, ties, repeated rows, other spaces, a very long text and a very long word."""
    return make_docs(
        [
            (3, "the quick brown fox jumps over the lazy dog\nand the dog sleeps", "a"),
            (1, "the quick brown fox jumps over the lazy dog\nand the dog sleeps", "b"),
            (1, "the quick brown fox jumps over the lazy dog\nand the dog sleeps", "b"),
            (2, None, "a"),
            (4, "", None),
            (5, " \t\n ", None),
            (None, "a document without an id", "a"),
            (6, "naïve café and other\x1cspaces \U0001f600 ßİ", "a"),
            (7, "word " * 30_000, "b"),
            (8, "x" * 50_000, "c"),
            (9, "one", "c"),
            (10, "Hello, World! 12.5%", None),
        ]
    )


@pytest.fixture
def no_docs(make_docs):
    return make_docs([]) if False else make_docs([(0, "gone", "a")]).where("doc_id = 1")
