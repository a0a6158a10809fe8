"""A corpus pipeline of the text operators.

Every stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept and returns the columns of documents (the last one: packed
pieces). ``run`` writes each stage's result as Parquet under the shared
checkpoint folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ohlcflow.llm.common import documents, materialize


def line_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly content, by counts and by a line field trained on the labelled documents."""
    from ohlcflow.llm.line_quality import fit, keep

    return keep(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that likenesses of 0.8 or more over 5-grams of words connect."""
    from ohlcflow.llm.ngram_join import distinct_documents

    return distinct_documents(docs, n=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows."""
    from ohlcflow.llm import personal_data as P

    return P.redact(docs, P.fit(materialize(P.candidates(docs), "personal")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    from ohlcflow.llm.mixing import take

    return take(docs, weights=(3, 1, 2), percent=150, max_epochs=2)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into sequences of 4096 tokens, a row for each piece."""
    from ohlcflow.llm.packing import pack

    return pack(docs, 4096, end_id=2)


STAGES = [
    ("line_quality", line_quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokens and line labels are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
