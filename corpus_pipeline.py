"""The cleaning pipeline over ``documents``: five stages, each written and read again.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` and works on all rows its
predecessor kept. All but the last return the columns of ``docs``; a column
``n_chars`` follows the text. Documents that are empty after a stage stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import langid, line_dedup, minhash, packing, pii
from strata.llm.common import staged
from strata.session import configure


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language is not recognised."""
    configure(spark)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_known(docs, model)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines of 40 characters or more that five documents hold from all but the largest id."""
    configure(spark)
    return _with_length(line_dedup.dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each class of texts alike to 0.8 in five-word shingles."""
    configure(spark)
    return minhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    configure(spark)
    return _with_length(pii.mask_pii(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    configure(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", sequences),
]

ORACLE_SQL = None  # tokenization and the trained classifier have no SQL form; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
