"""The article view over the document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions.text import first_line
from strata.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """Documents shaped as article events; the rating comes from the labels.

    The join is left to Catalyst: ``labels`` grows with the documents.
    ``spread_out`` is for CPU-heavy work on a file of few splits.
    """
    docs = table(spark, sf_dir, "documents")
    docs = spread(docs) if spread_out else docs
    labels = table(spark, sf_dir, "labels")
    rating = (
        F.coalesce(F.col("quality"), F.lit(0)) * F.lit(5.0)
        - F.coalesce(F.col("toxic"), F.lit(0)) * F.lit(1.0)
    )
    published = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)  # from 2024-01-01
    return docs.join(labels, "doc_id", "left").select(
        F.concat(F.lit("ART-"), F.col("doc_id").cast("string")).alias("article_id"),
        first_line(F.col("text")).alias("title"),
        F.col("source").alias("author"),
        F.col("lang").alias("category"),
        F.col("text").alias("content"),
        F.col("n_chars").alias("views"),
        rating.alias("rating"),
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_timestamp"),
    )


def as_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in column ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
