"""Gold aggregates over the silver articles.

All of them are algebraic group-bys: Spark combines on the map side, so a
category or author that holds a third of the rows still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.functions.text import word_count


def category_metrics(silver: DataFrame) -> DataFrame:
    return silver.groupBy("category").agg(
        F.count("article_id").alias("total_articles"),
        F.sum("views").alias("total_category_views"),
        F.avg("views").alias("avg_views_per_article"),
        F.avg("rating").alias("avg_category_rating"),
        F.max("rating").alias("top_rating"),
    )


def author_metrics(silver: DataFrame) -> DataFrame:
    return silver.groupBy("author").agg(
        F.count("article_id").alias("published_articles_count"),
        F.avg("rating").alias("author_avg_rating"),
        F.sum("views").alias("author_total_reach"),
    )


def category_word_counts(silver: DataFrame) -> DataFrame:
    """Average number of words of an article, per category."""
    return silver.groupBy("category").agg(
        F.count("article_id").alias("total_articles"),
        F.avg(word_count(F.col("content"))).alias("avg_word_count"),
    )


def daily_velocity(silver: DataFrame) -> DataFrame:
    """Articles published per day; ``published_timestamp`` is a timestamp in silver."""
    return (
        silver.groupBy(F.to_date("published_timestamp").alias("published_date"))
        .agg(F.count("article_id").alias("published_articles"))
    )
