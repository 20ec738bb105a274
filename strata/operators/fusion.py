"""Reciprocal rank fusion and reranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.functions.text import distinct_matches, one_of, tokens
from strata.operators.chunks import ORDER
from strata.operators.sizing import broadcast_if_small
from strata.sources.buckets import address

LOOKED_UP = 5_000  # chunks that are sought by a filter


def rrf_fuse(dense: DataFrame, lexical: DataFrame, rrf_k: int = 60, k: int = 5) -> DataFrame:
    """Fuse two ranked lists; each list adds 1 / (rrf_k + rank).

    Ties go to the dense order, then to the lexical one. ``score`` is the
    lexical one where a chunk is in both lists. The sizes of the two lists ride
    along, so that counting them later needs no second search.
    """
    keys = ["query_id", "chunk_id", *ORDER]
    from_dense = dense.select(*keys, F.col("rank").alias("dense_rank"), F.col("score").alias("_dense_score"))
    from_lexical = lexical.select(*keys, F.col("rank").alias("bm25_rank"), F.col("score").alias("_bm25_score"))

    def share(rank: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.lit(rrf_k) + F.col(rank)), F.lit(0.0))

    fused = from_dense.join(from_lexical, keys, "full").select(
        *keys,
        "dense_rank",
        "bm25_rank",
        (share("dense_rank") + share("bm25_rank")).alias("rrf_score"),
        F.coalesce("_bm25_score", "_dense_score").alias("score"),
    )
    whole = Window.partitionBy("query_id")
    order = whole.orderBy(F.desc("rrf_score"), F.asc_nulls_last("dense_rank"), F.asc_nulls_last("bm25_rank"))
    return fused.select(
        "*",
        F.count("dense_rank").over(whole).alias("dense_hits_count"),
        F.count("bm25_rank").over(whole).alias("bm25_hits_count"),
        F.row_number().over(order).alias("rank"),
    ).where(F.col("rank") <= k)


PAYLOAD = ("title", "author", "category", "text", "citation_label")


def looked_up(chunks: DataFrame, hits: DataFrame, buckets: int | None, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The chunks that ``hits`` (a stored table) name, read by their keys.

    Up to ``LOOKED_UP`` distinct chunks become a filter: the scan opens the files of
    their buckets only, and in these the row groups whose bounds and Bloom filter
    have one of the ids. What is read grows with the hits, not with the index. More
    hits are joined, by broadcast if they are measured to be small.
    """
    at = address("doc_id", buckets) if buckets else F.lit(0)
    keys = hits.select("chunk_id", at.alias("_bucket")).distinct()
    few = keys.limit(LOOKED_UP + 1).collect()
    payload = chunks if buckets else chunks.withColumn("_bucket", F.lit(0))
    if len(few) <= LOOKED_UP:
        held = F.col("_bucket").isin(sorted({r["_bucket"] for r in few}))
        found = payload.where(held & one_of("chunk_id", sorted({r["chunk_id"] for r in few})))
    else:
        found = payload.join(broadcast_if_small(keys, broadcast_bytes), ["_bucket", "chunk_id"], "left_semi")
    return found.select("chunk_id", *PAYLOAD)


def with_payload(hits: DataFrame, queries: DataFrame, payload: DataFrame) -> DataFrame:
    """Hits with their query text and chunk columns; a hit without its chunk is dropped."""
    found = payload.join(hits, "chunk_id").select("chunk_id", *PAYLOAD, *[c for c in hits.columns if c != "chunk_id"])
    return found.join(queries.select("query_id", "query"), "query_id")


def _rerank(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "rank")
    return scored.withColumn("final_rank", F.row_number().over(order)).where(F.col("final_rank") <= k)


def with_keyword_score(candidates: DataFrame) -> DataFrame:
    """Add rerank_score: rrf_score + 0.1 per distinct query word found in the text."""
    matches = distinct_matches(tokens(F.col("query")), F.col("text"))
    score = F.coalesce(F.col("rrf_score"), F.lit(0.0)) + matches * F.lit(0.1)
    return candidates.withColumn("rerank_score", score)


def rerank_keyword(candidates: DataFrame, k: int = 3) -> DataFrame:
    """The k best by keyword score; ties keep the fused order."""
    return _rerank(with_keyword_score(candidates), k)


def rerank_model(candidates: DataFrame, scorer: Callable[[Column, Column], Column], k: int = 3) -> DataFrame:
    """Rerank by a user's pandas UDF over (query, text)."""
    score = scorer(F.col("query"), F.col("text")).cast("double")
    return _rerank(candidates.withColumn("rerank_score", score), k)
