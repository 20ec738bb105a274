"""Cited answers from reranked chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The parts of an answer.
NO_CONTEXT = "No relevant context documents were found in the knowledge base to answer this query."
OPENING = "Based strictly on the retrieved knowledge base documents:\n\n"
RESPONSE_HEAD = "### Query Response\n"
DEFAULTS = {
    "doc_id": "DOC-UNKNOWN", "chunk_id": "C0", "title": "Untitled Document", "author": "Unknown Author", "text": ""
}
CITATIONS_HEAD = "\n\n### Referenced Citations\n"


def grounded_answers(reranked: DataFrame, queries: DataFrame) -> DataFrame:
    """One answer row per query, also for a query without any hit.

    At most rerank-k rows meet in one list.
    """
    entry = F.struct(
        F.col("final_rank").alias("citation_num"),
        "doc_id",
        "chunk_id",
        "title",
        "author",
        "rerank_score",
        "text",
        "chunk_index",
        "category",
        "citation_label",
        "rrf_score",
    )
    lists = reranked.groupBy("query_id").agg(
        F.sort_array(F.collect_list(entry)).alias("hits"),
        F.max("dense_hits_count").alias("dense_hits_count"),
        F.max("bm25_hits_count").alias("bm25_hits_count"),
        F.max("fused_count").alias("rrf_fused_count"),
        F.count(F.lit(1)).alias("final_reranked_count"),
    )
    def named(hit, field: str):
        return F.coalesce(hit[field].cast("string"), F.lit(DEFAULTS[field]))

    excerpts = F.transform(
        "hits",
        lambda h: F.format_string('Key Excerpt %d: "%s" [%d]', h["citation_num"], named(h, "text"), h["citation_num"]),
    )
    references = F.transform(
        "hits",
        lambda h: F.format_string(
            "  - [%d] Document '%s' by %s (ID: %s, Chunk: %s)",
            h["citation_num"],
            named(h, "title"),
            named(h, "author"),
            named(h, "doc_id"),
            named(h, "chunk_id"),
        ),
    )
    answer = F.concat(
        F.lit(RESPONSE_HEAD + OPENING),
        F.array_join(excerpts, "\n\n"),
        F.lit(CITATIONS_HEAD),
        F.array_join(references, "\n"),
    )
    citation_fields = ("citation_num", "doc_id", "chunk_id", "title", "author", "rerank_score")
    chunk_fields = (
        "chunk_id",
        "doc_id",
        "chunk_index",
        "title",
        "author",
        "category",
        "text",
        "citation_label",
        "rrf_score",
        "rerank_score",
    )

    def picked(fields: tuple[str, ...], defaults: bool = False):
        def value(hit, f: str):
            return named(hit, f) if defaults and f in DEFAULTS else hit[f]

        every = F.transform("hits", lambda h: F.struct(*[value(h, f).alias(f) for f in fields]))
        return F.coalesce(every, F.filter(every, lambda _: F.lit(False)), F.array())

    joined = queries.select("query_id", "query").join(lists, "query_id", "left")
    counts = ("dense_hits_count", "bm25_hits_count", "rrf_fused_count", "final_reranked_count")
    return joined.select(
        "query_id",
        "query",
        F.coalesce(answer, F.lit(NO_CONTEXT)).alias("answer"),
        picked(citation_fields, defaults=True).alias("citations"),
        picked(chunk_fields).alias("retrieved_chunks"),
        F.when(F.col("hits").isNotNull(), F.struct(*counts)).alias("search_evaluation"),
    )
