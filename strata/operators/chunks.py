"""Documents to overlapping, citable chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.text import check_window, chunk_count, step_pieces, window_at

UNKNOWN_DOC = "DOC-UNKNOWN"
ORDER = ("doc_id", "chunk_index")  # corpus order, which breaks every tie


def citation_label(doc_id: Column, index: Column, title: Column, author: Column, style: str = "label") -> Column:
    """``label`` names title and author, ``plain`` only the article and chunk ids."""
    if style == "plain":
        return F.format_string("[Article ID: %s, Chunk: %s_C%d]", doc_id, doc_id, index)
    return F.format_string("[Doc ID: %s, Chunk: %d | '%s...' by %s]", doc_id, index, F.substring(title, 1, 35), author)


def chunk_documents(docs: DataFrame, size: int = 500, overlap: int = 50, style: str = "label") -> DataFrame:
    """One row per chunk of (article_id, title, author, category, content).

    Each text is cut once into steps of ``size - overlap`` characters and the
    windows are put together from those, so the work stays linear in the text
    however long one document is. Narrow: no shuffle.
    """
    check_window(size, overlap)
    step = size - overlap
    text = F.col("content")

    def default(column: str, value: str) -> Column:
        return F.coalesce(F.col(column), F.lit(value)).alias(column)

    cut = docs.where(F.length(text) > 0).select(
        F.coalesce(F.col("article_id"), F.lit(UNKNOWN_DOC)).alias("doc_id"),
        default("title", ""),
        default("author", ""),
        default("category", ""),
        chunk_count(text, size, overlap).alias("_count"),
        step_pieces(text, step).alias("_pieces"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_count") - 1),
        lambda index: window_at(F.col("_pieces"), index, size, step),
    )
    rows = cut.select("doc_id", "title", "author", "category", F.posexplode(windows).alias("chunk_index", "text"))
    return rows.select(
        F.concat("doc_id", F.lit("_C"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        "title",
        "author",
        "category",
        "text",
        citation_label(F.col("doc_id"), F.col("chunk_index"), F.col("title"), F.col("author"), style).alias(
            "citation_label"
        ),
    )
