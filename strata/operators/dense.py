"""Dense retrieval: exact cosine top-k."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.operators.chunks import ORDER
from strata.operators.topk import topk_hits


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one width as a float64 matrix."""
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    widths = np.unique(values.value_lengths().to_numpy(zero_copy_only=False))
    if len(widths) != 1:
        raise ValueError(f"embeddings must all have one width, got {widths.tolist()}")
    return flat.reshape(len(values), int(widths[0]))


@dataclass(frozen=True)
class CosineScorer:
    """dot / (|q| |c| + 1e-9)."""

    columns: tuple[str, ...] = ("embedding",)

    def prepare(self, queries: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        vectors = _matrix(queries.column("embedding"))
        return vectors, np.linalg.norm(vectors, axis=1)

    def score(self, rows: pa.Table, prepared: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        queries, query_norms = prepared
        vectors = _matrix(rows.column("embedding"))
        norms = np.linalg.norm(vectors, axis=1)
        return (vectors @ queries.T) / (np.outer(norms, query_norms) + 1e-9)


def dense_topk(corpus: DataFrame, queries: DataFrame, k: int = 5, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The k nearest chunks of each query vector (query_id, embedding)."""
    vectors = corpus.where(F.col("embedding").isNotNull())
    wanted = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    return topk_hits(vectors, wanted, CosineScorer(), k, broadcast_bytes)


def first_k(corpus: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Without a model: the first k chunks in corpus order for every query, unscored."""
    rows = corpus.select("chunk_id", *ORDER).orderBy(*ORDER).limit(k).collect()
    if not rows:
        return queries.select("query_id").where("false").selectExpr(
            "query_id", "'' AS chunk_id", "'' AS doc_id", "0 AS chunk_index", "0 AS rank"
        )
    hits = F.array(
        *[
            F.struct(
                F.lit(row["chunk_id"]).alias("chunk_id"),
                F.lit(row["doc_id"]).alias("doc_id"),
                F.lit(row["chunk_index"]).alias("chunk_index"),
                F.lit(position).alias("rank"),
            )
            for position, row in enumerate(rows, start=1)
        ]
    )
    return queries.select("query_id", F.inline(hits))
