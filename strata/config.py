"""All tunable values of a run, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Settings of a medallion run and of retrieval.

    ``broadcast_bytes`` bounds what may be sent whole to every task; anything
    measured larger takes the shuffled way instead. ``bucket_bytes`` and ``task_bytes``
    bound the buckets of silver and index and the tasks that write them.
    """

    source_name: str = "kafka_ingestion_boundary"
    lineage_namespace: str = "strata"
    lineage_producer: str = "strata"
    business_key: str = "article_id"
    chunk_size: int = 500
    chunk_overlap: int = 50
    dense_k: int = 5
    bm25_k: int = 5
    fused_k: int = 5
    rerank_k: int = 3
    rrf_k: int = 60
    bm25_k1: float = 1.5
    bm25_b: float = 0.75
    bm25_epsilon: float = 0.25
    embedding_dim: int = 64
    broadcast_bytes: int = 64 * 1024 * 1024
    bucket_bytes: int = 256 * 1024 * 1024  # of silver and index, on disk; more of them are split
    task_bytes: int = 256 * 1024 * 1024  # in memory, written by one task
    kafka_bootstrap: str = "localhost:9092"
    kafka_raw_topic: str = "raw-events"
    kafka_dlq_topic: str = "quarantine-dlq"
