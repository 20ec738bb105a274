"""Exact top-k of a corpus for a table of queries.

The scorer runs where the corpus rows are: a task scores its Arrow batches against
all queries with numpy and keeps the k best rows of each query over all its
batches. They leave the task once, at its end: k rows per query and task, never a
row per (query, chunk) pair, and the final window keeps k per query.

Queries reach the tasks by broadcast. Beyond ``broadcast_bytes`` they are cut into
blocks within the bound; each block is sent, meets one scan of the corpus, leaves
its hits in the shared folder and is withdrawn before the next one. The corpus is
never shuffled, and no query and no corpus row is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F, types as T

from strata.operators.chunks import ORDER
from strata.operators.sizing import measured_bytes
from strata.session import work_path

SCORE_DIGITS = 9  # scores alike to so many decimals are ties, broken by corpus order
MAX_CELLS = 4_000_000  # rows x queries scored at a time
SPARE = 4  # times k rows a query held before they are cut back to k


class Scorer(Protocol):
    """Scores corpus rows against prepared queries, inside a task."""

    columns: tuple[str, ...]  # corpus columns it reads besides the ids

    def prepare(self, queries: pa.Table) -> object: ...

    def score(self, rows: pa.Table, prepared: object) -> np.ndarray:
        """Matrix of rows x queries."""
        ...


def best_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and query positions of the k best per query; the earlier row wins a tie."""
    n_rows, n_queries = scores.shape
    if n_rows <= k:
        rows, queries = np.indices(scores.shape)
        return rows.ravel(), queries.ravel()
    bar = np.partition(scores, n_rows - k, axis=0)[n_rows - k]
    above = scores > bar
    level = scores == bar
    room = k - above.sum(axis=0)
    keep = above | (level & (np.cumsum(level, axis=0) <= room))
    return np.nonzero(keep)


class BestHits:
    """The k best rows of each query among all rows a task has seen."""

    def __init__(self, query_ids: pa.Array, k: int, ids: list[str]):
        self.query_ids, self.k, self.ids = query_ids, k, ids
        self.held: list[pa.Table] = []
        self.n_held = 0
        self.floor = np.full(len(query_ids), -np.inf)  # below it a row can't be among the best any more

    def add(self, rows: pa.Table, scores: np.ndarray) -> None:
        sort_key = np.round(scores, SCORE_DIGITS)
        at_row, at_query = best_rows(sort_key, self.k)
        reach = sort_key[at_row, at_query] >= self.floor[at_query]
        at_row, at_query = at_row[reach], at_query[reach]
        hits = rows.select(self.ids).take(pa.array(at_row))
        hits = hits.append_column("_query", pa.array(at_query, pa.int64()))
        hits = hits.append_column("score", pa.array(scores[at_row, at_query], pa.float64()))
        self.held.append(hits.append_column("_sort_key", pa.array(sort_key[at_row, at_query], pa.float64())))
        self.n_held += len(at_row)
        if self.n_held > SPARE * self.k * len(self.query_ids):
            self._cut()

    def _cut(self) -> None:
        order = [("_query", "ascending"), ("_sort_key", "descending"), *[(c, "ascending") for c in ORDER]]
        table = pa.concat_tables(self.held).sort_by(order)
        query = table.column("_query").to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        table = table.filter(pa.array(place < self.k))
        last = np.flatnonzero(place == self.k - 1)
        self.floor[query[last]] = table.column("_sort_key").to_numpy()[np.flatnonzero(place[place < self.k] == self.k - 1)]
        self.held, self.n_held = [table], table.num_rows

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self._cut()
        table = self.held[0].combine_chunks()
        query = self.query_ids.take(_flat(table.column("_query")))
        columns = [query, *[_flat(table.column(c)) for c in (*self.ids, "score", "_sort_key")]]
        whole = pa.RecordBatch.from_arrays(columns, names=["query_id", *self.ids, "score", "_sort_key"])
        for start in range(0, whole.num_rows, 50_000):
            yield whole.slice(start, 50_000)


def _task_hits(
    batches: Iterable[pa.RecordBatch], query_ids: pa.Array, prepared: object, scorer: Scorer, k: int, ids: list[str]
) -> Iterator[pa.RecordBatch]:
    best = BestHits(query_ids, k, ids)
    stride = max(1, MAX_CELLS // max(1, len(query_ids)))
    for batch in batches:
        if batch.num_rows == 0 or len(query_ids) == 0:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ORDER]))
        for start in range(0, rows.num_rows, stride):
            part = rows.slice(start, stride)
            best.add(part, scorer.score(part, prepared))
    yield from best.batches()


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def topk_hits(
    corpus: DataFrame,
    queries: DataFrame,
    scorer: Scorer,
    k: int,
    broadcast_bytes: int = 64 << 20,
    query_bytes: int | None = None,
) -> DataFrame:
    """(query_id, chunk_id, doc_id, chunk_index, score, rank): k rows per query.

    ``queries`` holds query_id and the columns that ``scorer.prepare`` reads;
    ``query_bytes`` is an upper bound of its size, measured here when not given.
    A corpus with fewer than k rows gives all of them.
    """
    ids = ["chunk_id", *ORDER]
    needed = corpus.select(*ids, *[c for c in scorer.columns if c not in ids])
    schema = T.StructType(
        [
            queries.schema["query_id"],
            *[corpus.schema[c] for c in ids],
            T.StructField("score", T.DoubleType()),
            T.StructField("_sort_key", T.DoubleType()),
        ]
    )
    if query_bytes is None:
        query_bytes, block = _measured(queries, broadcast_bytes)
    else:
        block = queries.toArrow() if query_bytes <= broadcast_bytes else None
    if block is not None:
        partial, _ = _broadcast_hits(needed, block, scorer, k, ids, schema)
    else:
        partial = _block_hits(needed, queries, scorer, k, ids, schema, query_bytes, broadcast_bytes)
    return _rank_hits(partial, k)


def _measured(queries: DataFrame, limit: int) -> tuple[int, pa.Table | None]:
    """The size of the queries, and the queries themselves when they are within the limit."""
    kept = queries.persist()  # measured, then read again
    try:
        size = measured_bytes(kept)
        return size, kept.toArrow() if size <= limit else None
    finally:
        kept.unpersist()


def _rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """Rank from 1 by score within each query, ties in corpus order; keep k."""
    order = Window.partitionBy("query_id").orderBy(F.desc("_sort_key"), *ORDER)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("_sort_key")


def _broadcast_hits(corpus, block, scorer, k, ids, schema) -> tuple[DataFrame, Broadcast]:
    sent = corpus.sparkSession.sparkContext.broadcast(block)

    def score_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        yield from _task_hits(batches, _flat(table.column("query_id")), scorer.prepare(table), scorer, k, ids)

    return corpus.mapInArrow(score_batches, schema), sent


def _block_hits(corpus, queries, scorer, k, ids, schema, query_bytes, limit) -> DataFrame:
    spark = corpus.sparkSession
    folder = work_path(spark, "topk")
    queries.write.parquet(f"{folder}/queries")
    stored = spark.read.schema(queries.schema).parquet(f"{folder}/queries")
    n = max(2, math.ceil(query_bytes / max(1, limit)))
    spark.createDataFrame([], schema).write.parquet(f"{folder}/hits/block=-1")  # there may be no other block
    for number in range(n):
        block = stored.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == number).toArrow()
        if not block.num_rows:
            continue
        hits, sent = _broadcast_hits(corpus, block, scorer, k, ids, schema)
        hits.write.parquet(f"{folder}/hits/block={number}")
        sent.unpersist()
    return spark.read.schema(schema).parquet(f"{folder}/hits").select(*schema.names)
