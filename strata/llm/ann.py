"""Nearest neighbours by learned partitions (operator 6).

1. A bounded sample of vectors gives a neighbour graph. It is cut into balanced
   parts: recursive bisection along the graph's second eigenvector, at the place that
   keeps the sides' sizes in proportion, then swaps that lower the cut.
2. A small network (one hidden layer, numpy) learns from a vector in which parts its
   neighbours lie.
3. Every row is assigned to its most probable part. A query goes to the most probable
   parts until they hold ``mass`` of the probability, ``least_probes`` parts and more
   than ``k`` rows.
4. Queries meet the rows of their parts in groups of bounded size (a part is split into
   blocks by a hash of the id, queries too), where exact inner products in double
   precision rank them. The most probable part of a query is searched first; its k-th
   score is a bar, and of the other parts only rows that reach the bar leave their
   group, ``k`` a query at most. What is merged so hardly grows with the parts searched.

A part that holds a third of all rows, such as one vector many times, is more blocks,
not a larger task. The classifier is fitted on the sample alone; every row is indexed.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components,
or have another length than most, take no part, nor do rows without id; rows of one id
are one vector (the smallest); ties go to the smaller id; fewer than ``k`` candidates
are all returned; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.llm.common import long_id, staged


@dataclass(frozen=True)
class AnnSettings:
    k: int = 20
    sample_rows: int = 6000  # vectors the graph and the network see
    neighbours: int = 40  # in the graph
    part_rows: int = 2048  # rows aimed at in a part
    most_parts: int = 256
    mass: float = 0.93  # about the recall to expect
    least_probes: int = 3
    block_rows: int = 8192  # rows, and queries, in a group
    hidden: int = 128
    epochs: int = 30
    batch: int = 128
    rate: float = 0.003
    seed: int = 5


def neighbour_graph(x: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` rows of largest inner product with each row, itself left out."""
    n = min(n, len(x) - 1)
    out = np.empty((len(x), n), dtype=np.int64)
    for start in range(0, len(x), 512):
        scores = x[start : start + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -np.inf
        out[start : start + 512] = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    return out


def _bisect(rows: np.ndarray, graph: np.ndarray, share: float, random: np.random.Generator) -> np.ndarray:
    """True for the rows of the first side, ``share`` of them; few graph edges cross."""
    place = np.full(graph.shape[0], -1, dtype=np.int64)
    place[rows] = np.arange(len(rows))
    to = place[graph[rows]]
    a, b = np.repeat(np.arange(len(rows)), to.shape[1])[to.ravel() >= 0], to.ravel()[to.ravel() >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(rows)) + 1e-9
    v = random.standard_normal(len(rows))
    for _ in range(60):  # lazy random walk, the constant part removed
        v = 0.5 * v + 0.5 * np.bincount(a, weights=v[b], minlength=len(rows)) / degree
        v -= np.average(v, weights=degree)
        v /= np.linalg.norm(v) + 1e-12
    first = np.zeros(len(rows), dtype=bool)
    size = round(len(rows) * share)
    first[np.argsort(v, kind="stable")[:size]] = True
    for _ in range(10):
        with_first = np.bincount(a, weights=first[b].astype(float), minlength=len(rows))
        gain = np.where(first, degree - 2 * with_first, 2 * with_first - degree)
        out = np.flatnonzero(first)
        into = np.flatnonzero(~first)
        out, into = out[np.argsort(-gain[out], kind="stable")], into[np.argsort(-gain[into], kind="stable")]
        n = min(len(out), len(into), max(1, len(rows) // 20))
        better = (gain[out[:n]] + gain[into[:n]]) > 2
        if not better.any():
            break
        first[out[:n][better]], first[into[:n][better]] = False, True
    return first


def balanced_parts(graph: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """A part of each row of the graph; sizes differ by rounding alone."""
    random = np.random.default_rng(seed)
    out = np.zeros(len(graph), dtype=np.int64)
    todo = [(np.arange(len(graph)), 0, parts)]
    while todo:
        rows, start, n = todo.pop()
        if n == 1 or len(rows) < 2:
            out[rows] = start
            continue
        first = _bisect(rows, graph, (n // 2) / n, random)
        todo += [(rows[first], start, n // 2), (rows[~first], start + n // 2, n - n // 2)]
    return out


@dataclass(frozen=True)
class Router:
    """Probabilities of the parts for a vector."""

    scale: float
    weights: tuple[np.ndarray, ...]

    @property
    def parts(self) -> int:
        return len(self.weights[3])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        # row by row products, so that equal vectors get equal results
        hidden = np.maximum(np.einsum("ij,jk->ik", x / self.scale, w1) + b1, 0)
        return _softmax(np.einsum("ij,jk->ik", hidden, w2) + b2)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, parts: int, s: AnnSettings) -> Router:
    """Cut the sample's neighbour graph and learn to route to its parts."""
    x = np.asarray(x, dtype=np.float64)
    scale = float(np.sqrt((x**2).mean())) or 1.0
    if parts < 2 or len(x) < 4:
        return Router(scale, (np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)))
    graph = neighbour_graph(x, s.neighbours)
    part = balanced_parts(graph, parts, s.seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    random = np.random.default_rng(s.seed)
    data = x / scale
    w = [
        random.standard_normal((x.shape[1], s.hidden)) * math.sqrt(2 / x.shape[1]),
        np.zeros(s.hidden),
        random.standard_normal((s.hidden, parts)) * math.sqrt(1 / s.hidden),
        np.zeros(parts),
    ]
    mean, square, step = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    total = s.epochs * -(-len(x) // s.batch)
    for _ in range(s.epochs):
        order = random.permutation(len(x))
        for start in range(0, len(x), s.batch):
            rows = order[start : start + s.batch]
            hidden = np.maximum(data[rows] @ w[0] + w[1], 0)
            error = (_softmax(hidden @ w[2] + w[3]) - target[rows]) / len(rows)
            back = (error @ w[2].T) * (hidden > 0)
            grads = [data[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            rate = s.rate * (1 - step / (total + 1))
            for i, g in enumerate(grads):
                mean[i] += 0.1 * (g - mean[i])
                square[i] += 0.001 * (g * g - square[i])
                w[i] -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return Router(scale, tuple(w))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as doubles."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, one for each id."""
    vector = df[vector_col].cast("array<double>")
    rows = df.select(long_id(df, id_col).alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vector", lambda v: v != 0)
    )
    rows = staged(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (usual["n"] if usual else 0))


def train(rows: DataFrame, settings: AnnSettings = AnnSettings()) -> Router | None:
    """Fit on at most ``sample_rows`` vectors, drawn by a hash of the id."""
    s = settings
    n = rows.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.lit(s.seed), "vec_id"), F.lit(1_000_000_007))
    sample = rows.where(draw <= int(1_000_000_007 * min(1.0, 1.2 * s.sample_rows / n)))
    sample = sample.orderBy(draw, "vec_id").limit(s.sample_rows).select("vector").toArrow()
    parts = max(1, min(s.most_parts, round(n / s.part_rows), sample.num_rows // 32))
    return fit(matrix(sample.column("vector")), parts, s) if sample.num_rows else None


def _route(sent, sizes: dict[int, int] | None, s: AnnSettings):
    """(vec_id, part), or with the parts' sizes (vec_id, parts to search)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = sent.value
        held = None if sizes is None else np.array([sizes.get(p, 0) for p in range(router.parts)])
        for batch in batches:
            if not batch.num_rows:
                continue
            p = router(matrix(batch.column(1)))
            if held is None:
                extra, name = pa.array(p.argmax(axis=1).astype(np.int32)), "part"
            else:
                order = np.argsort(-p, axis=1, kind="stable")
                mass = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
                rows_so_far = np.cumsum(held[order], axis=1)
                done = (mass >= s.mass) & (rows_so_far > s.k) & (np.arange(router.parts) + 1 >= s.least_probes)
                n = np.where(done.any(axis=1), done.argmax(axis=1) + 1, router.parts)
                extra = pa.array([order[i, : n[i]].astype(np.int32) for i in range(len(n))], pa.list_(pa.int32()))
                name = "parts"
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), extra], names=["vec_id", "vector", name])

    return rows


HITS = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def _best(k: int):
    """The ``k`` best rows of a group for each of its queries, by exact inner products, that reach the query's bar."""

    def best(rows: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not rows.num_rows or not queries.num_rows:
            return empty
        ids, x = rows.column("vec_id").to_numpy(), matrix(rows.column("vector"))
        query_ids, q = queries.column("query_id").to_numpy(), matrix(queries.column("query"))
        least = queries.column("bar").to_numpy()
        slack = 1e-12 * np.linalg.norm(x, axis=1).max()
        found = []
        for start in range(0, len(q), 256):
            part, part_ids = q[start : start + 256], query_ids[start : start + 256]
            rough = part @ x.T
            rough[part_ids[:, None] == ids[None, :]] = -np.inf
            n = min(k, len(ids))
            bar = np.partition(rough, len(ids) - n, axis=1)[:, len(ids) - n]
            bar = np.maximum(bar, least[start : start + 256]) - slack * np.linalg.norm(part, axis=1)
            at_query, at_row = np.nonzero((rough >= bar[:, None]) & np.isfinite(rough))
            score = np.empty(len(at_row))
            for i in range(0, len(at_row), 1 << 16):  # summed alike for each pair: equal vectors tie
                score[i : i + (1 << 16)] = np.einsum(
                    "ij,ij->i", part[at_query[i : i + (1 << 16)]], x[at_row[i : i + (1 << 16)]]
                )
            reach = score >= least[start + at_query]
            at_query, at_row, score = at_query[reach], at_row[reach], score[reach]
            order = np.lexsort((ids[at_row], -score, at_query))
            at_query, at_row, score = at_query[order], at_row[order], score[order]
            first = np.searchsorted(at_query, at_query)
            keep = np.arange(len(at_query)) - first < k
            found.append((part_ids[at_query[keep]], ids[at_row[keep]], score[keep]))
        return pa.table(
            {
                "query_id": pa.array(np.concatenate([f[0] for f in found])),
                "vec_id": pa.array(np.concatenate([f[1] for f in found])),
                "score": pa.array(np.concatenate([f[2] for f in found])),
            }
        )

    return best


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    settings: AnnSettings = AnnSettings(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each row where ``is_query`` (a condition on ``vec_id``) holds."""
    s = settings
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    router = train(rows, s)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(router)
    vector = "vector array<double>"
    index = staged(rows.mapInArrow(_route(sent, None, s), f"vec_id long, {vector}, part int"), "parts")
    sizes = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # one row a part
    queries = rows.where(is_query).mapInArrow(_route(sent, sizes, s), f"vec_id long, {vector}, parts array<int>")
    queries = staged(
        queries.select(
            F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.posexplode("parts").alias("place", "part")
        ),
        "queries",
    )

    def blocks(counts: dict[int, int]) -> Column:
        """How many blocks a part's rows make; an array by part, as a foldable literal."""
        numbers = [max(1, -(-counts.get(p, 0) // s.block_rows)) for p in range(router.parts)]
        return F.get(F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>"), F.col("part"))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    def search(wanted: DataFrame) -> DataFrame:
        """Hits of (query_id, query, part, bar)."""
        asked = {r["part"]: r["count"] for r in wanted.groupBy("part").count().collect()}
        left = (
            index.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks(sizes)).cast("int"))
            .withColumn("queries", every(blocks(asked)))
            .groupBy("part", "block", "queries")
        )
        right = (
            wanted.withColumn("queries", F.pmod(F.xxhash64("query_id"), blocks(asked)).cast("int"))
            .withColumn("block", every(blocks(sizes)))
            .groupBy("part", "block", "queries")
        )
        return left.cogroup(right).applyInArrow(_best(s.k), HITS)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(hits: DataFrame) -> DataFrame:
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k)

    nothing = F.lit(float("-inf"))
    first = staged(ranked(search(queries.where("place = 0").drop("place").withColumn("bar", nothing))).drop("rank"), "first-hits")
    bars = first.groupBy("query_id").agg(F.when(F.count("*") == s.k, F.min("score")).alias("bar"))
    rest = queries.where("place > 0").join(bars, "query_id", "left").withColumn("bar", F.coalesce("bar", nothing))
    found = first.unionByName(search(rest.select("query_id", "query", "part", "bar")))
    return ranked(found).select("query_id", "rank", "vec_id", "score")
