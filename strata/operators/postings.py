"""BM25 by an inverted index.

A posting row holds one term in one segment (up to ``SEGMENT`` chunks that lie side by
side in corpus order): the places of the chunks that have the term, how often they have
it, and their lengths. So a frequent term is spread over as many rows as there are
segments. The rows of a file are sorted by term, and the term column carries Bloom
filters, so a search reads the row groups of its own terms only.

For each block of ``BLOCK`` places a row also keeps the greatest frequency and the
shortest length. They bound what the term can add to any score of the block, whatever
the mean length has become since, so a search skips blocks whose bounds add up to less
than the k-th best score it has already seen.

Segments meet their postings by a shuffle of the postings of the query's terms alone; the
chunks themselves are not read. A row of each segment with the empty term (no token is
empty) says how many chunks and tokens it has, so chunks without any query term still
fill up the k with score zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.functions.text import one_of, tokens
from strata.operators.bm25 import Bm25Stats, terms_bytes
from strata.operators.chunks import ORDER
from strata.operators.sizing import broadcast_if_small
from strata.operators.topk import MAX_CELLS, SCORE_DIGITS, SPARE, best_rows
from strata.session import work_path

SEGMENT = 2048
BLOCK = 512
PLACE = ("_bucket", "_share", "_segment")
# places, tfs: of a term's chunks; bounds: (block, greatest frequency, shortest length) of its blocks;
# lengths: of all chunks, in size rows only. All are 32-bit numbers in little-endian order.
POSTINGS = (
    "_bucket int, _share int, _segment int, term string, df int, places binary, tfs binary, bounds binary, "
    "lengths binary, tokens long"
)
NEEDED = ("term", "df", "places", "tfs", "bounds", "lengths")
FILTERED_TERMS = 10_000  # more query terms than these are sought by a join


IN_PARTITION = (1 << 33) - 1  # the bits of ``monotonically_increasing_id`` that count within a partition


def with_places(laid_out: DataFrame) -> DataFrame:
    """``_place`` of each chunk: its number, in corpus order, within its bucket and share.

    Each bucket and share must be a partition of its own, as ``buckets.laid_out`` leaves
    them; so the rows are sorted where they are and not shuffled once more.
    """
    ordered = laid_out.sortWithinPartitions(*ORDER)
    return ordered.withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PARTITION)).cast("int"))


def _packed(offsets: np.ndarray, values: np.ndarray, width: int = 1) -> pa.Array:
    """Binary values: row i holds the numbers ``values[offsets[i]:offsets[i + 1]]`` (rows of ``width`` numbers)."""
    edges = (offsets * (4 * width)).astype(np.int32)
    numbers = np.ascontiguousarray(values, dtype="<i4")
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(numbers)])


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(how many numbers each row holds, all numbers) of a packed column."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy() // 4
    return sizes, np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype="<i4")


def _posting_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Posting rows of chunks (_bucket, _share, _place, tokens); a segment in two batches gives two rows a term."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        bucket, share, place = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        where = np.lexsort((place, share, bucket))
        bucket, share, place = bucket[where], share[where], place[where]
        segment, inside = place // SEGMENT, place % SEGMENT
        lists = batch.column(3).take(pa.array(where))
        firsts = np.flatnonzero(np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(share) != 0) | (np.diff(segment) != 0)]))
        ends = np.append(firsts[1:], n)
        group = np.repeat(np.arange(len(firsts)), ends - firsts)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

        codes = lists.flatten().dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, tf = np.unique(code * n + np.repeat(np.arange(n), lengths), return_counts=True)
        term, row = pairs // n, pairs % n
        starts = np.flatnonzero(np.diff(term * len(firsts) + group[row], prepend=-1))
        offsets = np.append(starts, len(row))
        of = group[row[starts]]
        block = inside[row] // BLOCK
        cut = np.union1d(starts, np.flatnonzero(np.diff(block, prepend=-1)))
        if len(cut):
            bounds = np.column_stack([block[cut], np.maximum.reduceat(tf, cut), np.minimum.reduceat(lengths[row], cut)])
        else:
            bounds = np.empty((0, 3))

        n_groups = len(firsts)
        keys = [np.concatenate([x[firsts][of], x[firsts]]) for x in (bucket, share, segment)]
        nothing = np.full(n_groups, len(row))
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array(key, pa.int32()) for key in keys],
                pa.concat_arrays([codes.dictionary.take(pa.array(term[starts])).cast(pa.string()), pa.array([""] * n_groups)]),
                pa.array(np.concatenate([np.diff(offsets), ends - firsts]), pa.int32()),
                _packed(np.concatenate([offsets, len(row) + ends]), np.concatenate([inside[row], inside])),
                _packed(np.concatenate([offsets, nothing]), tf),
                _packed(np.concatenate([np.searchsorted(cut, starts), np.full(n_groups + 1, len(cut))]), bounds, 3),
                _packed(np.concatenate([np.zeros(len(starts) + 1, dtype=np.int64), ends]), lengths),
                pa.array(np.concatenate([np.zeros(len(starts), dtype=np.int64), np.add.reduceat(lengths, firsts)])),
            ],
            names=[*PLACE, *NEEDED, "tokens"],
        )


def postings(chunks: DataFrame) -> DataFrame:
    """Posting rows of placed chunks with ``tokens``; the size row of a segment has the empty term."""
    return chunks.select("_bucket", "_share", "_place", "tokens").mapInArrow(_posting_rows, POSTINGS)


def is_size() -> Column:
    return F.col("term") == ""


def sizes_of(posting_rows: DataFrame) -> DataFrame:
    """(_bucket, _share, _segment, df, tokens): how many chunks and tokens a segment, or a part of one, has."""
    return posting_rows.where(is_size()).select(*PLACE, "df", "tokens")


def _number(packed: str, at: Column) -> Column:
    """The number at a place of a packed column."""
    # Byte by byte: ``reverse`` takes bytes for text and keeps those of a character together.
    digits = F.concat(*[F.hex(F.substring(packed, at * 4 + byte, 1)) for byte in (4, 3, 2, 1)])
    return F.conv(digits, 16, 10).cast("int")


def posting_entries(posting_rows: DataFrame) -> DataFrame:
    """(term, _bucket, _share, place, tf): a row for each chunk that has a term."""
    at = F.explode(F.sequence(F.lit(0), F.col("df") - 1)).alias("at")
    rows = posting_rows.select("term", *PLACE, "places", "tfs", at)
    place = F.col("_segment") * SEGMENT + _number("places", F.col("at"))
    return rows.select("term", "_bucket", "_share", place.alias("place"), _number("tfs", F.col("at")).alias("tf"))


def bound_entries(posting_rows: DataFrame) -> DataFrame:
    """(term, _bucket, _share, _segment, block, most, least): a row for each block that has a term."""
    blocks = F.floor(F.octet_length("bounds") / 12).cast("int")
    rows = posting_rows.select("term", *PLACE, "bounds", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("at"))
    names = ("block", "most", "least")
    return rows.select("term", *PLACE, *[_number("bounds", F.col("at") * 3 + i).alias(n) for i, n in enumerate(names)])


@dataclass(frozen=True)
class QueryTerms:
    """The terms of a block of queries: which query weighs which term how much."""

    ids: pa.Array
    terms: list[str]
    query: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    def groups(self) -> list[QueryGroup]:
        """The queries in groups whose weights of shared terms, queries x terms, stay below ``MAX_CELLS``."""
        found, n = [], len(self.ids)
        order = np.argsort(self.query, kind="stable")
        query, term, weight = self.query[order], self.term[order], self.weight[order]
        edges = np.searchsorted(query, np.arange(n + 1))
        a = 0
        while a < n:
            b, size = a, 0
            while b < n and (b == a or (b + 1 - a) * max(size + edges[b + 1] - edges[b], BLOCK) <= MAX_CELLS // 2):
                size += edges[b + 1] - edges[b]
                b += 1
            span = slice(edges[a], edges[b])
            found.append(QueryGroup(np.arange(a, b), query[span] - a, term[span], weight[span], len(self.terms)))
            a = b
        return found


SHARED = 8  # queries that weigh a term; the scores of such terms are multiplied out as matrices


class QueryGroup:
    """The weights of some queries: a matrix of the terms that many of them share, lists of the others."""

    def __init__(self, queries: np.ndarray, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int):
        self.queries = queries
        self.n_terms = n_terms
        fan = np.bincount(term, minlength=n_terms)
        self.shared = np.flatnonzero(fan >= SHARED)
        self.column = np.full(n_terms, -1)
        self.column[self.shared] = np.arange(len(self.shared))
        wide = self.column[term] >= 0
        self.matrix = np.zeros((len(queries), len(self.shared)))
        self.matrix[query[wide], self.column[term[wide]]] = weight[wide]
        order = np.argsort(term[~wide], kind="stable")
        self.query, self.weight, self.term = query[~wide][order], weight[~wide][order], term[~wide][order]
        self.starts = np.searchsorted(self.term, np.arange(n_terms + 1))

    def summed(self, term: np.ndarray, at: np.ndarray, value: np.ndarray, width: int, positive: bool = False) -> np.ndarray:
        """Matrix of queries x ``width``: weight times value of all (term, at, value); of weights above 0 if ``positive``."""
        column = self.column[term]
        wide = column >= 0
        parts = np.zeros((len(self.shared), width))
        parts[column[wide], at[wide]] = value[wide]
        matrix, weights = (np.maximum(self.matrix, 0), np.maximum(self.weight, 0)) if positive else (self.matrix, self.weight)
        term, at, value = term[~wide], at[~wide], value[~wide]
        fan = self.starts[term + 1] - self.starts[term]
        entry = np.repeat(self.starts[term] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
        cells = self.query[entry] * width + np.repeat(at, fan)
        thin = np.bincount(cells, weights=weights[entry] * np.repeat(value, fan), minlength=len(self.queries) * width)
        return matrix @ parts + thin.reshape(len(self.queries), width)


def query_terms(block: pa.Table, df_of: Callable[[list[str]], dict[str, int]], stats: Bm25Stats) -> QueryTerms:
    """Terms of queries (query_id, tokens), each weighed by its count in the query times its idf."""
    lists = block.column("tokens").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    known = df_of(words)
    n = len(words)
    pairs, times = np.unique(
        np.repeat(np.arange(len(lists)), lengths) * max(n, 1) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True
    )
    query, word = pairs // max(n, 1), pairs % max(n, 1)
    df = np.array([known.get(w, 0) for w in words], dtype=np.float64)
    raw = np.log(np.maximum(stats.chunks - df + 0.5, 0.5)) - np.log(df + 0.5)
    idf = np.where(raw < 0, stats.epsilon * stats.mean_idf, raw)
    there = df[word] > 0
    query, word, times = query[there], word[there], times[there]
    used, term = np.unique(word, return_inverse=True)
    ids = block.column("query_id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    return QueryTerms(ids, [words[w] for w in used], query, term, times * idf[word])


@dataclass(frozen=True)
class SegmentScorer:
    """Scores the chunks of one segment from its posting rows."""

    avgdl: float
    k: int
    k1: float = 1.5
    b: float = 0.75

    def part(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What a term of weight 1 adds to a chunk of this length that has it ``tf`` times."""
        scale = self.k1 * (1 - self.b + self.b * length / (self.avgdl or 1.0))
        return tf * (self.k1 + 1) / (tf + scale)


class _Search:
    """The best chunks of each query among the segments that a task has seen."""

    def __init__(self, terms: QueryTerms, scorer: SegmentScorer):
        self.scorer = scorer
        self.groups = terms.groups()
        self.n_queries = len(terms.ids)
        self.vocabulary = pa.array(terms.terms, pa.string())
        self.bar = np.full(self.n_queries, -np.inf)  # k-th best rounded score so far
        self.held: list[np.ndarray] = []  # columns: query, place of the segment, place in it, score, rounded score
        self.n_held = 0
        self.segments: list[tuple] = []
        self.blocks_scored = self.blocks_skipped = 0

    def add(self, where: tuple, rows: pa.Table) -> None:
        size = pc.equal(rows.column("term"), "").to_numpy().astype(bool)
        sizes = rows.filter(pa.array(size))
        n_chunks = int(sizes.column("df").to_numpy().sum())
        if not n_chunks or not self.n_queries:
            return
        lengths = np.zeros(SEGMENT)
        lengths[_numbers(sizes.column("places"))[1]] = _numbers(sizes.column("lengths"))[1]
        rows = rows.filter(pa.array(~size))
        row_term = pc.index_in(rows.column("term"), value_set=self.vocabulary).to_numpy().astype(np.int64)
        n_blocks = -(-n_chunks // BLOCK)
        n_bounds, bounds = _numbers(rows.column("bounds"))
        bounds = bounds.reshape(-1, 3)
        bound_cells, cell = np.unique(np.repeat(row_term, n_bounds // 3) * n_blocks + bounds[:, 0], return_inverse=True)
        bound = np.zeros(len(bound_cells))  # a segment in two parts has two bounds for a block
        np.maximum.at(bound, cell, self.scorer.part(bounds[:, 1], bounds[:, 2]))
        n_places, place = _numbers(rows.column("places"))
        of = np.repeat(row_term, n_places)
        added = self.scorer.part(_numbers(rows.column("tfs"))[1], lengths[place])
        order = np.argsort(place // BLOCK, kind="stable")
        of, place, added = of[order], place[order], added[order]
        edges = np.searchsorted(place // BLOCK, np.arange(n_blocks + 1))
        number = len(self.segments)
        self.segments.append(where)
        for group in self.groups:
            reach = group.summed(bound_cells // n_blocks, bound_cells % n_blocks, bound, n_blocks, positive=True)
            active = (reach * (1 + 1e-12) + 10.0**-SCORE_DIGITS >= self.bar[group.queries][:, None]).any(axis=0)
            self.blocks_scored += int(active.sum())
            self.blocks_skipped += int((~active).sum())
            for b in np.flatnonzero(active):
                first = b * BLOCK
                span = slice(edges[b], edges[b + 1])
                width = min(BLOCK, n_chunks - first)
                scores = group.summed(of[span], place[span] - first, added[span], width).T
                key = np.round(scores, SCORE_DIGITS)
                row, column = best_rows(key, self.scorer.k)
                query = group.queries[column]
                enough = key[row, column] >= self.bar[query]
                row, column, query = row[enough], column[enough], query[enough]
                found = [query, np.full(len(row), number), first + row, scores[row, column], key[row, column]]
                self.held.append(np.column_stack([c.astype(np.float64) for c in found]))
                self.n_held += len(row)
        if self.n_held > SPARE * self.scorer.k * self.n_queries:
            self._cut()

    def _cut(self) -> None:
        """Keep what is as good as the k-th best; ties stay, as other segments may come before."""
        rows = np.concatenate(self.held)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 4], rows[:, 0]))]
        query = rows[:, 0]
        first = np.searchsorted(query, query)
        place = np.arange(len(rows)) - first
        last = np.flatnonzero(place == self.scorer.k - 1)
        self.bar[query[last].astype(np.int64)] = rows[last, 4]
        kept = rows[:, 4] >= self.bar[query.astype(np.int64)]
        self.held, self.n_held = [rows[kept]], int(kept.sum())

    def batches(self, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        if not self.n_held:
            return
        self._cut()
        rows = self.held[0]
        where = np.array(self.segments)[rows[:, 1].astype(np.int64)]
        place = where[:, 2] * SEGMENT + rows[:, 2].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(rows[:, 0].astype(np.int64))),
                pa.array(where[:, 0], pa.int32()),
                pa.array(where[:, 1], pa.int32()),
                pa.array(place, pa.int32()),
                pa.array(rows[:, 3]),
                pa.array(rows[:, 4]),
            ],
            names=["query_id", "_bucket", "_share", "_place", "score", "_sort_key"],
        )


def _search(sent: Broadcast, scorer: SegmentScorer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = QueryTerms(*sent.value)
        search = _Search(wanted, scorer)
        where, parts = None, []
        for batch in batches:
            heads = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            edges = np.concatenate([[0], np.flatnonzero(np.any(np.diff(heads, axis=0) != 0, axis=1)) + 1, [len(heads)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if a == b:
                    continue
                head = tuple(heads[a].tolist())
                if head != where and parts:
                    search.add(where, pa.Table.from_batches(parts))
                    parts = []
                where = head
                parts.append(batch.slice(a, b - a))
        if parts:
            search.add(where, pa.Table.from_batches(parts))
        yield from search.batches(wanted.ids)

    return rows


def known_frequencies(frequencies: DataFrame, words: list[str]) -> dict[str, int]:
    """Chunks that hold each of some words; a few thousand words are sought by a pushed-down filter."""
    if not words:
        return {}
    if len(words) <= FILTERED_TERMS:
        found = frequencies.where(one_of("term", words))
    else:
        spark = frequencies.sparkSession
        wanted = spark.createDataFrame(pa.table({"term": pa.array(words, pa.string())}))
        found = frequencies.join(F.broadcast(wanted), "term", "left_semi")  # within the bound of the queries' block
    return {r["term"]: r["df"] for r in found.collect()}


def postings_topk(
    posting_rows: DataFrame,
    chunks: DataFrame,
    queries: DataFrame,
    frequencies: DataFrame,
    stats: Bm25Stats,
    n_segments: int,
    k: int = 5,
    k1: float = 1.5,
    b: float = 0.75,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """(query_id, chunk_id, doc_id, chunk_index, score, rank): the k best chunks of each query.

    Queries whose terms are over ``broadcast_bytes`` are sent in blocks, one after the other.
    """
    worded = queries.select("query_id", tokens(F.col("query")).alias("tokens"))
    size = terms_bytes(queries)
    scorer = SegmentScorer(stats.avgdl, k, k1, b)
    places = [T.StructField(c, T.IntegerType()) for c in ("_bucket", "_share", "_place")]
    scores = [T.StructField(c, T.DoubleType()) for c in ("score", "_sort_key")]
    schema = T.StructType([queries.schema["query_id"], *places, *scores])

    def search(block: pa.Table) -> DataFrame:
        terms = query_terms(block, lambda words: known_frequencies(frequencies, words), stats)
        needed = posting_rows.select(*PLACE, *NEEDED)
        if len(terms.terms) <= FILTERED_TERMS:
            needed = needed.where(one_of("term", ["", *terms.terms]))
        else:
            wanted = queries.sparkSession.createDataFrame(pa.table({"term": pa.array(["", *terms.terms], pa.string())}))
            needed = needed.join(F.broadcast(wanted), "term", "left_semi").select(*PLACE, *NEEDED)
        sent = queries.sparkSession.sparkContext.broadcast((terms.ids, terms.terms, terms.query, terms.term, terms.weight))
        return needed.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(_search(sent, scorer), schema)

    if size <= broadcast_bytes:
        block = worded.toArrow()
        found, n_queries = search(block), block.num_rows
    else:
        spark = queries.sparkSession
        folder = work_path(spark, "bm25")
        worded.write.parquet(f"{folder}/queries")
        stored = spark.read.schema(worded.schema).parquet(f"{folder}/queries")
        spark.createDataFrame([], schema).write.parquet(f"{folder}/hits/block=-1")
        n_queries, n_blocks = 0, max(2, -(-size // max(1, broadcast_bytes)))
        for number in range(n_blocks):
            block = stored.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == number).toArrow()
            if block.num_rows:
                n_queries += block.num_rows
                search(block).write.parquet(f"{folder}/hits/block={number}")
        found = spark.read.schema(schema).parquet(f"{folder}/hits").select(*schema.names)

    if n_queries * k * max(1, n_segments) * 128 <= broadcast_bytes:  # a segment gives k rows a query at most
        best_hits = F.broadcast(found)
    else:
        best = Window.partitionBy("query_id").orderBy(F.desc("_sort_key"))
        best_hits = found.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= k).drop("_rank")
        best_hits = broadcast_if_small(_stored(best_hits), broadcast_bytes)
    named = chunks.select("chunk_id", *ORDER, "_bucket", "_share", "_place").join(best_hits, ["_bucket", "_share", "_place"])
    order = Window.partitionBy("query_id").orderBy(F.desc("_sort_key"), *ORDER)
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "chunk_id", *ORDER, "score", "rank")


def _stored(df: DataFrame) -> DataFrame:
    path = work_path(df.sparkSession, "bm25-hits")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
