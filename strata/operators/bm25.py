"""Lexical retrieval: BM25 Okapi and the plain term-containment count."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.text import tokens
from strata.operators.sizing import measured_bytes
from strata.operators.topk import topk_hits

try:
    import ahocorasick
except ImportError:  # the substring test below does the same, term by term
    ahocorasick = None


TERM_FACTOR = 8


def with_tokens(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("tokens", tokens(F.col("text")))


def document_frequencies(chunks: DataFrame) -> DataFrame:
    """(term, df). Counted on the map side first, so a word in every chunk is no hot key."""
    terms = chunks.select(F.explode(F.array_distinct("tokens")).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_size() -> tuple[Column, Column]:
    """Aggregates: the number of chunks and of their tokens (empty chunks count)."""
    return F.count(F.lit(1)).alias("chunks"), F.sum(F.size("tokens")).alias("tokens")


def raw_idf(df: Column, n: int) -> Column:
    return F.log(F.lit(float(n)) - df + F.lit(0.5)) - F.log(df + F.lit(0.5))


@dataclass(frozen=True)
class Bm25Stats:
    """Scalars of a corpus; the per-term counts stay in a table."""

    chunks: int
    avgdl: float
    mean_idf: float
    epsilon: float = 0.25

    def idf(self, df: Column) -> Column:
        """A negative idf is replaced by a share of the vocabulary's mean idf."""
        raw = raw_idf(df, self.chunks)
        return F.when(raw < 0, F.lit(self.epsilon * self.mean_idf)).otherwise(raw)


def corpus_stats(size: dict, frequencies: DataFrame, epsilon: float = 0.25) -> Bm25Stats:
    """Scalars from the counted corpus size and the document frequencies."""
    n, n_tokens = size["chunks"], size["tokens"] or 0
    mean = frequencies.agg(F.avg(raw_idf(F.col("df"), n)).alias("mean")).first()["mean"]
    return Bm25Stats(n, n_tokens / n if n else 0.0, mean or 0.0, epsilon)


def term_table(frequencies: DataFrame, stats: Bm25Stats) -> DataFrame:
    """(term, df, idf) of the whole vocabulary."""
    return frequencies.select("term", "df", stats.idf(F.col("df")).alias("idf"))


def terms_bytes(queries: DataFrame) -> int:
    """Upper bound of the size of the queries' terms, from the size of their texts.

    A text of n bytes has at most n / 2 terms, and each adds its bytes, an
    offset and a weight.
    """
    return TERM_FACTOR * measured_bytes(queries.select("query_id", "query"))


def weighted_queries(queries: DataFrame, frequencies: DataFrame, stats: Bm25Stats, small: bool = False) -> DataFrame:
    """(query_id, terms): each query term with its count in the query times its idf.

    ``small`` queries are broadcast, so the vocabulary is only scanned. A query
    without any known term keeps its row with an empty list.
    """
    counted = (
        queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    vocabulary = term_table(frequencies, stats)
    weights = vocabulary.join(F.broadcast(counted) if small else counted, "term").select(
        "query_id",
        F.struct("term", (F.col("times") * F.col("idf")).alias("weight")).alias("entry"),
    )
    lists = weights.groupBy("query_id").agg(F.sort_array(F.collect_list("entry")).alias("terms"))
    empty = F.array().cast("array<struct<term:string,weight:double>>")
    return queries.select("query_id").join(lists, "query_id", "left").select(
        "query_id", F.coalesce("terms", empty).alias("terms")
    )


@dataclass(frozen=True)
class Bm25Scorer:
    avgdl: float
    k1: float = 1.5
    b: float = 0.75
    columns: tuple[str, ...] = ("tokens",)

    def prepare(self, queries: pa.Table):
        """Vocabulary of the queries and, per term, the queries that weigh it."""
        lists = queries.column("terms").combine_chunks()
        entries = lists.flatten()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        query_of = np.repeat(np.arange(len(lists)), lengths)
        terms = entries.field("term").dictionary_encode()
        codes = terms.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        starts = np.searchsorted(codes[order], np.arange(len(terms.dictionary) + 1))
        weights = entries.field("weight").to_numpy(zero_copy_only=False)
        return terms.dictionary, starts, query_of[order], weights[order], len(lists)

    def score(self, rows: pa.Table, prepared) -> np.ndarray:
        vocabulary, starts, query_of, weights, n_queries = prepared
        lists = rows.column("tokens").combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        scores = np.zeros(len(lists) * n_queries)
        if len(vocabulary) == 0:
            return scores.reshape(len(lists), n_queries)
        found = pc.index_in(lists.flatten(), value_set=vocabulary)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        row_of = np.repeat(np.arange(len(lists)), lengths)[known]
        term_of = found.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, tf = np.unique(row_of * len(vocabulary) + term_of, return_counts=True)
        row_of, term_of = pairs // len(vocabulary), pairs % len(vocabulary)
        scale = self.k1 * (1 - self.b + self.b * lengths[row_of] / (self.avgdl or 1.0))
        part = tf * (self.k1 + 1) / (tf + scale)
        # One entry per (posting, query that weighs the term).
        fan = starts[term_of + 1] - starts[term_of]
        at = np.repeat(starts[term_of] - np.concatenate(([0], np.cumsum(fan)[:-1])), fan) + np.arange(fan.sum())
        cells = np.repeat(row_of, fan) * n_queries + query_of[at]
        scores += np.bincount(cells, weights=np.repeat(part, fan) * weights[at], minlength=len(scores))
        return scores.reshape(len(lists), n_queries)


def bm25_topk(
    corpus: DataFrame,
    queries: DataFrame,
    frequencies: DataFrame,
    stats: Bm25Stats,
    k: int = 5,
    k1: float = 1.5,
    b: float = 0.75,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """The k best chunks of each query (query_id, query); zero scores still fill k."""
    size = terms_bytes(queries)
    weighted = weighted_queries(queries, frequencies, stats, size <= broadcast_bytes)
    return topk_hits(corpus, weighted, Bm25Scorer(stats.avgdl, k1, b), k, broadcast_bytes, size)


@dataclass(frozen=True)
class ContainmentScorer:
    """How many query tokens the lower-cased text contains; a repeated token counts again."""

    columns: tuple[str, ...] = ("lowered",)

    def prepare(self, queries: pa.Table):
        lists = queries.column("tokens").combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        terms = lists.flatten().dictionary_encode()
        codes = terms.indices.to_numpy(zero_copy_only=False)
        vocabulary = terms.dictionary.to_pylist()
        counts = np.zeros((len(vocabulary), len(lists)))
        np.add.at(counts, (codes, np.repeat(np.arange(len(lists)), lengths)), 1)
        automaton = None
        if ahocorasick is not None and vocabulary:
            automaton = ahocorasick.Automaton()
            for code, term in enumerate(vocabulary):
                automaton.add_word(term, code)
            automaton.make_automaton()
        return vocabulary, counts, automaton

    def score(self, rows: pa.Table, prepared) -> np.ndarray:
        vocabulary, counts, automaton = prepared
        texts = rows.column("lowered").combine_chunks()
        if not vocabulary:
            return np.zeros((len(texts), counts.shape[1]))
        if automaton is None:
            present = np.column_stack(
                [pc.match_substring(texts, term).to_numpy(zero_copy_only=False) for term in vocabulary]
            )
            return present.astype(np.float64) @ counts
        scores = np.empty((len(texts), counts.shape[1]))
        for i, text in enumerate(texts.to_pylist()):
            scores[i] = counts[list({code for _, code in automaton.iter(text)})].sum(axis=0)
        return scores


def keyword_topk(corpus: DataFrame, queries: DataFrame, k: int = 5, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The k chunks that contain most query tokens, by substring."""
    lowered = corpus.withColumn("lowered", F.lower(F.coalesce(F.col("text"), F.lit(""))))
    worded = queries.select("query_id", tokens(F.col("query")).alias("tokens"))
    return topk_hits(lowered, worded, ContainmentScorer(), k, broadcast_bytes, terms_bytes(queries))
