"""Importance resampling towards a target text (operator 12).

Features are runs of one to ``longest_run`` words, hashed into buckets by CRC-32. A
bucket's gain is the logarithm of how much more frequent it is in the target than in
the documents; a document's weight is the sum of its features' gains, and the documents
with the highest weights plus Gumbel noise are drawn, without replacement.

The checksums come from a position table. CRC-32 is linear over XOR: a byte contributes
a number that depends only on the byte and on its distance from the feature's end, and
the length adds a constant. So the contributions of all bytes of a batch are looked up
at once and folded by ``bitwise_xor.reduceat`` over the features' spans. Spans longer
than ``span`` bytes are cut into blocks from their end, and the folded blocks are
combined from the left, each step moving the sum so far past ``span`` bytes.

Counts combine within a task, so that a task sends one row for each bucket and a frequent
word is no hot key; the gains, ``buckets`` numbers, are the only thing the driver sees.
The draw ranks rows in a range-partitioned order, so it needs no single task either.

Defined cases: a null or empty text has no feature and the weight 0; a row without id
gets no score and is never drawn; rows of one id are scored and drawn each; equal scores
are drawn by the smaller id, equal ids in the order of the input; very long texts and
words are folded like others (memory: some 20 times the larger of ``batch_bytes`` and
the longest text); an empty table, or an empty target, gives the same columns and gains
by the same formula; further columns are kept.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.common import PREFIX, long_id, staged, worker_cache
from strata.llm.numbering import RANK, numbered


@dataclass(frozen=True)
class ResampleSettings:
    longest_run: int = 1  # words of a feature
    buckets: int = 10_000
    span: int = 256  # bytes of a block of the position table
    batch_bytes: int = 1 << 20
    least_words: int = 20  # of a document that may be drawn
    percent: int = 10
    seed: int = 2024


class PositionTable:
    """CRC-32 of many byte spans at once."""

    def __init__(self, span: int):
        self.span = span
        zero = zlib.crc32(b"\0")
        single = np.array([zlib.crc32(bytes([b])) ^ zero for b in range(256)], dtype=np.uint32)
        rows = [single]
        for _ in range(span - 1):
            rows.append((rows[-1] >> 8) ^ single[rows[-1] & 255])
        self.table = np.concatenate(rows)  # at distance * 256 + byte
        moved = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        for k in range(4):
            for _ in range(span):
                moved[k] = (moved[k] >> 8) ^ single[moved[k] & 255]
        self.moved = moved
        self.constants = np.array([zlib.crc32(bytes(n)) for n in range(span + 1)], dtype=np.uint32)

    def _past_span(self, sums: np.ndarray) -> np.ndarray:
        """Sums once ``span`` bytes have followed."""
        parts = [table[(sums >> np.uint32(8 * k)) & np.uint32(255)] for k, table in enumerate(self.moved)]
        return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]

    def crc32(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Checksums of spans of ``sizes`` (at least 1) bytes that lie side by side in ``data``."""
        if not len(sizes):
            return np.empty(0, dtype=np.uint32)
        stops = np.cumsum(sizes)
        distance = np.repeat(stops.astype(np.int32) - 1, sizes) - np.arange(len(data), dtype=np.int32)
        wide = sizes > self.span
        if not wide.any():
            at = distance * np.int32(256) + data
            return np.bitwise_xor.reduceat(self.table[at], stops - sizes) ^ self.constants[sizes]
        within = distance % self.span
        head = within == self.span - 1  # of each block; a shorter first block begins with its span
        head[stops - sizes] = True
        blocks = np.bitwise_xor.reduceat(self.table[within * np.int32(256) + data], np.flatnonzero(head))
        n_blocks = -(-sizes // self.span)
        first = np.cumsum(n_blocks) - n_blocks
        sums = blocks[first]
        left = np.flatnonzero(wide)
        step = 1
        while len(left):
            sums[left] = self._past_span(sums[left]) ^ blocks[first[left] + step]
            step += 1
            left = left[n_blocks[left] > step]
        constants = self.constants[np.minimum(sizes, self.span)].copy()
        for i in np.flatnonzero(wide):
            constants[i] = self._zeros(int(sizes[i]))
        return sums ^ constants

    @staticmethod
    def _zeros(n: int) -> int:
        """CRC-32 of n zero bytes."""
        sum_, block = 0, bytes(1 << 16)
        while n > 0:
            sum_ = zlib.crc32(block[: min(n, len(block))], sum_)
            n -= len(block)
        return sum_


class _Features:
    """Buckets of the features of texts, from their UTF-8 bytes."""

    def __init__(self, s: ResampleSettings):
        self.s = s
        self.crc = PositionTable(s.span)
        code = np.arange(256, dtype=np.uint8)
        self.lower = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint8)
        low = self.lower
        self.word = (low >= 128) | ((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 122))

    def __call__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket of each feature, its text's number, words of each text) of texts that lie side by side."""
        n_texts = len(starts)
        if not len(data):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.zeros(n_texts, dtype=np.int64)
        low = self.lower[data]
        word = self.word[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        given = starts < stops
        first[starts[given]] = word[starts[given]]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[stops[given] - 1] = word[stops[given] - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(starts, begin, side="right") - 1
        doc_words = np.bincount(doc, minlength=n_texts).astype(np.int64)
        found = [(self.crc.crc32(low[word], end - begin), doc)]
        if self.s.longest_run > 1 and len(begin):
            found += self._runs(low, begin, end, doc)
        buckets = np.concatenate([f[0] for f in found]).astype(np.int64) % self.s.buckets
        return buckets, np.concatenate([f[1] for f in found]), doc_words

    def _runs(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray, doc: np.ndarray):
        """Features of two words and more: the words joined by one space each."""
        sizes = end - begin
        spaced = np.full(int((sizes + 1).sum()), 32, dtype=np.uint8)
        at = np.cumsum(sizes + 1) - (sizes + 1)
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        spaced[np.repeat(at, sizes) + inner] = low[np.repeat(begin, sizes) + inner]
        for n in range(2, self.s.longest_run + 1):
            whole = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1])
            length = at[whole + n - 1] + sizes[whole + n - 1] - at[whole]
            inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            yield self.crc.crc32(spaced[np.repeat(at[whole], length) + inner], length), doc[whole]


def _slices(texts: pa.Array, batch_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``batch_bytes``: (first row, end row, bytes, starts, stops)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(edges, edges[a] + batch_bytes, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[edges[a] : edges[b]], edges[a:b] - edges[a], edges[a + 1 : b + 1] - edges[a]
        a = b


def _features(s: ResampleSettings) -> _Features:
    return worker_cache(("resample", s), lambda: _Features(s))


def _count(s: ResampleSettings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _features(s)
        counts = np.zeros(s.buckets, dtype=np.int64)
        for batch in batches:
            for _, _, data, starts, stops in _slices(batch.column(0), s.batch_bytes):
                counts += np.bincount(features(data, starts, stops)[0], minlength=s.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    return rows


def bucket_counts(texts: DataFrame, text_col: str = "text", settings: ResampleSettings = ResampleSettings()) -> DataFrame:
    """(bucket, n): how many features of all texts each bucket holds."""
    counted = texts.select(texts[text_col]).mapInArrow(_count(settings), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed source share) of each bucket."""
    all_source, all_target = float(sum(source.values())), float(sum(target.values()))

    def gain(b: int) -> int:
        share = (target.get(b, 0) + 1.0) * (all_source + buckets) / ((source.get(b, 0) + 1.0) * (all_target + buckets))
        return math.floor(1000 * math.log(share))

    return np.array([gain(b) for b in range(buckets)], dtype=np.int64)


def learn_gains(
    docs: DataFrame,
    target: DataFrame,
    text_col: str = "text",
    target_col: str = "text",
    settings: ResampleSettings = ResampleSettings(),
) -> np.ndarray:
    """Gains from all texts of both tables; at most ``buckets`` rows of each reach the driver."""
    counts = [
        {r["bucket"]: r["n"] for r in bucket_counts(df, column, settings).collect()}
        for df, column in ((docs, text_col), (target, target_col))
    ]
    return gains(*counts, settings.buckets)


def _weigh(s: ResampleSettings, gain: np.ndarray, text: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _features(s)
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            n_features, n_words, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for a, b, data, starts, stops in _slices(batch.column(text), s.batch_bytes):
                bucket, doc, words = features(data, starts, stops)
                n_features[a:b] = np.bincount(doc, minlength=b - a)
                n_words[a:b] = words
                weight[a:b] = np.bincount(doc, weights=gain[bucket], minlength=b - a)  # exact: far below 2 ** 53
            found = [pa.array(n_features), pa.array(weight), pa.array(n_words), pa.array(place + np.arange(n))]
            place += n
            kept = [c for i, c in enumerate(batch.columns) if i != text]
            names = [name for i, name in enumerate(batch.schema.names) if i != text]
            yield pa.RecordBatch.from_arrays(
                kept + found, names=[*names, *(f"{PREFIX}{x}" for x in ("n_features", "weight", "n_words", "row"))]
            )

    return rows


def weighed(
    docs: DataFrame, gain: np.ndarray, text_col: str = "text", settings: ResampleSettings = ResampleSettings()
) -> DataFrame:
    """``docs`` without the text, with ``_strata_n_features``, ``_weight``, ``_n_words`` and ``_row`` (place in the input)."""
    added = [T.StructField(f"{PREFIX}{name}", T.LongType()) for name in ("n_features", "weight", "n_words", "row")]
    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col] + added)
    return docs.mapInArrow(_weigh(settings, gain, docs.columns.index(text_col)), schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, rounded down, from the id and the seed."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    settings: ResampleSettings = ResampleSettings(),
) -> DataFrame:
    """``docs`` without the text, with ``_strata_n_features``, ``_strata_weight``, ``_strata_score`` and ``_strata_rank``.

    Ranks run from 1 over the drawn rows, the highest score first; the others have none. Of
    the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn.
    """
    s = settings
    gain = learn_gains(docs, target, text_col, target_col, s)
    scored = weighed(docs, gain, text_col, s)
    score, row, eligible = F.col(f"{PREFIX}score"), F.col(f"{PREFIX}row"), F.col(f"{PREFIX}eligible")
    scored = scored.withColumn(f"{PREFIX}score", F.col(f"{PREFIX}weight") + gumbel(long_id(scored, id_col), s.seed))
    scored = scored.withColumn(f"{PREFIX}eligible", score.isNotNull() & (F.col(f"{PREFIX}n_words") >= s.least_words))
    scored = staged(scored, "resample-scores")
    drawn = scored.where(eligible).count() * s.percent // 100
    order = [score.desc(), F.col(id_col).cast("long").asc(), row.asc()]
    placed = numbered(scored.withColumn(f"{PREFIX}left", (~eligible).cast("int")), f"{PREFIX}left", order, "resample-order")
    rank = F.when(eligible & (F.col(RANK) < drawn), F.col(RANK) + 1)
    dropped = [f"{PREFIX}{name}" for name in ("n_words", "row", "eligible", "left")]
    return placed.withColumn(RANK, rank).drop(*dropped)
