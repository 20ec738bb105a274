"""Bloom filters of bounded size: which rows a later join may need, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MOST_BITS = 1 << 28  # 32 MB: what a broadcast filter may take; beyond 17 million keys it only passes more


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x % np.uint64(bits), (x >> np.uint64(32)) * np.uint64(0x9E3779B1) % np.uint64(bits)


def bits_for(keys: int, most: int = MOST_BITS) -> int:
    """A power of two with 16 bits for each key (2 false hits in 100), between 128 KB and ``most``."""
    return min(most, max(1 << 20, 1 << (16 * keys - 1).bit_length())) if keys else 1 << 20


def _add(bits: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_places(batch.column(0).to_numpy(zero_copy_only=False), bits)))
            words, first = np.unique(at >> np.uint64(6), return_index=True)
            held = np.left_shift(np.uint64(1), at & np.uint64(63))
            held = np.bitwise_or.reduceat(held, first) if len(first) else held
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.astype(np.int64)), pa.array(held.view(np.int64))], names=["word", "held"]
            )

    return rows


def build(keys: DataFrame, bits: int) -> np.ndarray:
    """The filter of a one-column table of longs without nulls.

    Every task hashes its own keys; Spark joins their 64-bit words by OR, so the
    driver gets each word once, whatever the number of keys and tasks.
    """
    held = np.zeros(bits // 64, dtype=np.uint64)
    words = keys.mapInArrow(_add(bits), "word long, held long").groupBy("word").agg(F.bit_or("held").alias("held"))
    found = words.toArrow()
    held[found["word"].to_numpy()] = found["held"].to_numpy().view(np.uint64)
    return held.view(np.uint8)


def passes(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True where a key may be in the filter."""
    found = np.ones(len(keys), dtype=bool)
    for at in _places(keys, len(held) * 8):
        found &= ((held[(at >> np.uint64(3)).astype(np.int64)] >> (at % np.uint64(8)).astype(np.uint8)) & 1).astype(bool)
    return found


def keep_passing(df: DataFrame, keys: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Rows of ``df`` whose first column, a long, may be among ``keys``; a scan without a shuffle.

    ``keys`` is counted first, so it should be a written table.
    """
    sent = df.sparkSession.sparkContext.broadcast(build(keys, bits_for(keys.count(), most_bits)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(known & passes(sent.value, ids.fill_null(0).to_numpy(zero_copy_only=False))))

    return df.mapInArrow(rows, df.schema)
