"""Exact line deduplication over a whole corpus (operator 9).

Each line of at least ``min_chars`` characters becomes one row (128-bit hash,
document, position). The rows are range-partitioned and sorted by hash, then by
document from the largest, then by position, so one streaming pass sees the
occurrence to keep first and needs to remember a few rows only. The ranges
are over hash *and* document: a line that stands in a third of all documents is
split over many partitions. A group that touches the edge of its partition
can't be judged there; its rows leave undecided and are judged by counts per
hash (two hashes a partition at most). What comes back is a compressed bitmap
of kept positions per document, never text.

Defined cases: a null text counts as one empty line and stays null; an empty
text is one empty line; rows without id keep all lines and count for none; rows
of one id are one document, however often it is repeated; an empty table gives
no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.common import PREFIX, long_id, staged, text_bytes

LINES = "h1 long, h2 long, doc_id long, text_crc long, pos int"


def _line_rows(min_chars: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            digests, counts, crcs, positions = [], [], [], []
            for text in text_bytes(batch.column(1)):
                before = len(digests)
                for pos, line in enumerate(text.split(b"\n")):
                    key = line.strip().lower()  # of bytes: ASCII blanks and letters alone
                    size = len(key)
                    if size < min_chars or (
                        size < 4 * min_chars and not key.isascii() and len(key.decode(errors="replace")) < min_chars
                    ):
                        continue
                    digests.append(digest(key))
                    positions.append(pos)
                counts.append(len(digests) - before)
                crcs.append(zlib.crc32(text))
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0].copy()),
                    pa.array(halves[:, 1].copy()),
                    pa.array(np.repeat(docs, counts), pa.int64()),
                    pa.array(np.repeat(np.array(crcs, dtype=np.int64), counts)),
                    pa.array(np.array(positions, dtype=np.int32)),
                ],
                names=["h1", "h2", "doc_id", "text_crc", "pos"],
            )

    return rows


def _judge(min_docs: int):
    """Stream sorted lines: the dropped ones, and those of the partition's edge groups undecided."""

    def out(rows: np.ndarray, edge: bool) -> pa.RecordBatch:
        arrays = [pa.array(rows[:, i].copy()) for i in range(4)]
        arrays += [pa.array(rows[:, 4].astype(np.int32)), pa.array(np.full(len(rows), edge))]
        return pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "doc_id", "text_crc", "pos", "edge"])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None  # the hash of the partition's first group
        held = np.empty((0, 5), dtype=np.int64)  # rows of a group with too few documents so far
        sure: tuple | None = None  # (hash, kept document, its first documents) of a group that has enough
        for batch in batches:
            if batch.num_rows == 0:
                continue
            new = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            if first is None:
                first = tuple(new[0, :2])
            rows = np.concatenate([held, new])
            held = rows[:0]
            differs = np.any(rows[1:, :2] != rows[:-1, :2], axis=1)
            starts = np.concatenate([[0], np.flatnonzero(differs) + 1])
            sizes = np.diff(np.append(starts, len(rows)))
            new_doc = np.concatenate([[True], differs | (rows[1:, 2] != rows[:-1, 2])])
            n_docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            kept = rows[starts, 2].copy()
            decided = n_docs >= min_docs
            head = tuple(rows[0, :2])
            if head == first:
                yield out(rows[: sizes[0]], True)
                decided[0] = False
            elif sure is not None and head == sure[0]:
                decided[0], kept[0] = True, sure[1]
            elif sure is not None:
                sure = None
            last = len(starts) - 1
            tail = tuple(rows[starts[last], :2])
            if tail == first:
                sure = None
            elif sure is None or tail != sure[0]:
                if decided[last]:
                    group = rows[starts[last] :]
                    sure = (tail, kept[last], group[np.flatnonzero(new_doc[starts[last] :])[:min_docs]])
                else:
                    sure, held = None, rows[starts[last] :]
            drop = np.repeat(decided, sizes) & (rows[:, 2] != np.repeat(kept, sizes))
            if drop.any():
                yield out(rows[drop], False)
        if len(held):
            yield out(held, True)
        if sure is not None:
            seen = sure[2].copy()
            seen[:, 4] = -1  # they only count; their lines are judged already
            yield out(seen, True)

    return judged


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped: pd.Series) -> pd.Series:
    def pack(positions) -> bytes:
        positions = np.asarray(positions, dtype=np.int64)
        keep = np.ones(int(positions.max()) // 8 * 8 + 8, dtype=bool)
        keep[positions] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return dropped.map(pack)


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """(doc_id, text_crc, n_dropped, bitmap) of each document that loses a line.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys
    of at least ``min_chars`` characters found in at least ``min_docs`` documents
    stay only in the largest document that holds them. ``text_crc`` (CRC-32 of the
    text) tells rows of one id with different texts apart. The bitmap is zlib of
    packed bits, 1 for a kept line; lines beyond it are kept.
    """
    given = docs.select(long_id(docs, id_col).alias("doc_id"), docs[text_col].alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    order = ["h1", "h2", F.desc("doc_id"), "text_crc", "pos"]
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    judged = staged(
        given.mapInArrow(_line_rows(min_chars), LINES)
        .repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_judge(min_docs), f"{LINES}, edge boolean"),
        "line-dedup",
    )
    undecided = judged.where("edge")
    found = (  # at most two hashes a partition
        undecided.groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("kept"), F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
    )
    late = undecided.where("pos >= 0").join(F.broadcast(found), ["h1", "h2"]).where("doc_id <> kept")
    columns = ["doc_id", "text_crc", "pos"]
    dropped = judged.where("NOT edge").select(columns).unionByName(late.select(columns))
    return (
        dropped.groupBy("doc_id", "text_crc")
        .agg(F.collect_set("pos").alias("dropped"))
        .select("doc_id", "text_crc", F.size("dropped").cast("long").alias("n_dropped"), _bitmap("dropped").alias("bitmap"))
    )


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("n_lines", T.LongType()).add("n_dropped", T.LongType()))
def _apply(text: pd.Series, bitmap: pd.Series) -> pd.DataFrame:
    kept, n_lines, n_dropped = [], [], []
    for value, bits in zip(text, bitmap, strict=True):
        if value is None or bits is None:
            kept.append(value)
            n_lines.append(1 if value is None else value.count("\n") + 1)
            n_dropped.append(0)
            continue
        lines = value.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8))[: len(lines)]
        gone = set(np.flatnonzero(keep == 0).tolist())
        kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
        n_lines.append(len(lines))
        n_dropped.append(len(gone))
    return pd.DataFrame({"text": kept, "n_lines": n_lines, "n_dropped": n_dropped})


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text cut, with struct ``_strata_lines`` (text, n_lines, n_dropped)."""
    marks = bitmaps.select(
        F.col("doc_id").alias(f"{PREFIX}id"), F.col("text_crc").alias(f"{PREFIX}crc"), F.col("bitmap").alias(f"{PREFIX}bitmap")
    )
    same = (docs[id_col].cast("long") == marks[f"{PREFIX}id"]) & (F.crc32(docs[text_col]) == marks[f"{PREFIX}crc"])
    cut = docs.join(marks, same, "left").withColumn(f"{PREFIX}lines", _apply(docs[text_col], F.col(f"{PREFIX}bitmap")))
    return cut.withColumn(text_col, F.col(f"{PREFIX}lines.text")).drop(f"{PREFIX}id", f"{PREFIX}crc", f"{PREFIX}bitmap")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """``docs`` with repeated lines removed, every other column as it is."""
    bitmaps = line_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    return apply_bitmaps(docs, bitmaps, id_col, text_col).drop(f"{PREFIX}lines")
