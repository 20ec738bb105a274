"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.llm.common import PREFIX, staged

PART, PLACE, RANK = f"{PREFIX}part", f"{PREFIX}place", f"{PREFIX}rank"


def _counted(group: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = batch.column(group).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            begin = starts.copy()
            if batch.column(group)[0].as_py() == last and seen:
                begin[0] = -seen
            place = np.arange(n) - np.repeat(begin, np.diff(np.append(starts, n)))
            last, seen = batch.column(group)[n - 1].as_py(), int(place[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(n, part, dtype=np.int64)), pa.array(place.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, PART, PLACE])

    return rows


def numbered(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``_strata_rank``: the row's place from 0 in its ``group``, by ``order``.

    The rows are range-partitioned by group and order, so a group of any size is split over
    partitions; rows alike in all of ``order`` are split too if its last key tells them apart.
    Each partition counts its own rows. Only a partition's first group can have begun before
    it, so at most one offset a partition is broadcast.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema.fields, T.StructField(PART, T.LongType()), T.StructField(PLACE, T.LongType())])
    placed = staged(
        df.repartitionByRange(width, *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_counted(df.columns.index(group)), schema),
        name,
    )
    before = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(group, PART)
        .agg(F.count("*").alias("n"))
        .select(F.col(group).alias(f"{PREFIX}group"), F.col(PART).alias(f"{PREFIX}at"), F.sum("n").over(before).alias(f"{PREFIX}before"))
        .where(F.col(f"{PREFIX}before") > 0)
    )
    same = placed[group].eqNullSafe(offsets[f"{PREFIX}group"]) & (placed[PART] == offsets[f"{PREFIX}at"])
    found = placed.join(F.broadcast(offsets), same, "left")
    rank = F.col(PLACE) + F.coalesce(F.col(f"{PREFIX}before"), F.lit(0))
    return found.select(*df.columns, rank.alias(RANK))
