"""What the text operators share: reading, staging, rows that keep their other columns."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.session import work_path

PREFIX = "_strata_"  # names of helper columns; input columns must not begin so
BLANK = " \t\n\x0b\x0c\r"  # the blanks of [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the folder that all executors share, and read again.

    Cuts the lineage: a lost executor costs no more than the files' rereading.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def long_id(df: DataFrame, name: str) -> Column:
    return df[name].cast("long")


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """A value made once per Python worker.

    The package travels to the workers by value, so a module global would be
    made anew in each task.
    """
    holder = sys.modules.setdefault("_strata_worker_cache", types.ModuleType("_strata_worker_cache"))
    values = holder.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def running_sum(values: Column, block: int = 256) -> Column:
    """Sums of the first 0, 1, ... n values of an array of longs (n + 1 sums).

    In blocks, as an array that grows by one is copied each time: the work is
    n * block, not n * n. ``values`` must be a column: it is read for each block.
    """

    def totals(part: Column, start: Column) -> Column:
        return F.aggregate(
            part,
            F.array(start),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
        )

    zero = F.lit(0).cast("long")

    def at(b: Column) -> Column:
        return F.slice(values, (b * block + 1).cast("int"), block)

    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / block).cast("int"))
    sums = totals(F.transform(blocks, lambda b: F.aggregate(at(b), zero, lambda acc, x: acc + x)), zero)
    each = F.zip_with(blocks, F.slice(sums, 1, F.size(blocks)), lambda b, s: F.slice(totals(at(b), s), 2, block))
    return F.concat(F.array(zero), F.flatten(each))
