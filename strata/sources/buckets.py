"""Buckets that grow with a table: linear hashing, and tasks of bounded size inside a bucket.

A key's bucket is its hash modulo the power of two that covers ``n`` buckets, or modulo
half of it where that bucket does not exist yet. So ``n`` can grow by one: the new bucket
takes rows from one other bucket, and no other row moves.
"""

from __future__ import annotations

import math
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAPPED = 256  # buckets whose layout is written into the plan; that of more is joined
PACKED = 4  # a row's bytes in memory over its bytes in Parquet, roughly


def address(key: str | Column, n: int) -> Column:
    """The bucket, of ``n``, of a key."""
    covering = 1 << (n - 1).bit_length()
    hashed = F.xxhash64(key)
    low = F.pmod(hashed, F.lit(covering))
    return F.when(low < n, low).otherwise(F.pmod(hashed, F.lit(max(1, covering // 2)))).cast("int")


def wanted(n: int, size: int, bucket_bytes: int) -> int:
    """How many buckets a table of ``size`` bytes should have; never fewer than it has."""
    return max(n, math.ceil(size / bucket_bytes))


def source(bucket: int, old: int) -> int:
    """The bucket, of ``old``, that a later bucket's rows lay in."""
    while bucket >= old:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def split(old: int, new: int) -> dict[int, list[int]]:
    """The buckets, of ``old``, that lose rows when there are ``new``, and the buckets that take them."""
    found: dict[int, list[int]] = {}
    for bucket in range(old, new):
        found.setdefault(source(bucket, old), []).append(bucket)
    return found


def shares(size: int, task_bytes: int) -> int:
    """Into how many tasks a bucket of ``size`` bytes in memory is cut."""
    return max(1, math.ceil(size / task_bytes))


def laid_out(rows: DataFrame, n: int, sizes: dict[int, int], task_bytes: int, key: str, within: str) -> DataFrame:
    """``rows`` with ``_bucket`` and ``_share``, each (bucket, share) in a partition of its own.

    ``sizes``: bytes in memory of each bucket that has rows. ``key`` picks the bucket,
    ``within`` the share, so one key with very many rows is cut too.
    """
    cut = {b: shares(size, task_bytes) for b, size in sorted(sizes.items())}
    firsts = list(accumulate(cut.values(), initial=0))
    total = firsts.pop()
    placed = rows.withColumn("_bucket", address(key, n))
    if not total:
        return placed.withColumn("_share", F.lit(0))
    if len(cut) <= MAPPED:
        found = F.create_map(*[x for b, first in zip(cut, firsts, strict=True) for x in (F.lit(b), F.struct(F.lit(first), F.lit(cut[b])))])
        layout = F.try_element_at(found, F.col("_bucket"))
        placed = placed.withColumn("_first", layout["col1"]).withColumn("_shares", layout["col2"])
    else:  # three numbers a bucket
        layout = pa.table({"_bucket": list(cut), "_first": firsts, "_shares": list(cut.values())})
        layout = layout.cast(pa.schema([(c, pa.int32()) for c in layout.column_names]))
        placed = placed.join(F.broadcast(rows.sparkSession.createDataFrame(layout)), "_bucket", "left")
    share = F.pmod(F.xxhash64(within, F.lit("share")), F.coalesce("_shares", F.lit(1))).cast("int")
    number = F.coalesce("_first", F.lit(0)) + F.col("_share")
    laid = placed.withColumn("_share", share).withColumn("_number", number)
    return laid.repartitionById(total, F.col("_number").cast("int")).drop("_first", "_shares", "_number")


def bytes_by_bucket(spark: SparkSession, folder: str) -> dict[int, int]:
    """Bytes on disk of each bucket in a folder that was written by ``_bucket``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    sizes: dict[int, int] = {}
    if not fs.exists(path):
        return sizes
    files = fs.listFiles(path, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().getParent().getName()
        if name.startswith("_bucket="):
            bucket = int(name.removeprefix("_bucket="))
            sizes[bucket] = sizes.get(bucket, 0) + status.getLen()
    return sizes
