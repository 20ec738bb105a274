"""The silver table: a Delta MERGE where Delta is installed, else buckets by a hash of the key.

A bucket has its own files and runs beside them: an ordered merge adds its rows as a run
and names the rows they replace (key and run), which readers leave out. Once the runs of
a bucket are larger than ``RATIO`` times its own files, they are put together. So many
small merges write in proportion to their rows, not each of them the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strata.operators.merge import upsert
from strata.operators.sizing import broadcast_if_small, row_bytes
from strata.session import delta_available
from strata.sources.buckets import PACKED, address, bytes_by_bucket, laid_out, split, wanted
from strata.sources.versions import ConcurrentWriteError, fresh_folder, publish, published

BUCKETS = 16  # of a new table; more once their bytes ask for it
RETRIES = 8  # of a merge whose version somebody else published first
RATIO = 2  # of the bytes of a bucket's runs to those of its own files
RUNS = 32  # of a bucket, at most
PARTS = ("folders", "bytes", "runs", "run_bytes", "gone")  # of a manifest, by bucket


def _table(spark: SparkSession, root: str, manifest: dict, buckets: Sequence[str], with_run: bool = False) -> DataFrame:
    """Some buckets of a version; on demand with the run (folder) of each row as ``_run``."""
    schema = T.StructType.fromJson(manifest["schema"])
    paths = [f"{root}/{f}/_bucket={b}" for b in buckets for f in (manifest["folders"][b], *manifest.get("runs", {}).get(b, ()))]
    names = [*schema.names, "_run"] if with_run else schema.names
    if not paths:
        return spark.createDataFrame([], schema).withColumn("_run", F.lit("")).select(*names)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/_bucket=", 1).alias("_run")
    rows = spark.read.schema(schema).parquet(*paths).select(*schema.names, run)
    gone = [f"{root}/{f}-gone/_bucket={b}" for b in buckets for f in manifest.get("gone", {}).get(b, ())]
    if gone:
        key = manifest["key"]
        replaced = spark.read.schema(T.StructType([schema[key], T.StructField("_run", T.StringType())])).parquet(*gone)
        rows = rows.join(broadcast_if_small(replaced, 64 << 20), [key, "_run"], "left_anti")
    return rows.select(*names)


def read_silver(spark: SparkSession, root: str) -> DataFrame | None:
    """The current table, or None before the first run."""
    if delta_available():
        from delta.tables import DeltaTable

        return spark.read.format("delta").load(root) if DeltaTable.isDeltaTable(spark, root) else None
    _, manifest = published(spark, root)
    return None if manifest is None else _table(spark, root, manifest, sorted(manifest["folders"]))


def merge_silver(
    staged: DataFrame,
    root: str,
    key: str,
    broadcast_bytes: int = 64 << 20,
    order_by: Sequence[str] = (),
    buckets: int = BUCKETS,
    bucket_bytes: int = 256 << 20,
    task_bytes: int = 256 << 20,
) -> None:
    """Merge staged rows (unique keys, a stored table) into the table; the first run creates it.

    Only the buckets that the rows fall into are touched; the others keep their
    files. ``order_by``: see ``upsert``; with it, rows are added as runs. ``buckets`` is the least
    number of them; once they hold more than ``bucket_bytes`` on disk on average they
    are split, one after the other. A task writes about ``task_bytes`` (in memory),
    a bucket of more is written by several.

    A writer that finds its version taken keeps its files where the other one wrote
    other buckets, and merges again where the other one wrote one of its own.
    """
    spark = staged.sparkSession
    if delta_available():
        _merge_delta(staged, root, key, order_by)
        return
    done: tuple[dict, dict] | None = None  # the manifest merged with, and what became of it
    for attempt in range(RETRIES):
        version, manifest = published(spark, root)
        if done is None or not _untouched(done, manifest):
            done = manifest or {}, _merged_buckets(staged, root, key, manifest, version + 1, broadcast_bytes, order_by, buckets, bucket_bytes, task_bytes)
        try:
            publish(spark, root, version + 1, _with_buckets(manifest, done[1]))
            return
        except ConcurrentWriteError:
            if attempt == RETRIES - 1:
                raise


def _untouched(done: tuple[dict, dict], now: dict | None) -> bool:
    """Whether the buckets that were merged are still those that were read."""
    before, change = done
    if now is None:
        return not before
    if not before or now["buckets"] != before["buckets"]:
        return False
    touched = {*change["read"], *change["written"]}
    return all(now.get(p, {}).get(b) == before.get(p, {}).get(b) for p in ("folders", "runs", "gone") for b in touched)


def _with_buckets(manifest: dict | None, change: dict) -> dict:
    """The manifest with the merged buckets in the place of those that were read."""
    whole = change["read"] - change["added"]
    kept = {part: {b: v for b, v in (manifest or {}).get(part, {}).items() if b not in whole} for part in PARTS}
    for b, size in change["written"].items():
        if b in change["added"]:
            kept["runs"][b] = [*kept["runs"].get(b, ()), change["folder"]]
            kept["run_bytes"][b] = kept["run_bytes"].get(b, 0) + size
            kept["bytes"][b] += size
        else:
            kept["folders"][b], kept["bytes"][b] = change["folder"], size
    for b in change["gone"]:
        kept["gone"][b] = [*kept["gone"].get(b, ()), change["folder"]]
    return {"buckets": change["buckets"], "schema": change["schema"], "key": change["key"], **kept}


def _merged_buckets(
    staged, root, key, manifest, version, broadcast_bytes, order_by, buckets, bucket_bytes, task_bytes
) -> dict:
    """Write the buckets that the rows fall into, and those that are split; what was read and written."""
    spark = staged.sparkSession
    old_n = manifest["buckets"] if manifest else max(1, buckets)
    held = {int(b): size for b, size in (manifest or {}).get("bytes", {}).items()}
    sized = staged.select(address(key, old_n).alias("b"), row_bytes(staged).alias("n")).groupBy("b").agg(F.sum("n").alias("n"))
    incoming = {r["b"]: r["n"] for r in sized.collect()}  # at most a row a bucket
    n = wanted(old_n, sum(held.values()) + sum(incoming.values()) // PACKED, bucket_bytes)
    moved = split(old_n, n)
    read = {*incoming, *(moved if manifest else ())}
    added = {b for b in read if manifest and order_by and b not in moved and _takes_run(manifest, str(b), incoming[b] // PACKED)}
    folder = fresh_folder(version)
    merged = staged
    if manifest:
        to_run = address(key, old_n).isin(sorted(added))
        there = _table(spark, root, manifest, sorted(str(b) for b in read - added if str(b) in manifest["folders"]))
        merged = staged.where(to_run)
        if added:
            merged = _run(merged, root, folder, key, manifest, added, old_n, broadcast_bytes, order_by)
        if read - added:
            merged = merged.unionByName(upsert(there, staged.where(~to_run), key, broadcast_bytes, order_by))
    sizes: dict[int, int] = {}
    for b in read:
        parts = [b, *moved.get(b, ())]
        there_bytes = 0 if b in added else held.get(b, 0) * PACKED
        sizes |= dict.fromkeys(parts, (there_bytes + incoming.get(b, 0)) // len(parts) + 1)
    if read:
        written = laid_out(merged, n, sizes, task_bytes, key, key).drop("_share")
        written.write.partitionBy("_bucket").option("compression", "zstd").parquet(f"{root}/{folder}")
    return {
        "buckets": n,
        "schema": manifest["schema"] if manifest else staged.schema.jsonValue(),
        "key": key,
        "folder": folder,
        "read": {str(b) for b in read},
        "added": {str(b) for b in added},
        "written": {str(b): size for b, size in bytes_by_bucket(spark, f"{root}/{folder}").items()},
        "gone": [str(b) for b in sorted(bytes_by_bucket(spark, f"{root}/{folder}-gone"))],
    }


def _takes_run(manifest: dict, bucket: str, size: int) -> bool:
    """Whether rows of so many bytes are added to a bucket as a run."""
    if bucket not in manifest["folders"] or manifest.get("key") is None:
        return False
    runs = manifest["run_bytes"].get(bucket, 0)
    return len(manifest["runs"].get(bucket, ())) < RUNS and runs + size <= RATIO * (manifest["bytes"][bucket] - runs)


def _run(staged, root, folder, key, manifest, buckets, n, broadcast_bytes, order_by) -> DataFrame:
    """The staged rows that no later row of the table beats; the rows they replace are named in ``gone``."""
    known = staged.where(F.col(key).isNotNull()).select(key, F.struct(*order_by).alias("_order"))
    there = _table(staged.sparkSession, root, manifest, sorted(map(str, buckets)), with_run=True)
    there = there.select(key, "_run", F.struct(*order_by).alias("_there"))
    met = there.join(broadcast_if_small(known, broadcast_bytes), key)
    later = F.col("_there") > F.col("_order")
    replaced = met.where(~later).select(key, "_run", address(key, n).alias("_bucket"))
    replaced.repartition("_bucket").write.partitionBy("_bucket").option("compression", "zstd").parquet(f"{root}/{folder}-gone")
    return staged.join(broadcast_if_small(met.where(later).select(key), broadcast_bytes), key, "left_anti").select(*staged.columns)


def _merge_delta(staged: DataFrame, root: str, key: str, order_by: Sequence[str]) -> None:
    from delta.tables import DeltaTable

    spark = staged.sparkSession
    if not DeltaTable.isDeltaTable(spark, root):
        staged.write.format("delta").mode("overwrite").save(root)
        return

    def order(side: str) -> str:
        return f"struct({', '.join(f'{side}.{c}' for c in order_by)})"

    newer = f"{order('source')} >= {order('target')}" if order_by else None
    (
        DeltaTable.forPath(spark, root)
        .alias("target")
        .merge(staged.alias("source"), f"target.{key} = source.{key}")
        .whenMatchedUpdateAll(condition=newer)
        .whenNotMatchedInsertAll()
        .execute()
    )
