"""Buckets that grow with a table, tasks of bounded size, and writers that meet."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.sources import buckets, silver
from strata.sources.buckets import address, split, wanted
from strata.sources.silver import merge_silver, read_silver
from strata.sources.versions import ConcurrentWriteError, publish, published


def test_a_new_bucket_takes_rows_from_one_other_bucket(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS k")
    at = {n: {r["k"]: r["b"] for r in keys.select("k", address("k", n).alias("b")).collect()} for n in range(1, 13)}
    for n in range(1, 12):
        assert set(at[n].values()) == set(range(n))
        moved = {(at[n][k], at[n + 1][k]) for k in at[n] if at[n][k] != at[n + 1][k]}
        assert moved == {(source, n) for source in split(n, n + 1)}
    assert split(3, 12) == {1: [3, 5, 7, 9, 11], 0: [4, 8], 2: [6, 10]}
    assert all(at[12][k] in (at[3][k], *split(3, 12)[at[3][k]]) for k in at[3])
    assert wanted(4, 100, 30) == 4 and wanted(4, 121, 30) == 5


def sizes(root) -> list[int]:
    return [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]


def test_the_largest_task_stays_bounded_while_the_table_grows(spark, tmp_path):
    root, bound = str(tmp_path / "silver"), 40_000
    rows = spark.range(32_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(4)
    n_buckets, largest, total = [], [], 0
    for step in (1, 2, 4, 8):  # the table grows eightfold
        part = str(tmp_path / f"part{step}")
        rows.where(F.col("k").between(total, step * 4000 - 1)).write.parquet(part)
        total = step * 4000
        merge_silver(spark.read.parquet(part), root, "k", buckets=2, bucket_bytes=bound, task_bytes=4 * bound)
        manifest = published(spark, root)[1]
        n_buckets.append(manifest["buckets"])
        newest = os.path.join(root, max(manifest["folders"].values()))
        largest.append(max(sizes(newest)))
        assert read_silver(spark, root).count() == total
        assert sum(manifest["bytes"].values()) / manifest["buckets"] <= 2 * bound
    assert n_buckets == sorted(n_buckets) and n_buckets[-1] >= 6 * n_buckets[0]
    assert max(largest) <= 2 * bound
    assert read_silver(spark, root).agg(F.count_distinct("k")).first()[0] == total


@pytest.mark.parametrize("mapped", [256, 0])
def test_a_bucket_that_is_not_split_is_written_by_several_tasks(spark, tmp_path, monkeypatch, mapped):
    monkeypatch.setattr(buckets, "MAPPED", mapped)
    root = str(tmp_path / "silver")
    rows = spark.range(8000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.write.parquet(str(tmp_path / "rows"))
    merge_silver(spark.read.parquet(str(tmp_path / "rows")), root, "k", buckets=1, task_bytes=200_000)
    found = sizes(root)
    assert published(spark, root)[1]["buckets"] == 1 and len(found) >= 4 and max(found) < 2 * min(found)
    assert read_silver(spark, root).count() == 8000


def keyed(spark, tmp_path, name, values):
    spark.createDataFrame(values, "k string, v long").write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


@pytest.mark.parametrize("same_bucket", [False, True])
def test_both_of_two_writers_land(spark, tmp_path, monkeypatch, same_bucket):
    root = str(tmp_path / "silver")
    merge_silver(keyed(spark, tmp_path, "start", [(f"k{i}", 0) for i in range(60)]), root, "k", buckets=8)
    at = {r["k"]: r["b"] for r in read_silver(spark, root).select("k", address("k", 8).alias("b")).collect()}
    other = next(k for k in at if k != "k1" and (at[k] == at["k1"]) == same_bucket)
    mine, theirs = keyed(spark, tmp_path, "mine", [("k1", 1)]), keyed(spark, tmp_path, "theirs", [(other, 2)])
    merges, raced = [], []

    def race(*args):
        if not raced:
            raced.append(True)
            merge_silver(theirs, root, "k")
        publish(*args)

    merged = silver._merged_buckets
    monkeypatch.setattr(silver, "publish", race)
    monkeypatch.setattr(silver, "_merged_buckets", lambda *a: merges.append(1) or merged(*a))
    merge_silver(mine, root, "k")
    found = {r["k"]: r["v"] for r in read_silver(spark, root).collect()}
    assert len(found) == 60 and found["k1"] == 1 and found[other] == 2
    assert len(merges) == (3 if same_bucket else 2)  # merged again only where both wrote one bucket


def test_a_writer_that_always_loses_gives_up(spark, tmp_path, monkeypatch):
    def lost(*_):
        raise ConcurrentWriteError("taken")

    monkeypatch.setattr(silver, "publish", lost)
    with pytest.raises(ConcurrentWriteError):
        merge_silver(keyed(spark, tmp_path, "rows", [("a", 1)]), str(tmp_path / "silver"), "k")
