from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import SparkSession, functions as F

from strata.operators.merge import dedup_latest, standardize, upsert
from strata.operators.sizing import measured_bytes
from strata.sources.silver import merge_silver, read_silver
from strata.sources.versions import ConcurrentWriteError, fresh_folder, publish, published
from strata.sources.writers import (
    SchemaMismatchError,
    append_batch,
    append_enforced,
    latest_snapshot,
    read_batches,
    schema_diff,
    with_audit,
    write_snapshot,
)

KEYED = "k string, v int"


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_standardize_types_and_unreadable_values(spark):
    df = spark.createDataFrame(
        [("12", "4.5", "2026-08-01T10Z"), ("x", "y", "01/08/2026"), (None, None, None)],
        "views string, rating string, published_timestamp string",
    )
    assert rows(standardize(df)) == rows(
        spark.createDataFrame(
            [(12, 4.5, datetime(2026, 8, 1, 10)), (None, None, None), (None, None, None)],
            "views bigint, rating double, published_timestamp timestamp",
        )
    )


def test_dedup_takes_the_latest_then_the_greatest_row(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 1), ("a", 2, 3), ("b", None, 9), ("b", None, 8), (None, 1, 1), (None, 2, 0)],
        "k string, _ingested_at int, v int",
    )
    assert rows(dedup_latest(df, "k")) == sorted([("a", 2, 3), ("b", None, 9), (None, 2, 0)], key=repr)


def test_dedup_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "a", 2)], "_ingested_at int, k string, v int")
    assert dedup_latest(df, "k").columns == df.columns


def test_hot_key_is_combined_before_the_shuffle(spark):
    hot = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("_ingested_at"),
    )
    df = dedup_latest(hot, "k")
    assert df.count() == 40_001
    assert df.where("k = 'hot'").first()["_ingested_at"] == 59_997
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")  # printed top down: partial below the exchange


@pytest.mark.parametrize("limit", [1 << 20, 0], ids=["broadcast", "shuffled"])
def test_upsert_replaces_inserts_and_keeps(spark, limit):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], KEYED)
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], KEYED)
    merged = upsert(target, source, "k", limit)
    assert rows(merged) == sorted([("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)], key=repr)


def test_upsert_into_and_from_empty(spark):
    full = spark.createDataFrame([("a", 1)], KEYED)
    empty = full.where("false")
    assert rows(upsert(empty, full, "k")) == [("a", 1)]
    assert rows(upsert(full, empty, "k")) == [("a", 1)]


def test_merge_twice_is_merge_once(spark, tmp_path):
    root = str(tmp_path / "silver")
    assert read_silver(spark, root) is None
    merge_silver(spark.createDataFrame([("a", 1), ("b", 2)], KEYED), root, "k")
    change = spark.createDataFrame([("b", 20), ("c", 30)], KEYED)
    for _ in range(2):
        merge_silver(change, root, "k")
        assert rows(read_silver(spark, root)) == [("a", 1), ("b", 20), ("c", 30)]


def folders(root) -> dict:
    return published(SparkSession.active(), root)[1]["folders"]


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "silver")
    merge_silver(spark.range(200).selectExpr("concat('k', id) AS k", "1 AS v"), root, "k", buckets=8)
    before = folders(root)
    merge_silver(spark.createDataFrame([("k5", 9)], KEYED), root, "k")
    after = folders(root)
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert read_silver(spark, root).where("v = 9").count() == 1 and read_silver(spark, root).count() == 200


def test_of_two_writers_the_second_fails(spark, tmp_path):
    root = str(tmp_path / "silver")
    publish(spark, root, 1, {"a": 1})
    with pytest.raises(ConcurrentWriteError):
        publish(spark, root, 1, {"a": 2})
    assert published(spark, root) == (1, {"a": 1})


def test_an_older_row_does_not_replace_a_later_one(spark):
    target = spark.createDataFrame([("a", 2, 20), ("b", 1, 10), (None, 1, 0)], "k string, n int, v int")
    source = spark.createDataFrame([("a", 1, 99), ("b", 1, 11), ("c", 1, 30), (None, 0, 1)], "k string, n int, v int")
    for limit in (0, 1 << 20):
        got = upsert(target, source, "k", limit, ("n",))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(
            map(str, [("a", 2, 20), ("b", 1, 11), (None, 1, 0), ("c", 1, 30), (None, 0, 1)])
        )


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    root = str(tmp_path / "table")
    assert write_snapshot(spark.createDataFrame([("a", 1)], KEYED), root) == 1
    spark.createDataFrame([("z", 9)], KEYED).write.parquet(f"{root}/{fresh_folder(2)}")
    assert rows(latest_snapshot(spark, root)) == [("a", 1)]
    (tmp_path / "table" / "_versions" / "2.json").write_text('{"folder')  # its writer was lost
    assert rows(latest_snapshot(spark, root)) == [("a", 1)]
    write_snapshot(spark.createDataFrame([("b", 2)], KEYED), root)
    assert rows(latest_snapshot(spark, root)) == [("b", 2)]


def test_append_counts_and_replays(spark, tmp_path):
    path = str(tmp_path / "bronze")
    batch = with_audit(spark.createDataFrame([("a", 1), ("b", 2)], KEYED))
    assert [append_batch(batch, path, n) for n in (1, 2, 2)] == [2, 2, 2]
    assert read_batches(spark, path).count() == 4
    later = read_batches(spark, path, after=1)
    assert later.count() == 2
    assert "PartitionFilters: [isnotnull(_batch_id" in later._jdf.queryExecution().executedPlan().toString()
    assert {r["_source"] for r in later.collect()} == {"kafka_ingestion_boundary"}


def test_enforced_append(spark, tmp_path):
    path = str(tmp_path / "gold")
    table = spark.createDataFrame([("AI", 2)], "category string, total_articles bigint")
    table.write.parquet(path)
    bad = [
        spark.createDataFrame(
            [("AI", "UNAUTHORIZED_STRING_VAL", 99999)],
            "category string, unauthorized_extra_column string, total_articles bigint",
        ),
        table.drop("total_articles"),
        table.withColumn("total_articles", F.col("total_articles").cast("int")),
    ]
    for df in bad:
        with pytest.raises(SchemaMismatchError):
            append_enforced(df, path)
        assert rows(spark.read.parquet(path)) == [("AI", 2)]
    append_enforced(table.select("total_articles", "category"), path)
    assert rows(spark.read.parquet(path)) == [("AI", 2), ("AI", 2)]


def test_schema_diff_names_each_problem(spark):
    have = spark.createDataFrame([], "a int, b string, c double").schema
    new = spark.createDataFrame([], "a bigint, c double, d string").schema
    assert schema_diff(have, new) == [("a", "type bigint instead of int"), ("b", "missing column"), ("d", "extra column")]
    assert schema_diff(have, have) == []


def test_measured_bytes_grow_with_the_values(spark):
    small = spark.createDataFrame([("a", [1.0])], "t string, e array<double>")
    large = spark.createDataFrame([("a" * 1000, [1.0] * 1000)], "t string, e array<double>")
    assert measured_bytes(large) - measured_bytes(small) == 999 + 999 * 8
    assert measured_bytes(small.where("false")) == 0
