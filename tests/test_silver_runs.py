"""Merges write in proportion to their rows."""

from __future__ import annotations

import os

import pytest

from strata.operators.merge import dedup_latest, latest_rows
from strata.sources import silver
from strata.sources.silver import merge_silver, read_silver
from strata.sources.versions import published


def stored(spark, path, rows):
    spark.createDataFrame(rows, "k string, n int, v string").write.parquet(str(path))
    return spark.read.parquet(str(path))


def written(root) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def values(spark, root) -> list[tuple]:
    return sorted((str(r["k"]), r["n"], r["v"]) for r in read_silver(spark, root).collect())


def test_a_small_merge_writes_its_own_rows(spark, tmp_path):
    root = str(tmp_path / "silver")
    merge_silver(stored(spark, tmp_path / "a", [(f"k{i}", 1, os.urandom(2000).hex()) for i in range(400)]), root, "k", order_by=("n",), buckets=2)
    before = written(root)
    merge_silver(stored(spark, tmp_path / "b", [(f"k{i}", 2, "new") for i in range(0, 20)]), root, "k", order_by=("n",))
    assert written(root) - before < before / 4
    got = {k: (n, v) for k, n, v in values(spark, root)}
    assert len(got) == 400 and all(got[f"k{i}"] == (2, "new") for i in range(20)) and got["k20"][0] == 1


@pytest.mark.parametrize("ratio", [0, 2, 1000])
def test_runs_give_what_whole_buckets_give(spark, tmp_path, monkeypatch, ratio):
    monkeypatch.setattr(silver, "RATIO", ratio)
    root = str(tmp_path / "silver")
    batches = [
        [("a", 1, "a1"), ("b", 5, "b5"), (None, 1, "none")],
        [("a", 2, "a2"), ("b", 4, "late"), ("c", 1, "c1"), (None, 1, "again")],
        [("a", 2, "same"), ("c", 0, "old"), ("d", 1, "d1")],
        [("a", 1, "a1"), ("b", 6, "b6")],
        [("d", 2, "d2"), ("a", 3, "a3")],
    ]
    for i, rows in enumerate(batches):
        merge_silver(stored(spark, tmp_path / f"b{i}", rows), root, "k", order_by=("n",), buckets=2)
    assert values(spark, root) == [
        ("None", 1, "again"), ("None", 1, "none"), ("a", 3, "a3"), ("b", 6, "b6"), ("c", 1, "c1"), ("d", 2, "d2"),
    ]
    if ratio != 2:
        assert bool(published(spark, root)[1]["runs"]) == (ratio == 1000)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_only_repeated_keys_are_shuffled(spark, tmp_path, limit):
    df = stored(spark, tmp_path / "r", [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "p"), (None, 2, "q")])
    for rows in (df, df.where("k = 'b'"), df.where("n = 2"), df.where("false")):
        got = latest_rows(rows, "k", ("n",), limit)
        assert got.columns == rows.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, dedup_latest(rows, "k", ("n",)).collect()))
    single = latest_rows(df.where("n = 2"), "k", ("n",), limit)
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
