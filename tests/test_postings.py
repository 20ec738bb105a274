"""BM25 by posting lists, and chunks looked up by their keys."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.config import Settings
from strata.operators import postings as P
from strata.operators.bm25 import bm25_topk
from strata.operators.fusion import looked_up
from strata.operators.postings import _number, bound_entries, posting_entries
from strata.plans import retrieval
from strata.plans.retrieval import build_index, open_index, refresh_index, search_bm25
from tests.helpers import CHUNK_SCHEMA, bm25, chunk_rows, top


def texts_of(n, seed=1):
    r = random.Random(seed)
    common, rare = ["the", "of", "river", "stone"], [f"rare{i}" for i in range(n // 3)]
    made = {}
    for i in range(n):
        words = r.choices(common, k=r.randrange(0, 9)) + r.choices(rare, k=r.randrange(0, 4))
        r.shuffle(words)
        made[f"D{i % (n // 4):04}_C{i // (n // 4)}"] = " ".join(words)
    return made


def indexed(spark, path, texts, **more):
    return build_index(spark.createDataFrame(chunk_rows(texts), CHUNK_SCHEMA), str(path), **more)


QUERIES = {1: "the rare1 of rare2", 2: "river river stone", 3: "unknown words only", 4: "", 5: "rare3"}


def asked(spark, queries):
    return spark.createDataFrame(list(queries.items()), "query_id int, query string")


def found(hits):
    lists: dict[int, list] = {}
    for r in hits.orderBy("query_id", "rank").collect():
        lists.setdefault(r["query_id"], []).append((r["chunk_id"], round(r["score"], 6)))
    return lists


@pytest.fixture(params=[(P.SEGMENT, P.BLOCK), (16, 4)], ids=["large", "small"])
def blocks(request, monkeypatch):
    monkeypatch.setattr(P, "SEGMENT", request.param[0])
    monkeypatch.setattr(P, "BLOCK", request.param[1])
    return request.param


def test_equals_the_plain_scores_and_fills_up_with_zeros(spark, tmp_path, blocks):
    texts = texts_of(160)
    index = indexed(spark, tmp_path / "i", texts, buckets=3, settings=Settings(task_bytes=9_000))
    assert index.chunks.agg(F.max("_share")).first()[0] > 0 and index.segments > 3  # buckets cut into shares
    got = found(search_bm25(index, asked(spark, QUERIES)))
    for q, query in QUERIES.items():
        scores = bm25(texts, query)
        assert got[q] == [(c, round(scores[c], 6)) for c in top(scores, 5)]
    assert got[3] == got[4] and all(score == 0 for _, score in got[3])
    scanned = bm25_topk(index.chunks, asked(spark, QUERIES), index.frequencies, index.stats)
    assert found(scanned) == got
    assert found(search_bm25(index, asked(spark, QUERIES), Settings(broadcast_bytes=300))) == got
    assert search_bm25(index, asked(spark, QUERIES).where("false")).count() == 0


def test_terms_weighed_below_zero(spark, tmp_path, blocks):
    texts = {f"D{i}_C0": "same same other" if i % 2 else "same" for i in range(12)} | {"D99_C0": ""}
    index = indexed(spark, tmp_path / "i", texts, buckets=2)
    scores = bm25(texts, "same other")
    assert min(scores.values()) < 0
    assert found(search_bm25(index, asked(spark, {1: "same other"})))[1] == [(c, round(scores[c], 6)) for c in top(scores, 5)]


def test_few_queries_share_terms_or_many(spark, tmp_path, monkeypatch):
    texts = texts_of(100, seed=4)
    index = indexed(spark, tmp_path / "i", texts, buckets=2)
    many = {i: f"the river rare{i % 7} of" for i in range(30)}
    want = {q: [(c, round(s[c], 6)) for c in top(s, 5)] for q, s in ((q, bm25(texts, t)) for q, t in many.items())}
    assert found(search_bm25(index, asked(spark, many))) == want
    monkeypatch.setattr(P, "MAX_CELLS", 10)  # a group of each query
    assert found(search_bm25(index, asked(spark, many))) == want


def test_blocks_below_the_bar_are_skipped():
    import numpy as np
    import pyarrow as pa

    n = 4 * P.BLOCK
    tf = np.ones(n, dtype=np.int64)
    tf[:5] = 50  # the best chunks lie in the first block
    rows = list(P._posting_rows(iter([pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, dtype=np.int32)), pa.array(np.zeros(n, dtype=np.int32)), pa.array(np.arange(n, dtype=np.int32)),
         pa.array([["a"] * t + ["b"] * (60 - t) for t in tf.tolist()])],
        names=["_bucket", "_share", "_place", "tokens"])])))
    terms = P.QueryTerms(pa.array([7]), ["a"], np.array([0]), np.array([0]), np.array([1.0]))
    search = P._Search(terms, P.SegmentScorer(60.0, 5))
    table = pa.Table.from_batches(rows).filter(pa.compute.is_in(pa.Table.from_batches(rows)["term"], pa.array(["", "a"])))
    for _ in range(8):
        search.add((0, 0, 0), table)
    assert search.blocks_skipped > 0
    hits = pa.Table.from_batches(list(search.batches(pa.array([7])))).to_pydict()
    assert set(hits["_place"]) == {0, 1, 2, 3, 4}


def scanned_rows(df) -> int:
    """Rows that came out of the Parquet scans, after row groups were skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def wide_index(spark, path, n, monkeypatch, buckets):
    monkeypatch.setattr(retrieval, "POINT_READ", {"parquet.block.size": "20000", "parquet.page.size": "2000", "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10"})
    rows = spark.range(n).select(
        F.concat(F.lit("D"), F.lpad("id", 6, "0"), F.lit("_C0")).alias("chunk_id"), F.concat(F.lit("D"), F.lpad("id", 6, "0")).alias("doc_id"),
        F.lit(0).alias("chunk_index"), F.lit("t").alias("title"), F.lit("a").alias("author"), F.lit("c").alias("category"),
        F.concat(F.lit("word"), F.col("id") % 997, F.lit(" "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit("l").alias("citation_label"),
    )
    build_index(rows, str(path), buckets=buckets)
    return open_index(spark, str(path))


def test_only_the_row_groups_of_the_terms_are_read(spark, tmp_path, monkeypatch):
    index = wide_index(spark, tmp_path / "i", 6000, monkeypatch, 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        every = index.postings.count()
        needed = index.postings.where(P.one_of("term", ["", "word5", "word811"])).select("df")
        read = scanned_rows(needed)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert every > 8_000 and 0 < read < every / 4
    plan = search_bm25(index, asked(spark, {1: "word5 word811"}))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "places" in line)
    assert "In(term, [" in scan.split("PushedFilters")[1] and "text" not in scan.split("ReadSchema")[1]


def test_what_a_lookup_reads_does_not_grow_with_the_index(spark, tmp_path, monkeypatch):
    hits = spark.createDataFrame([(1, f"D{i:06}_C0", f"D{i:06}") for i in range(0, 1000, 100)], "query_id int, chunk_id string, doc_id string")
    read = {}
    for n, buckets in ((2000, 2), (16_000, 16)):  # as many times the buckets, as the index grows by them
        index = wide_index(spark, tmp_path / f"i{n}", n, monkeypatch, buckets)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            found = looked_up(index.chunks, hits, index.buckets)
            read[n] = scanned_rows(found)
            assert found.count() == 10
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read[16_000] <= 1.5 * read[2000] < 2000


def test_many_hits_are_joined(spark, tmp_path, monkeypatch):
    from strata.operators import fusion

    texts = texts_of(40)
    index = indexed(spark, tmp_path / "i", texts, buckets=2)
    monkeypatch.setattr(fusion, "LOOKED_UP", 3)
    hits = index.chunks.select("chunk_id", "doc_id").limit(9)
    assert looked_up(index.chunks, hits, index.buckets).count() == 9


def test_an_index_grows_and_writes_terms_in_proportion(spark, tmp_path):
    settings = Settings(bucket_bytes=20_000, task_bytes=80_000)
    texts, path = texts_of(120, seed=2), tmp_path / "i"
    first = indexed(spark, path, texts, buckets=2, settings=settings)
    more = {f"E{i:04}_C0": f"the new stone number{i} " + "of " * (i % 40) for i in range(900)}
    for part in range(3):
        some = {c: t for k, (c, t) in enumerate(more.items()) if k % 3 == part}
        ids = spark.createDataFrame([(c.split("_")[0],) for c in some], "doc_id string")
        index = refresh_index(spark.createDataFrame(chunk_rows(some), CHUNK_SCHEMA), ids, str(path), settings)
    assert index.buckets > first.buckets
    whole = texts | more
    again = indexed(spark, tmp_path / "again", whole, buckets=2)
    assert {r["chunk_id"]: r["text"] for r in index.chunks.collect()} == whole
    assert sorted(map(tuple, index.frequencies.collect())) == sorted(map(tuple, again.frequencies.collect()))
    queries = asked(spark, {1: "new stone number7", 2: "rare1 the"})
    assert found(search_bm25(index, queries)) == found(search_bm25(again, queries))
    gone = spark.createDataFrame([(c.split("_")[0],) for c in more], "doc_id string").distinct()
    for _ in range(9):  # so many runs of term counts are added up into one
        index = refresh_index(spark.createDataFrame([], CHUNK_SCHEMA), gone, str(path), settings)
    assert index.stats.chunks == 120 and sorted(map(tuple, index.frequencies.collect())) == sorted(map(tuple, first.frequencies.collect()))


def test_packed_numbers_whose_bytes_look_like_characters(spark):
    values = [0, 1, 127, 128, 193, 194, 200, 224, 240, 244, 250, 255, 256, 1984, 2047, 61440, 2**31 - 1]
    packed = bytearray(np.array(values, dtype="<i4").tobytes())
    rows = spark.createDataFrame([(packed,)], "packed binary").select("packed", F.explode(F.sequence(F.lit(0), F.lit(len(values) - 1))).alias("at"))
    got = rows.select("at", _number("packed", F.col("at")).alias("n")).orderBy("at").collect()
    assert [r["n"] for r in got] == values


def test_a_chunk_of_very_many_words(spark, tmp_path):
    """240 words in 480 characters: that length is no valid character."""
    index = indexed(spark, tmp_path / "index", {"A_C0": " ".join("ab"[i % 2] for i in range(240)), "B_C0": "b " * 200})
    rows = index.postings.where("term <> ''")
    bounds = {r["term"]: (r["most"], r["least"]) for r in bound_entries(rows).groupBy("term").agg(F.max("most").alias("most"), F.min("least").alias("least")).collect()}
    assert bounds == {"a": (120, 240), "b": (200, 200)}
    assert {(r["term"], r["tf"]) for r in posting_entries(rows).collect()} == {("a", 120), ("b", 120), ("b", 200)}
