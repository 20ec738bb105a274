from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.operators import bm25
from strata.operators.answer import NO_CONTEXT, grounded_answers
from strata.operators.bm25 import ContainmentScorer, bm25_topk, corpus_size, corpus_stats, document_frequencies, keyword_topk, with_tokens
from strata.operators.dense import dense_topk, first_k
from strata.operators.embed import embed_column, hashing_embedder, model_embedder
from strata.operators.chunks import ORDER
from strata.operators.fusion import looked_up, rerank_keyword, rerank_model, rrf_fuse, with_payload
from strata.operators.topk import BestHits, best_rows
from strata.plans.retrieval import (
    build_index,
    compare_methods,
    hybrid_search,
    open_index,
    refresh_index,
    retrieval_counts,
)
from strata.sources.versions import published
from strata.config import Settings
from tests import helpers
from tests.helpers import CHUNK_SCHEMA, chunk_rows

TWO = {
    "ART-101_C0": "A lake table MERGE updates rows by a business key and inserts the new ones.",
    "ART-102_C0": "Dense vectors and lexical scores are fused by their ranks.",
}


def corpus(spark, texts: dict[str, str], partitions: int = 3):
    return spark.createDataFrame(chunk_rows(texts), CHUNK_SCHEMA).repartition(partitions)


def asked(spark, queries: dict[int, str]):
    return spark.createDataFrame(list(queries.items()), "query_id int, query string")


def random_texts(n: int, seed: int = 3) -> dict[str, str]:
    """Skewed words: one word is in most chunks; a third of the chunks are copies of one text."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    texts = {}
    for i in range(n):
        if i % 3 == 0:
            text = "the same Words in every copy w1 w2"
        else:
            text = " ".join(["the"] * rng.randint(0, 3) + rng.choices(words, k=rng.randint(0, 12)))
        texts[f"D{i % 17}_C{i // 17}"] = text
    return texts


QUERIES = {1: "the w1 w2 w2", 2: "unknown terms only", 3: "", 4: "W5 w6 W7 the", 5: "copy words", 6: "w39"}


def ranking(df) -> dict[int, list[str]]:
    found: dict[int, list[str]] = {}
    for row in df.orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append(row["chunk_id"])
        assert row["rank"] == len(found[row["query_id"]])
    return found


def lexical(spark, texts, queries, k=5, limit=64 << 20):
    chunks = with_tokens(corpus(spark, texts))
    frequencies = document_frequencies(chunks)
    stats = corpus_stats(chunks.agg(*corpus_size()).first().asDict(), frequencies)
    return bm25_topk(chunks, asked(spark, queries), frequencies, stats, k, broadcast_bytes=limit)


@pytest.mark.parametrize("limit", [64 << 20, 300], ids=["broadcast", "blocks"])
def test_bm25_is_the_textbook_score(spark, limit):
    texts = random_texts(120)
    df = lexical(spark, texts, QUERIES, 7, limit)
    got = ranking(df)
    scores = {(r["query_id"], r["chunk_id"]): r["score"] for r in df.collect()}
    for query_id, query in QUERIES.items():
        want = helpers.bm25(texts, query)
        assert got[query_id] == helpers.top(want, 7)
        for chunk_id in got[query_id]:
            assert scores[query_id, chunk_id] == pytest.approx(want[chunk_id], abs=1e-12)


def test_bm25_with_negative_idf(spark):
    """In a tiny corpus the mean idf is negative: chunks without a match come first."""
    texts = {"D0_C0": "a a b", "D1_C0": "a b", "D2_C0": "c", "D3_C0": "a b c"}
    got = ranking(lexical(spark, texts, {1: "a b"}, 4))
    assert got[1] == helpers.top(helpers.bm25(texts, "a b"), 4)


def test_fewer_chunks_than_k_gives_all(spark):
    assert ranking(lexical(spark, TWO, {1: "merge"}, 5)) == {1: list(TWO)}


def test_unmatched_query_fills_k_in_corpus_order(spark):
    texts = {f"D{i}_C{j}": f"text {i} {j}" for i in range(3) for j in (0, 1, 10, 2)}
    assert ranking(lexical(spark, texts, {1: "nothing"}, 4))[1] == ["D0_C0", "D0_C1", "D0_C2", "D0_C10"]


@pytest.mark.parametrize("automaton", [True, False])
@pytest.mark.parametrize("limit", [64 << 20, 200], ids=["broadcast", "blocks"])
def test_containment_counts_substrings_and_repeats(spark, automaton, limit, monkeypatch):
    if not automaton:
        monkeypatch.setattr(bm25, "ahocorasick", None)
    texts = random_texts(60)
    got = ranking(keyword_topk(corpus(spark, texts), asked(spark, QUERIES), 6, limit))
    for query_id, query in QUERIES.items():
        scores = {c: float(sum(t in text.lower() for t in query.lower().split())) for c, text in texts.items()}
        assert got[query_id] == helpers.top(scores, 6)


def vectors(spark, n: int, dim: int = 8, seed: int = 5):
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, dim)).astype(np.float32)
    matrix[::3] = matrix[0]  # a third of the rows are copies
    rows = [(f"D{i}_C0", f"D{i}", 0, [float(x) for x in v]) for i, v in enumerate(matrix)]
    schema = "chunk_id string, doc_id string, chunk_index int, embedding array<float>"
    return matrix.astype(np.float64), spark.createDataFrame(rows, schema).repartition(4)


@pytest.mark.parametrize("limit", [64 << 20, 400], ids=["broadcast", "blocks"])
def test_dense_is_exact_cosine(spark, limit):
    matrix, df = vectors(spark, 90)
    wanted = np.vstack([matrix[0], matrix[1], -matrix[2], np.zeros(8), matrix[4] * 7, matrix[5], matrix[7]])
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(wanted)], "query_id int, embedding array<double>"
    )
    got = ranking(dense_topk(df, queries, 5, limit))
    for i, query in enumerate(wanted):
        norms = np.linalg.norm(matrix, axis=1) * np.linalg.norm(query)
        cosine = (matrix @ query) / (norms + 1e-9)
        assert got[i] == helpers.top({f"D{j}_C0": s for j, s in enumerate(cosine)}, 5)


def test_vectors_of_two_widths_are_refused(spark):
    _, df = vectors(spark, 4)
    mixed = df.withColumn("embedding", F.when(F.col("doc_id") == "D1", F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))).coalesce(1)
    queries = df.limit(1).select(F.lit(1).alias("query_id"), "embedding")
    with pytest.raises(Exception, match="one width"):
        dense_topk(mixed, queries, 2).collect()


def test_best_rows_against_a_full_sort():
    rng = np.random.default_rng(1)
    for n, q, k in ((1, 1, 3), (5, 2, 5), (50, 7, 3), (40, 3, 39)):
        scores = rng.integers(0, 4, size=(n, q)).astype(float)
        rows, queries = best_rows(scores, k)
        for column in range(q):
            want = np.argsort(-scores[:, column], kind="stable")[:k]
            assert sorted(rows[queries == column]) == sorted(want)


def test_first_k_without_a_model(spark):
    df = corpus(spark, random_texts(40))
    queries = asked(spark, {1: "x", 2: "y"})
    got = ranking(first_k(df, queries, 3))
    assert got == {1: ["D0_C0", "D0_C1", "D0_C2"], 2: ["D0_C0", "D0_C1", "D0_C2"]}
    assert first_k(df.where("false"), queries, 3).count() == 0


def test_hashing_embedder(spark):
    df = spark.createDataFrame([("a b A",), ("",), (None,)], "text string")
    got = [np.array(r["embedding"]) for r in embed_column(df, hashing_embedder(16)).collect()]
    assert got[0].shape == (16,) and np.linalg.norm(got[0]) == pytest.approx(1)
    assert sorted(got[0][got[0] > 0]) == pytest.approx(sorted(np.array([1, 2]) / np.sqrt(5)), abs=1e-6)
    assert not got[1].any() and not got[2].any()


def test_user_model_as_embedder(spark):
    embedder = model_embedder(lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]))
    df = spark.createDataFrame([("abc",), ("",)], "text string")
    assert [list(r["embedding"]) for r in embed_column(df, embedder).collect()] == [[3.0, 1.0], [0.0, 1.0]]


HIT_SCHEMA = "query_id int, chunk_id string, doc_id string, chunk_index int, score double, rank int"


def hits(spark, *rows):
    return spark.createDataFrame([(1, f"{d}_C0", d, 0, s, r) for d, s, r in rows], HIT_SCHEMA)


def test_rrf_scores_ties_and_payload(spark):
    dense = hits(spark, ("A", 0.9, 1), ("B", 0.8, 2), ("C", 0.7, 3))
    lexical_hits = hits(spark, ("D", 7.0, 1), ("B", 6.0, 2), ("E", 5.0, 3))
    rows = rrf_fuse(dense, lexical_hits, k=5).orderBy("rank").collect()
    assert [r["doc_id"] for r in rows] == ["B", "A", "D", "C", "E"]
    assert rows[0]["rrf_score"] == 2 / 62 and rows[1]["rrf_score"] == 1 / 61
    assert rows[0]["score"] == 6.0 and rows[1]["score"] == 0.9
    assert {(r["dense_hits_count"], r["bm25_hits_count"]) for r in rows} == {(3, 3)}
    assert rrf_fuse(dense, lexical_hits, k=2).count() == 2


def test_rrf_of_one_empty_list(spark):
    dense = hits(spark, ("A", 0.9, 1))
    fused = rrf_fuse(dense, dense.where("false")).first()
    assert (fused["rrf_score"], fused["dense_hits_count"], fused["bm25_hits_count"]) == (1 / 61, 1, 0)


def candidates(spark):
    rows = [
        (1, "schema enforcement", "C1", "Delta tables: schema enforcement blocks invalid columns.", 0.02, 1),
        (1, "schema enforcement", "C2", "The producer writes to raw topics.", 0.01, 2),
        (2, "a a A", "C3", "banana", None, 1),
    ]
    return spark.createDataFrame(
        rows, "query_id int, query string, chunk_id string, text string, rrf_score double, rank int"
    )


def test_keyword_rerank(spark):
    got = {r["chunk_id"]: r["rerank_score"] for r in rerank_keyword(candidates(spark), 3).collect()}
    assert got == pytest.approx({"C1": 0.22, "C2": 0.01, "C3": 0.1})


def test_model_rerank_with_a_stub(spark):
    @F.pandas_udf("double")
    def longest_first(query: pd.Series, text: pd.Series) -> pd.Series:
        return text.str.len().astype(float)

    rows = rerank_model(candidates(spark), longest_first, 1).orderBy("query_id").collect()
    assert [(r["query_id"], r["chunk_id"], r["rerank_score"]) for r in rows] == [(1, "C1", 56.0), (2, "C3", 6.0)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    build_index(corpus(spark, {**TWO, **random_texts(50)}), path)
    return open_index(spark, path)


def test_written_index_keeps_its_scalars(spark, tmp_path):
    built = build_index(corpus(spark, TWO), str(tmp_path / "i"))
    assert open_index(spark, str(tmp_path / "i")).stats == built.stats
    assert built.stats.chunks == 2
    assert built.stats.avgdl == sum(len(t.split()) for t in TWO.values()) / 2


def test_hybrid_search_and_answers(spark, index):
    queries = asked(spark, {1: "lake table MERGE", 2: "fused by ranks"})
    found = hybrid_search(index, queries)
    rows = found.orderBy("query_id", "final_rank").collect()
    assert [r["chunk_id"] for r in rows if r["final_rank"] == 1] == list(TWO)
    counts = retrieval_counts(found).collect()
    assert {(r["dense_hits_count"], r["bm25_hits_count"], r["rrf_fused_count"], r["final_reranked_count"]) for r in counts} == {
        (5, 5, 5, 3)
    }
    answer = grounded_answers(found, queries).where("query_id = 1").first()
    text = TWO["ART-101_C0"]
    assert answer["answer"].startswith(
        "### Query Response\nBased strictly on the retrieved knowledge base documents:\n\n"
        f'Key Excerpt 1: "{text}" [1]\n\nKey Excerpt 2: '
    )
    assert "\n\n### Referenced Citations\n  - [1] Document 'Title of ART-101' by Someone (ID: ART-101, Chunk: ART-101_C0)\n" in answer["answer"]
    assert [c["citation_num"] for c in answer["citations"]] == [1, 2, 3]
    assert answer["retrieved_chunks"][0]["citation_label"] == "[ART-101_C0]"
    assert answer["search_evaluation"]["final_reranked_count"] == 3


def test_search_is_the_same_in_blocks(spark, index):
    queries = asked(spark, QUERIES)
    columns = ["query_id", "chunk_id", "final_rank", "rerank_score"]
    whole = hybrid_search(index, queries).select(*columns).collect()
    blocks = hybrid_search(index, queries, Settings(broadcast_bytes=500)).select(*columns).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, blocks))


def test_empty_corpus_answers_with_no_context(spark, tmp_path):
    empty = build_index(corpus(spark, TWO).where("false"), str(tmp_path / "empty"))
    queries = asked(spark, {1: "anything"})
    row = grounded_answers(hybrid_search(empty, queries), queries).first()
    assert row["answer"] == NO_CONTEXT
    assert row["citations"] == [] and row["retrieved_chunks"] == [] and row["search_evaluation"] is None


def test_compare_methods(spark, index):
    queries = asked(spark, {1: "lake table MERGE", 2: "fused by ranks"})
    rows = {r["method"]: r.asDict() for r in compare_methods(index, queries).collect()}
    assert set(rows) == {"dense", "bm25", "fused", "reranked"}
    assert rows["reranked"]["mrr"] == 1.0 and rows["reranked"]["shared_with_reranked"] == 6
    assert all(r["hits"] == 10 and r["queries"] == 2 for r in rows.values())


def test_a_task_leaves_k_rows_a_query():
    """However many queries a block holds: k x queries rows leave, and they are the best."""
    rng = np.random.default_rng(7)
    for n_queries in (10, 50_000, 1_000_000):
        k, best, seen = 2, BestHits(pa.array(np.arange(n_queries)), 2, ["chunk_id", *ORDER]), []
        for part in range(3):
            scores = rng.integers(0, 5, size=(4, n_queries)).astype(float)
            ids = [f"D{part}_{i}" for i in range(4)]
            best.add(pa.table({"chunk_id": ids, "doc_id": ids, "chunk_index": [0] * 4}), scores)
            seen.append(scores)
        batches = list(best.batches())
        assert sum(b.num_rows for b in batches) == k * n_queries
        if n_queries == 10:
            every = np.concatenate(seen)
            names = [f"D{p}_{i}" for p in range(3) for i in range(4)]
            got = pa.Table.from_batches(batches).to_pandas().groupby("query_id")["chunk_id"].apply(list)
            for q in range(n_queries):
                want = sorted(range(12), key=lambda i: (-every[i, q], names[i]))[:k]
                assert sorted(got[q]) == sorted(names[i] for i in want)


def test_query_texts_are_not_broadcast(spark, index):
    queries = spark.createDataFrame([(i, "merge " * 20_000) for i in range(40)], "query_id int, query string")
    hits_of = queries.select("query_id", F.lit("ART-101_C0").alias("chunk_id"), F.lit("ART-101").alias("doc_id"), F.lit(1).alias("rank"))
    found = with_payload(hits_of, queries, looked_up(index.chunks, hits_of, index.buckets))
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 2 and not any("strategy" in line for line in joins)
    assert found.count() == 40


def test_refresh_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "index")
    texts = {f"D{i}_C0": f"words number {i} of this text" for i in range(40)}
    first = build_index(corpus(spark, texts), path, buckets=8)
    parts = published(spark, path)[1]["parts"]
    new = {"D3_C0": "quite other words", "D3_C1": "and a second chunk"}
    ids = spark.createDataFrame([("D3",), ("D7",)], "doc_id string")
    index = refresh_index(corpus(spark, new), ids, path)
    after = published(spark, path)[1]["parts"]
    moved = [b for b in parts if parts[b]["folder"] != after.get(b, {}).get("folder")]
    assert 1 <= len(moved) <= 2 and index.version == first.version + 1
    want = {c: t for c, t in texts.items() if c not in ("D3_C0", "D7_C0")} | new
    assert {r["chunk_id"]: r["text"] for r in index.chunks.collect()} == want
    assert first.chunks.count() == 40  # the open version stays readable
    rebuilt = build_index(corpus(spark, want), str(tmp_path / "again"))
    assert index.stats.chunks == rebuilt.stats.chunks
    assert index.stats.mean_idf == pytest.approx(rebuilt.stats.mean_idf)
    assert sorted(map(tuple, index.frequencies.collect())) == sorted(map(tuple, rebuilt.frequencies.collect()))


def test_the_payload_scan_skips_buckets(spark, tmp_path):
    texts = {f"D{i}_C0": f"words number {i} of this text" for i in range(60)}
    path = str(tmp_path / "index")
    build_index(corpus(spark, texts), path, buckets=8)
    index = refresh_index(corpus(spark, {"D5_C0": "words anew"}), spark.createDataFrame([("D5",)], "doc_id string"), path)
    queries = asked(spark, {1: "number 7"})
    found = hybrid_search(index, queries)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "citation_label" in line]
    assert scans and all("_bucket" in line.split("PartitionFilters")[1] and "chunk_id" in line.split("PushedFilters")[1] for line in scans)
    assert "_bucket" not in found.columns
