"""The index and the full hybrid query over a table of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from strata.config import Settings
from strata.operators.bm25 import Bm25Stats, corpus_stats, with_tokens
from strata.operators.dense import dense_topk
from strata.operators.embed import Embedder, embed_column, hashing_embedder
from strata.operators.fusion import looked_up, rerank_keyword, rerank_model, rrf_fuse, with_keyword_score, with_payload
from strata.operators.postings import POSTINGS, is_size, postings, postings_topk, sizes_of, with_places
from strata.operators.sizing import broadcast_if_small, row_bytes
from strata.session import work_path
from strata.sources.buckets import PACKED, address, bytes_by_bucket, laid_out, split, wanted
from strata.sources.versions import fresh_folder, publish, published

INDEX_BUCKETS = 16  # of a new index; more once their bytes ask for it
TERM_RUNS = 8  # of signed term counts; more are added up into one
# Row groups of the files that are looked into by key, with a Bloom filter of the key.
BLOOM_KEYS = 50_000  # of a row group
POINT_READ = {"parquet.block.size": str(4 << 20), "parquet.page.size": str(256 << 10), "compression": "zstd"}


@dataclass(frozen=True)
class Index:
    """One version of a written index: chunks with tokens and vectors, postings, term counts, scalars.

    Its files are never overwritten, so an open index stays readable while a later
    version is written.
    """

    chunks: DataFrame
    postings: DataFrame
    frequencies: DataFrame
    stats: Bm25Stats
    embedder: Embedder
    path: str = ""
    version: int = 0
    buckets: int | None = None
    segments: int = 0


def _read_parts(spark: SparkSession, path: str, parts: dict, table: str, schema: T.StructType) -> DataFrame:
    """The rows of some buckets, with the bucket as a partition column that filters and joins can prune by."""
    fields = [f for f in schema.fields if f.name != "_bucket"]
    whole = T.StructType([*fields, T.StructField("_bucket", T.IntegerType())])
    by_folder: dict[str, list[str]] = {}
    for b, part in sorted(parts.items()):
        root = f"{path}/{part['folder']}/{table}"
        by_folder.setdefault(root, []).append(f"{root}/_bucket={b}")
    reads = [spark.read.schema(whole).option("basePath", root).parquet(*paths) for root, paths in by_folder.items()]
    return reduce(DataFrame.unionByName, reads) if reads else spark.createDataFrame([], whole)


def _bloomed(df: DataFrame, column: str, path: str) -> None:
    writer = df.write.partitionBy("_bucket").options(**POINT_READ)
    writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(BLOOM_KEYS)).parquet(path)


def _frequencies(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    """(term, df): the sum of the signed counts of all runs."""
    reads = [spark.read.schema("term string, df bigint").parquet(f"{path}/{run}") for run in runs]
    if len(reads) == 1:
        return reads[0]
    every = reduce(DataFrame.unionByName, reads)
    return every.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")


def _publish(
    rows: DataFrame, path: str, version: int, manifest: dict | None, read: set[int], n: int, sizes: dict[int, int],
    settings: Settings, embedder: Embedder | None = None,
) -> None:
    """Write the rows of some buckets with their postings, and publish them with the buckets that stay.

    The rows go to their buckets bare, once; they are embedded there if an ``embedder`` is
    given, else they bring their vectors along. Tokens are not stored: they follow from the text.
    The counts of the terms are a run of differences: those of the written buckets less
    those of the buckets that were read. A batch so writes terms in proportion to itself.
    """
    spark = rows.sparkSession
    folder = fresh_folder(version)
    root = f"{path}/{folder}"
    stored = with_places(laid_out(rows, n, sizes, settings.task_bytes, "doc_id", "chunk_id"))
    if embedder is not None:
        stored = embed_column(stored, embedder)
    _bloomed(stored, "chunk_id", f"{root}/chunks")
    schema = T.StructType([f for f in stored.schema.fields if f.name != "_bucket"])
    chunk_bytes = bytes_by_bucket(spark, f"{root}/chunks")
    chunks = _read_parts(spark, path, {str(b): {"folder": folder} for b in chunk_bytes}, "chunks", schema)
    found = postings(with_tokens(chunks)).sortWithinPartitions("_bucket", "term")  # where the chunks are read: no shuffle
    _bloomed(found, "term", f"{root}/postings")

    post_schema = T.StructType.fromDDL(POSTINGS)
    written = {str(b): {"folder": folder} for b in chunk_bytes}
    now = _read_parts(spark, path, written, "postings", post_schema)
    gone = {b: part for b, part in (manifest or {}).get("parts", {}).items() if int(b) in read}
    totals = sizes_of(now).groupBy("_bucket").agg(
        F.sum("df").alias("chunks"), F.sum("tokens").alias("tokens"),
        F.count_distinct("_share", "_segment").alias("segments"),
    )
    for r in totals.collect():  # a row a bucket
        b = str(r["_bucket"])
        written[b] |= {"chunks": r["chunks"], "tokens": r["tokens"] or 0, "segments": r["segments"], "bytes": chunk_bytes[int(b)]}
    counted = now.where(~is_size()).select("term", F.col("df").cast("long").alias("df"))
    if gone:
        before = _read_parts(spark, path, gone, "postings", post_schema).where(~is_size())
        counted = counted.unionByName(before.select("term", (-F.col("df").cast("long")).alias("df")))
    run = counted.groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")
    run.sortWithinPartitions("term").write.options(**POINT_READ).parquet(f"{root}/terms")
    runs = [*(manifest or {}).get("terms", []), f"{folder}/terms"]
    if len(runs) > TERM_RUNS:
        _frequencies(spark, path, runs).sortWithinPartitions("term").write.options(**POINT_READ).parquet(f"{root}/all-terms")
        runs = [f"{folder}/all-terms"]
    parts = {b: part for b, part in (manifest or {}).get("parts", {}).items() if b not in gone} | written
    size = {key: sum(p[key] for p in parts.values()) for key in ("chunks", "tokens", "segments")}
    stats = corpus_stats(size, _frequencies(spark, path, runs), settings.bm25_epsilon)
    publish(
        spark,
        path,
        version,
        {
            "buckets": n,
            "parts": parts,
            "terms": runs,
            "segments": size["segments"],
            "stats": stats.__dict__,
            "schema": schema.jsonValue(),
        },
    )


def _sizes(rows: DataFrame, n: int) -> dict[int, int]:
    """Bytes in memory of the rows of each bucket."""
    sized = rows.select(address("doc_id", n).alias("b"), row_bytes(rows).alias("n")).groupBy("b").agg(F.sum("n").alias("n"))
    return {r["b"]: r["n"] for r in sized.collect()}  # a row a bucket


def build_index(
    chunks: DataFrame, path: str, settings: Settings = Settings(), embedder: Embedder | None = None,
    buckets: int = INDEX_BUCKETS,
) -> Index:
    """Embed and tokenise every chunk, and publish the tables queries read.

    Chunks lie in buckets by a hash of their document, so that a later batch
    rewrites only the buckets its documents fall into. Columnar storage lets dense
    search read only the vectors; BM25 reads the postings of its terms. ``buckets``
    is the least number of them.
    """
    embedder = embedder or hashing_embedder(settings.embedding_dim)
    spark = chunks.sparkSession
    version, _ = published(spark, path)
    sizes = _sizes(chunks, buckets)
    n = wanted(buckets, sum(sizes.values()) // PACKED, settings.bucket_bytes)
    if n != buckets:
        sizes = _sizes(chunks, n)
    _publish(chunks, path, version + 1, None, set(), n, sizes, settings, embedder)
    return open_index(spark, path, settings, embedder)


def refresh_index(
    chunks: DataFrame, doc_ids: DataFrame, path: str, settings: Settings = Settings(), embedder: Embedder | None = None
) -> Index:
    """Replace all chunks of some documents by the given ones, as a new version.

    ``doc_ids`` (one column, ``doc_id``) names every document that changed or went;
    ``chunks`` holds the chunks of those that are still there. Only these are
    tokenised and embedded, and only their buckets, and those that are split as the
    index has grown, are written.
    """
    embedder = embedder or hashing_embedder(settings.embedding_dim)
    spark = chunks.sparkSession
    version, manifest = published(spark, path)
    if manifest is None:
        return build_index(chunks, path, settings, embedder)
    old_n = manifest["buckets"]
    touched = {r["b"] for r in doc_ids.select(address("doc_id", old_n).alias("b")).distinct().collect()}
    if not touched:
        return open_index(spark, path, settings, embedder)
    incoming = _sizes(chunks, old_n)
    held = {int(b): part["bytes"] for b, part in manifest["parts"].items()}
    n = wanted(old_n, sum(held.values()) + sum(incoming.values()) // PACKED, settings.bucket_bytes)
    moved = split(old_n, n)
    read = touched | set(incoming) | set(moved)
    sizes: dict[int, int] = {}
    for b in read:
        parts = [b, *moved.get(b, ())]
        sizes |= dict.fromkeys(parts, (held.get(b, 0) * PACKED + incoming.get(b, 0)) // len(parts) + 1)
    schema = T.StructType.fromJson(manifest["schema"])
    names = [f.name for f in schema.fields if f.name not in ("_share", "_place", "tokens")]
    there = {b: part for b, part in manifest["parts"].items() if int(b) in read}
    changed = broadcast_if_small(doc_ids.select("doc_id").distinct(), settings.broadcast_bytes)
    stay = _read_parts(spark, path, there, "chunks", schema).join(changed, "doc_id", "left_anti").select(*names)
    rows = stay.unionByName(embed_column(chunks, embedder).select(*names))
    _publish(rows, path, version + 1, manifest, read, n, sizes, settings)
    return open_index(spark, path, settings, embedder)


def open_index(
    spark: SparkSession, path: str, settings: Settings = Settings(), embedder: Embedder | None = None
) -> Index:
    """The latest version of a written index; its embedder must be the one it was built with."""
    version, manifest = published(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no index was published under {path}")
    return Index(
        with_tokens(_read_parts(spark, path, manifest["parts"], "chunks", T.StructType.fromJson(manifest["schema"]))),
        _read_parts(spark, path, manifest["parts"], "postings", T.StructType.fromDDL(POSTINGS)),
        _frequencies(spark, path, manifest["terms"]),
        Bm25Stats(**manifest["stats"]),
        embedder or hashing_embedder(settings.embedding_dim),
        path,
        version,
        manifest["buckets"],
        manifest["segments"],
    )


def search_dense(index: Index, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    embedded = embed_column(queries, index.embedder, "query")
    return dense_topk(index.chunks, embedded, settings.dense_k, settings.broadcast_bytes)


def search_bm25(index: Index, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return postings_topk(
        index.postings,
        index.chunks,
        queries,
        index.frequencies,
        index.stats,
        index.segments,
        settings.bm25_k,
        settings.bm25_k1,
        settings.bm25_b,
        settings.broadcast_bytes,
    )


def fused_candidates(index: Index, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Dense and BM25 hits fused, with the chunk columns; ``fused_count`` per query.

    The fused hits are written once; their keys then look up the chunks.
    """
    dense = search_dense(index, queries, settings)
    lexical = search_bm25(index, queries, settings)
    fused = rrf_fuse(dense, lexical, settings.rrf_k, settings.fused_k)
    counted = fused.withColumn("fused_count", F.count(F.lit(1)).over(Window.partitionBy("query_id")))
    path = work_path(queries.sparkSession, "fused")
    counted.write.parquet(path)
    hits = queries.sparkSession.read.schema(counted.schema).parquet(path)
    return with_payload(hits, queries, looked_up(index.chunks, hits, index.buckets, settings.broadcast_bytes))


def hybrid_search(
    index: Index,
    queries: DataFrame,
    settings: Settings = Settings(),
    scorer: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Dense + BM25 -> RRF -> rerank, for every row of (query_id, query)."""
    candidates = fused_candidates(index, queries, settings)
    if scorer is not None:
        return rerank_model(candidates, scorer, settings.rerank_k)
    return rerank_keyword(candidates, settings.rerank_k)


def retrieval_counts(reranked: DataFrame) -> DataFrame:
    """Hits per query at each step of the search."""
    return reranked.groupBy("query_id").agg(
        F.max("dense_hits_count").alias("dense_hits_count"),
        F.max("bm25_hits_count").alias("bm25_hits_count"),
        F.max("fused_count").alias("rrf_fused_count"),
        F.count(F.lit(1)).alias("final_reranked_count"),
    )


def compare_methods(
    index: Index, queries: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Dense, BM25, fused and reranked lists against the reranked one.

    Per method: hits, how many of them the reranked list shares, and the mean
    reciprocal rank at which the method has the reranked list's first chunk.
    Every method's rank is a column of the fused rows, so one search serves all.
    """
    wide = replace(settings, fused_k=settings.dense_k + settings.bm25_k)
    scored = with_keyword_score(fused_candidates(index, queries, wide))
    kept = F.col("rank") <= settings.fused_k  # the rows the search itself would rerank
    order = Window.partitionBy("query_id").orderBy(F.desc(kept), F.desc("rerank_score"), "rank")
    final = F.when(kept, F.row_number().over(order)).alias("final_rank")
    ranks = scored.select(
        "query_id", "dense_rank", "bm25_rank", F.when(kept, F.col("rank")).alias("fused_rank"), final
    )

    def entry(method: str, rank: str) -> Column:
        return F.struct(F.lit(method).alias("method"), F.col(rank).alias("method_rank"), "final_rank")

    ranked = ranks.select(
        "query_id",
        F.inline(
            F.array(
                entry("dense", "dense_rank"),
                entry("bm25", "bm25_rank"),
                entry("fused", "fused_rank"),
                entry("reranked", "final_rank"),
            )
        ),
    )
    first = F.when((F.col("final_rank") == 1) & F.col("method_rank").isNotNull(), 1 / F.col("method_rank"))
    in_final = (F.col("final_rank") <= settings.rerank_k) & F.col("method_rank").isNotNull()
    return ranked.groupBy("method").agg(
        F.count_distinct("query_id").alias("queries"),
        F.count("method_rank").alias("hits"),
        F.count_if(in_final).alias("shared_with_reranked"),
        (F.coalesce(F.sum(first), F.lit(0.0)) / F.count_distinct("query_id")).alias("mrr"),
    )
