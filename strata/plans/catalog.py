"""The registered queries: each operator over the whole given tables.

Every query is ``f(spark, sf_dir) -> DataFrame``. Its SQL twin, where there is
one, is in ``oracle.py`` under the same key. Where the given tables have no
column for a case (a bad value, a later version of a row), the query derives it
from the columns they have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.config import Settings
from strata.operators import gold
from strata.operators.answer import grounded_answers
from strata.operators.bm25 import Bm25Scorer, keyword_topk, term_table, weighted_queries
from strata.operators.chunks import chunk_documents
from strata.operators.contract import (
    ARTICLE_EVENT,
    ARTICLE_RECORD,
    Contract,
    Field,
    check,
    dead_letter_rows,
    ingest_counts,
    quarantine_rows,
    valid_rows,
)
from strata.operators.dense import dense_topk, first_k
from strata.operators.embed import embed_column
from strata.operators.fusion import rerank_keyword, rrf_fuse
from strata.operators.lineage import lineage_events
from strata.operators.merge import dedup_latest, standardize, upsert
from strata.operators.postings import bound_entries, is_size, posting_entries
from strata.operators.quality import check_rows, summarize
from strata.operators.sizing import measured_bytes
from strata.operators.topk import topk_hits
from strata.plans import medallion
from strata.plans.retrieval import (
    Index,
    build_index,
    compare_methods,
    fused_candidates,
    hybrid_search,
    retrieval_counts,
    search_bm25,
    search_dense,
)
from strata.session import configure, work_path
from strata.sources.articles import articles, as_json, table
from strata.sources.readers import read_events, read_json, stream_lines
from strata.sources.silver import merge_silver, read_silver
from strata.sources.writers import (
    SchemaMismatchError,
    append_batch,
    append_enforced,
    read_batches,
    read_quarantine,
    read_valid,
    write_json,
    write_split,
)
from strata.streaming.contract_stream import stream_contract, stream_silver

Query = Callable[[SparkSession, str], DataFrame]

# The contract of the article view: its categories are languages.
ARTICLES = ARTICLE_EVENT.with_allowed("category", ("de", "en", "fr"))

READING = Contract("reading", (Field("count", "integer", ge=0), Field("amount", "number", ge=0, le=400)))
STAMPED = Contract("stamped", (Field("stamp", fmt="iso8601"),))
RECORDS = ARTICLE_RECORD.with_allowed("category", ("de", "en", "fr"))

_queries: dict[str, Query] = {}
_indexes: dict[tuple[str, str], Index] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def register(function: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        _queries[name] = prepared
        return function

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)


def checked_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(as_json(articles(spark, sf_dir, spread_out=True)), ARTICLES)


def failure_rows(checked: DataFrame, fields: tuple[str, ...], starting: str) -> DataFrame:
    """(article_id, field, message) of the failures of some fields."""
    failures = checked.select("article_id", F.inline("_errors"))
    return failures.where(F.col("field").isin(*fields) & F.col("message").startswith(starting))


def new_index(spark: SparkSession, sf_dir: str) -> Index:
    return build_index(chunk_documents(articles(spark, sf_dir, spread_out=True)), work_path(spark, "index"))


def shared_index(spark: SparkSession, sf_dir: str) -> Index:
    """The index of a folder's documents, built on the first query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        _indexes[key] = new_index(spark, sf_dir)
    return _indexes[key]


def hits(ranked: DataFrame) -> DataFrame:
    """Hits with their score rounded for comparison."""
    return ranked.withColumn("score", F.round("score", 6))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item is a query, with its whole text."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def by_type(**values: Column) -> Column:
    """A value per event type."""
    result = None
    for event_type, value in values.items():
        matches = F.col("event_type") == event_type
        result = F.when(matches, value) if result is None else result.when(matches, value)
    return result


# Sources, contracts, sinks


@query("ingest_json")
def ingest_json(spark, sf_dir):
    path = work_path(spark, "events-json")
    events = table(spark, sf_dir, "events")
    as_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")
    write_json(events.select("event_id", as_text, "user_id", "event_type", "value", "props"), path)
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    return read_json(spark, path, schema)


@query("contract_valid")
def contract_valid(spark, sf_dir):
    return valid_rows(checked_articles(spark, sf_dir), ARTICLES)


@query("contract_quarantine")
def contract_quarantine(spark, sf_dir):
    # Ids and times are left out: they hang on the text form of the payload and on the clock.
    rejected = quarantine_rows(checked_articles(spark, sf_dir))
    payload = F.col("raw_payload")
    return rejected.select(
        F.get_json_object(payload, "$.article_id").alias("article_id"),
        "failed_field",
        "rejection_reason",
        F.get_json_object(payload, "$.content").alias("content"),
    )


@query("contract_all_failures")
def contract_all_failures(spark, sf_dir):
    checked = checked_articles(spark, sf_dir)
    return checked.where(F.size("_errors") > 0).select(
        "article_id", F.array_join("_errors.field", ",").alias("failed_fields")
    )


@query("contract_length")
def contract_length(spark, sf_dir):
    return failure_rows(checked_articles(spark, sf_dir), ("title", "author", "content"), "String should have")


@query("contract_range")
def contract_range(spark, sf_dir):
    return failure_rows(checked_articles(spark, sf_dir), ("views", "rating"), "Input should be")


@query("contract_enum")
def contract_enum(spark, sf_dir):
    return failure_rows(checked_articles(spark, sf_dir), ("category",), "Value error")


@query("contract_coerce")
def contract_coerce(spark, sf_dir):
    key, value = F.col("event_id").cast("string"), F.col("value").cast("string")
    count = by_type(
        view=key,
        click=F.concat(F.lit('" '), key, F.lit(' "')),
        purchase=F.concat(key, F.lit(".0")),
        signup=F.concat(key, F.lit(".5")),
        error=F.concat(F.lit('"x'), key, F.lit('"')),
    )
    amount = by_type(
        view=value,
        click=F.concat(F.lit('"'), value, F.lit('"')),
        purchase=F.lit("true"),
        signup=F.lit("null"),
        error=F.lit('"n/a"'),
    )
    payload = F.concat(F.lit('{"count": '), count, F.lit(', "amount": '), amount, F.lit("}"))
    events = table(spark, sf_dir, "events").select("event_id", payload.alias("value"))
    return check(events, READING).select(
        "event_id", "count", "amount", F.array_join("_errors.message", "; ").alias("messages")
    )


@query("contract_timestamp")
def contract_timestamp(spark, sf_dir):
    stamp = by_type(
        view=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        click=F.date_format("ts", "yyyy-MM-dd"),
        purchase=F.date_format("ts", "yyyy-MM-dd HH:mm"),
        signup=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss',5+02:00'"),
        error=F.date_format("ts", "dd/MM/yyyy"),
    )
    events = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(stamp.alias("stamp"))).alias("value"))
    checked = check(events, STAMPED)
    typed = standardize(checked.withColumn("parsed", F.col("stamp")), (), (), ("parsed",))
    return typed.select("event_id", "stamp", "parsed", (F.size("_errors") == 0).alias("accepted"))


@query("contract_record")
def contract_record(spark, sf_dir):
    digest = F.md5(F.col("article_id"))
    parts = [F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    records = articles(spark, sf_dir, spread_out=True).select(
        F.concat_ws("-", *parts).alias("article_id"),
        "title",
        "content",
        "category",
        F.col("published_timestamp").alias("published_at"),
        (F.size(F.split("content", " ")) - 3).alias("word_count"),
    )
    letters = dead_letter_rows(check(as_json(records), RECORDS))
    return letters.select(
        F.get_json_object("raw_payload", "$.article_id").alias("article_id"),
        "error_type",
        "field_failed",
        "error_message",
    )


@query("ingest_counts")
def ingest_split_counts(spark, sf_dir):
    return ingest_counts(checked_articles(spark, sf_dir))


@query("landing_split")
def landing_split(spark, sf_dir):
    """Events from JSON lines, landed once as valid and quarantined rows, read back."""
    lines, landing = work_path(spark, "lines"), work_path(spark, "landing")
    as_json(articles(spark, sf_dir, spread_out=True)).write.text(lines)
    write_split(check(read_events(spark, lines), ARTICLES), ARTICLES, landing)
    valid = read_valid(spark, landing, ARTICLES).select(
        "article_id", F.lit("valid").alias("status"), F.lit(None).cast("string").alias("failed_field")
    )
    rejected = read_quarantine(spark, landing, ARTICLES).select(
        F.get_json_object("raw_payload", "$.article_id").alias("article_id"),
        F.lit("quarantined").alias("status"),
        "failed_field",
    )
    return valid.unionByName(rejected)


@query("stream_contract")
def stream_contract_split(spark, sf_dir):
    """The same split by a drained stream over JSON lines."""
    lines, out, checkpoint = (work_path(spark, n) for n in ("lines", "stream", "checkpoint"))
    as_json(articles(spark, sf_dir, spread_out=True)).write.text(lines)
    stream_contract(stream_lines(spark, lines), ARTICLES, out, checkpoint).awaitTermination()
    return read_valid(spark, out, ARTICLES)


@query("stream_silver_upsert")
def stream_silver_upsert(spark, sf_dir):
    """A silver table fed by a stream of several micro-batches."""
    lines, silver, staging, checkpoint = (work_path(spark, n) for n in ("lines", "silver", "staging", "checkpoint"))
    as_json(articles(spark, sf_dir, spread_out=True)).write.text(lines)
    events = stream_lines(spark, lines, max_files=3)
    stream_silver(events, ARTICLES, silver, staging, checkpoint).awaitTermination()
    return read_silver(spark, silver).select(*ARTICLES.columns)


# Bronze, silver, gold


@query("bronze_append")
def bronze_append(spark, sf_dir):
    """Two batches appended, the second one replayed."""
    path = work_path(spark, "bronze")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("ingestion_date"), F.lit("events").alias("_source")
    )
    for batch_id in (1, 2, 2):
        append_batch(events, path, batch_id)
    return read_batches(spark, path).select(
        "event_id", "event_type", "value", "ingestion_date", "_source", F.col("_batch_id").cast("long").alias("_batch_id")
    )


@query("bronze_incremental")
def bronze_incremental(spark, sf_dir):
    """Only the batches behind the last one merged."""
    path = work_path(spark, "bronze")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    append_batch(orders, path, 1, ())
    append_batch(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), path, 2, ())
    return read_batches(spark, path, after=1).select("o_orderkey", "o_totalprice", "day")


@query("silver_standardize")
def silver_standardize(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    text = orders.select(
        "o_orderkey",
        F.when(status == "P", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("views"),
        F.when(status == "O", F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string")).alias("rating"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'Z'"))
        .when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
        .alias("published_timestamp"),
    )
    return standardize(text)


def order_versions(spark, sf_dir) -> DataFrame:
    """Each order, and each of its lines as a later version of it."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("_ingested_at"), F.col("o_totalprice").alias("price"), "o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linestatus").alias("o_orderstatus"),
    )
    return orders.unionByName(lines)


@query("silver_dedup")
def silver_dedup(spark, sf_dir):
    return dedup_latest(order_versions(spark, sf_dir), "o_orderkey")


def order_changes(spark, sf_dir) -> DataFrame:
    """Orders with a returned line at a new price, and one new order per customer."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    changed = returned.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("o_totalprice"), F.lit("R").alias("o_orderstatus")
    )
    new = table(spark, sf_dir, "customer").select(
        (-1 - F.col("c_custkey")).alias("o_orderkey"),
        F.col("c_acctbal").alias("o_totalprice"),
        F.lit("N").alias("o_orderstatus"),
    )
    return changed.unionByName(new)


@query("silver_upsert")
def silver_upsert(spark, sf_dir):
    target = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return upsert(target, order_changes(spark, sf_dir), "o_orderkey")


@query("silver_merge")
def silver_merge(spark, sf_dir):
    """The table merged on disk: first run, changes, and the changes once more."""
    path, staged = work_path(spark, "silver"), work_path(spark, "staged")
    merge_silver(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path, "o_orderkey")
    order_changes(spark, sf_dir).write.parquet(staged)
    for _ in range(2):
        merge_silver(spark.read.parquet(staged), path, "o_orderkey")
    return read_silver(spark, path)


@query("gold_category")
def gold_category(spark, sf_dir):
    return gold.category_metrics(articles(spark, sf_dir))


@query("gold_author")
def gold_author(spark, sf_dir):
    return gold.author_metrics(articles(spark, sf_dir))


@query("gold_word_count")
def gold_word_count(spark, sf_dir):
    return gold.category_word_counts(articles(spark, sf_dir, spread_out=True))


@query("gold_daily")
def gold_daily(spark, sf_dir):
    return gold.daily_velocity(standardize(articles(spark, sf_dir)))


@query("append_enforced")
def gold_append_enforced(spark, sf_dir):
    """A fitting append is taken; extra, missing and retyped columns are refused."""
    path = work_path(spark, "gold")
    per_category = gold.category_metrics(articles(spark, sf_dir))
    per_category.write.parquet(path)
    bad = (
        per_category.withColumn("unauthorized_extra_column", F.lit("x")),
        per_category.drop("top_rating"),
        per_category.withColumn("total_articles", F.col("total_articles").cast("string")),
    )
    for rows in bad:
        try:
            append_enforced(rows, path)
        except SchemaMismatchError:
            continue
        raise AssertionError("a mismatched append was taken")
    append_enforced(per_category.withColumn("category", F.concat(F.lit("again-"), "category")), path)
    return spark.read.parquet(path)


@query("quality_gate")
def quality_gate(spark, sf_dir):
    return check_rows(articles(spark, sf_dir))


@query("quality_summary")
def quality_summary(spark, sf_dir):
    return summarize(check_rows(valid_rows(checked_articles(spark, sf_dir), ARTICLES)))


@query("lineage_events")
def lineage_rows(spark, sf_dir):
    """Events as stage records: errors fail a stage, signups start one, the rest complete it."""
    stages = table(spark, sf_dir, "events").select(
        F.concat(F.lit("job-"), "user_id").alias("job_name"),
        F.when(F.col("event_type") == "error", "fail")
        .when(F.col("event_type") == "signup", "start")
        .otherwise("complete")
        .alias("state"),
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        F.array(F.col("event_type")).alias("inputs"),
        F.lit(None).cast("array<string>").alias("outputs"),
    )
    event = lineage_events(stages)
    return event.select(
        "eventType",
        "eventTime",
        F.col("job.namespace").alias("job_namespace"),
        F.col("job.name").alias("job_name"),
        F.col("run.runId").alias("run_id"),
        F.array_join("inputs.name", ",").alias("inputs"),
        F.size("outputs").alias("n_outputs"),
        "producer",
    )


@query("medallion_gold")
def medallion_gold(spark, sf_dir):
    """The whole run on the articles as raw events; its category table."""
    root = work_path(spark, "medallion")
    medallion.run(as_json(articles(spark, sf_dir, spread_out=True)), root, 1, ARTICLES)
    return medallion.read_gold(spark, root, "category_metrics")


# Chunks and retrieval


@query("chunk_documents")
def chunk_texts(spark, sf_dir):
    return chunk_documents(articles(spark, sf_dir, spread_out=True)).select("chunk_id", "doc_id", "chunk_index", "text")


@query("chunk_citations")
def chunk_citations(spark, sf_dir):
    chunks = chunk_documents(articles(spark, sf_dir, spread_out=True), 200, 30)
    plain = chunk_documents(articles(spark, sf_dir, spread_out=True), 200, 30, style="plain")
    columns = ("chunk_id", "title", "author", "category", "citation_label")
    return chunks.select(*columns).unionByName(plain.select(*columns))


@query("embed_chunks")
def embed_chunks(spark, sf_dir):
    index = shared_index(spark, sf_dir)
    vectors = embed_column(index.chunks.select("chunk_id", "text"), index.embedder)
    weights = vectors.select("chunk_id", F.posexplode("embedding").alias("dimension", "weight"))
    return weights.where("weight <> 0").withColumn("weight", F.round(F.col("weight").cast("double"), 4))


@query("bm25_stats")
def bm25_stats(spark, sf_dir):
    index = shared_index(spark, sf_dir)
    stats = index.stats
    return term_table(index.frequencies, stats).select(
        "term",
        "df",
        F.round("idf", 9).alias("idf"),
        F.lit(stats.chunks).cast("long").alias("n_chunks"),
        F.round(F.lit(stats.avgdl), 9).alias("avgdl"),
        F.round(F.lit(stats.mean_idf), 9).alias("mean_idf"),
    )


@query("bm25_postings")
def bm25_postings(spark, sf_dir):
    """Of each term: chunks, occurrences, and the bounds of its blocks put together."""
    rows = shared_index(spark, sf_dir).postings.where(~is_size())
    entry = posting_entries(rows).groupBy("term")
    bounds = bound_entries(rows).groupBy("term").agg(F.max("most").alias("most"), F.min("least").alias("least"))
    counts = entry.agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("occurrences"))
    return counts.join(bounds, "term")


@query("bm25_topk")
def bm25_top(spark, sf_dir):
    return hits(search_bm25(shared_index(spark, sf_dir), questions(spark, sf_dir)))


@query("bm25_topk_blocks")
def bm25_top_blocks(spark, sf_dir):
    """The way for queries too large to broadcast: a bound just below their size."""
    index = shared_index(spark, sf_dir)
    weighted = weighted_queries(questions(spark, sf_dir), index.frequencies, index.stats)
    scorer = Bm25Scorer(index.stats.avgdl)
    return hits(topk_hits(index.chunks, weighted, scorer, 5, broadcast_bytes=measured_bytes(weighted) - 1))


@query("keyword_topk")
def keyword_top(spark, sf_dir):
    return hits(keyword_topk(shared_index(spark, sf_dir).chunks, questions(spark, sf_dir)))


@query("first_k")
def first_chunks(spark, sf_dir):
    return first_k(shared_index(spark, sf_dir).chunks, questions(spark, sf_dir))


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("V"), "vec_id").alias("chunk_id"),
        F.col("vec_id").alias("doc_id"),
        F.col("label").alias("chunk_index"),
        "embedding",
    )


def label_centroids(spark, sf_dir) -> DataFrame:
    """The mean vector of each label, as a query."""
    entries = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = entries.groupBy("label", "pos").agg(F.avg("x").alias("mean"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda e: e["mean"]).alias("embedding")
    )


@query("dense_topk")
def dense_top(spark, sf_dir):
    return hits(dense_topk(vectors(spark, sf_dir), label_centroids(spark, sf_dir)))


@query("dense_topk_blocks")
def dense_top_blocks(spark, sf_dir):
    """The same by blocks, as for queries too large to broadcast."""
    centroids = label_centroids(spark, sf_dir)
    return hits(dense_topk(vectors(spark, sf_dir), centroids, broadcast_bytes=measured_bytes(centroids) - 1))


@query("dense_topk_chunks")
def dense_top_chunks(spark, sf_dir):
    return hits(search_dense(shared_index(spark, sf_dir), questions(spark, sf_dir)))


@query("index_upsert")
def index_upsert(spark, sf_dir):
    """Vectors of French documents replaced by their negative, label centroids added."""
    target = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("V"), "vec_id").alias("chunk_id"), "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    french = table(spark, sf_dir, "documents").where("lang = 'fr'").select(F.col("doc_id").alias("vec_id"))
    changed = target.join(french, "vec_id", "left_semi").select(
        "chunk_id", "vec_id", F.transform("embedding", lambda x: -x).alias("embedding")
    )
    new = label_centroids(spark, sf_dir).select(
        F.concat(F.lit("L"), "query_id").alias("chunk_id"), F.col("query_id").cast("long").alias("vec_id"), "embedding"
    )
    merged = upsert(target, changed.unionByName(new), "chunk_id")
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return merged.select("chunk_id", "vec_id", F.round(total, 6).alias("total"), F.size("embedding").alias("width"))


@query("rrf_fuse")
def rrf_fused(spark, sf_dir):
    index, wanted = shared_index(spark, sf_dir), questions(spark, sf_dir)
    fused = rrf_fuse(search_dense(index, wanted), search_bm25(index, wanted))
    return hits(fused).select(
        "query_id", "chunk_id", "dense_rank", "bm25_rank", F.round("rrf_score", 9).alias("rrf_score"), "score", "rank"
    )


def hybrid(spark, sf_dir) -> DataFrame:
    return hybrid_search(shared_index(spark, sf_dir), questions(spark, sf_dir))


@query("hybrid_search")
def hybrid_top(spark, sf_dir):
    return hybrid(spark, sf_dir).select(
        "query_id",
        "chunk_id",
        "text",
        "citation_label",
        F.round("rrf_score", 9).alias("rrf_score"),
        F.round("rerank_score", 9).alias("rerank_score"),
        "final_rank",
    )


@query("rerank_keyword")
def reranked_candidates(spark, sf_dir):
    """All fused candidates in their reranked order."""
    candidates = fused_candidates(shared_index(spark, sf_dir), questions(spark, sf_dir))
    return rerank_keyword(candidates, 5).select(
        "query_id", "chunk_id", F.col("rank").alias("fused_rank"), F.round("rerank_score", 9).alias("rerank_score"), "final_rank"
    )


@query("rag_eval")
def retrieval_eval(spark, sf_dir):
    return retrieval_counts(hybrid(spark, sf_dir))


@query("grounded_answer")
def answers_cited(spark, sf_dir):
    answers = grounded_answers(hybrid(spark, sf_dir), questions(spark, sf_dir))
    return answers.select(
        "query_id",
        "query",
        "answer",
        F.array_join("citations.chunk_id", ",").alias("cited"),
        F.size("retrieved_chunks").alias("n_retrieved"),
        F.col("search_evaluation.rrf_fused_count").alias("rrf_fused_count"),
    )


@query("retrieval_compare")
def retrieval_compare(spark, sf_dir):
    compared = compare_methods(shared_index(spark, sf_dir), questions(spark, sf_dir))
    return compared.withColumn("mrr", F.round("mrr", 9))
