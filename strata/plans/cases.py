"""More registered queries: cases that the given rows do not have by themselves.

Payloads are broken, doubled, repeated or replayed by rules over the given ids; each
has its SQL twin here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.operators.answer import grounded_answers
from strata.operators.bm25 import term_table
from strata.operators.chunks import chunk_documents
from strata.operators.contract import ARTICLE_EVENT, check
from strata.operators.lineage import LineageLog
from strata.operators.quality import RECORD_SUITE, SILVER_SUITE, Expectation, QualityGateError, check_rows, summarize
from strata.plans import medallion
from strata.plans.catalog import ARTICLES, READING, hybrid, query, questions, shared_index
from strata.plans.oracle import ARTICLES as ARTICLES_SQL, CHECKED, CORPUS, HYBRID
from strata.plans.retrieval import build_index, hybrid_search, refresh_index
from strata.session import work_path
from strata.sources.articles import articles, as_json, table
from strata.sources.json_array import as_array
from strata.sources.readers import read_events, stream_lines
from strata.sources.silver import read_silver
from strata.sources.writers import read_quarantine, read_valid, write_split
from strata.streaming.contract_stream import quarantined, stream_silver

TWINS: dict[str, str] = {}


@query("contract_presence")
def contract_presence(spark, sf_dir):
    """Missing, null, mistyped and blank fields, broken JSON and JSON that is no object, by document number."""
    good = '"article_id": "A-', '"author": "Some Author", "category": "AI", "content": "long enough text", "views": 1, "rating": 1.5, "published_timestamp": "2026-01-01"'

    def payload(title: str):
        return F.concat(F.lit("{" + good[0]), F.col("doc_id"), F.lit(f'", {title}{good[1]}}}'))

    case = F.col("doc_id") % 7
    value = (
        F.when(case == 0, payload(""))
        .when(case == 1, payload('"title": null, '))
        .when(case == 2, payload('"title": 12, '))
        .when(case == 3, payload('"title": "ab", '))
        .when(case == 4, F.concat(F.lit('{"title": "'), F.col("doc_id")))
        .when(case == 5, F.concat(F.lit("["), F.col("doc_id"), F.lit("]")))
        .otherwise(payload('"title": "A title", '))
    )
    checked = check(table(spark, sf_dir, "documents").select("doc_id", value.alias("value")), ARTICLE_EVENT)
    return checked.select(
        "doc_id", F.array_join("_errors.field", ",").alias("fields"), F.array_join("_errors.message", "; ").alias("messages")
    )


TWINS["contract_presence"] = """
SELECT doc_id,
  CASE WHEN doc_id % 7 IN (4, 5) THEN 'unknown' WHEN doc_id % 7 < 4 THEN 'title' ELSE '' END AS fields,
  CASE doc_id % 7 WHEN 0 THEN 'Field required' WHEN 1 THEN 'Input should be a valid string'
    WHEN 2 THEN 'Input should be a valid string' WHEN 3 THEN 'String should have at least 3 characters'
    WHEN 6 THEN '' ELSE 'payload is not a JSON object' END AS messages
FROM documents"""


@query("contract_decimals")
def contract_decimals(spark, sf_dir):
    """Whole numbers beyond a double's digits, with and without a fraction."""
    key = (F.lit(9007199254740992) + F.col("event_id")).cast("string")
    value = F.concat(F.lit('{"amount": 1, "count": '), key, F.when(F.col("event_id") % 2 == 0, ".5").otherwise(".0"), F.lit("}"))
    checked = check(table(spark, sf_dir, "events").select("event_id", value.alias("value")), READING)
    return checked.select("event_id", "count", F.array_join("_errors.message", "; ").alias("messages"))


TWINS["contract_decimals"] = """
SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 9007199254740992 + event_id END AS count,
  CASE WHEN event_id % 2 = 0 THEN 'Input should be a valid integer, got a number with a fractional part' ELSE '' END AS messages
FROM events"""


@query("ingest_array")
def ingest_array(spark, sf_dir):
    """Events from indented array files, landed split."""
    files, landing = work_path(spark, "arrays"), work_path(spark, "landing")
    as_array(as_json(articles(spark, sf_dir, spread_out=True))).write.text(files)
    write_split(check(read_events(spark, files, "array"), ARTICLES), ARTICLES, landing, source_file="_source_file")
    valid = read_valid(spark, landing, ARTICLES).select(
        "article_id", F.lit("valid").alias("status"), F.lit(None).cast("string").alias("failed_field")
    )
    rejected = read_quarantine(spark, landing, ARTICLES).select(
        F.get_json_object("raw_payload", "$.article_id").alias("article_id"),
        F.lit("quarantined").alias("status"),
        "failed_field",
    )
    return valid.unionByName(rejected)


TWINS["ingest_array"] = f"""WITH {CHECKED}
SELECT article_id, CASE WHEN first_error IS NULL THEN 'valid' ELSE 'quarantined' END AS status, failed_field FROM judged"""


@query("quarantine_ids")
def quarantine_ids(spark, sf_dir):
    """Every payload twice in one batch, and the batch twice: as many ids as rejected rows."""
    root = work_path(spark, "doubled")
    events = as_json(articles(spark, sf_dir, spread_out=True))
    parts = []
    for batch in (1, 2):
        medallion.ingest(events.unionByName(events), ARTICLES, medallion.Layout(root), batch)
        parts.append(read_quarantine(spark, medallion.Layout(root).landing(batch), ARTICLES))
    rejected = parts[0].unionByName(parts[1])
    return rejected.groupBy("failed_field").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("quarantine_id").alias("n_ids")
    )


TWINS["quarantine_ids"] = f"""WITH {CHECKED}
SELECT failed_field, 4 * count(*) AS n_rows, 4 * count(*) AS n_ids FROM judged WHERE first_error IS NOT NULL GROUP BY ALL"""


def _streamed(spark, sf_dir) -> tuple[str, str]:
    """Silver and staging folder of a stream: the articles, then later versions of the French ones."""
    lines, silver, staging, checkpoint = (work_path(spark, n) for n in ("lines", "silver", "staging", "checkpoint"))
    rows = articles(spark, sf_dir, spread_out=True)
    later = rows.where("category = 'fr'").withColumns(
        {"views": F.col("views") + 5, "published_timestamp": F.lit("2030-01-01T00:00:00Z")}
    )
    for part in (rows, later):
        as_json(part).write.mode("append").text(lines)
        stream_silver(stream_lines(spark, lines, max_files=3), ARTICLES, silver, staging, checkpoint).awaitTermination()
    return silver, staging


@query("stream_silver_updates")
def stream_silver_updates(spark, sf_dir):
    silver, _ = _streamed(spark, sf_dir)
    return read_silver(spark, silver).select(*ARTICLES.columns)


TWINS["stream_silver_updates"] = f"""WITH {CHECKED}
SELECT article_id, title, author, category, content, views + CASE WHEN category = 'fr' THEN 5 ELSE 0 END AS views, rating,
  CASE WHEN category = 'fr' THEN TIMESTAMP '2030-01-01' ELSE published END AS published_timestamp
FROM judged WHERE first_error IS NULL"""


@query("stream_silver_quarantine")
def stream_silver_quarantine(spark, sf_dir):
    """What the stream-fed silver table rejected."""
    _, staging = _streamed(spark, sf_dir)
    return quarantined(spark, ARTICLES, staging).select(
        F.get_json_object("raw_payload", "$.article_id").alias("article_id"), "failed_field"
    )


TWINS["stream_silver_quarantine"] = f"""WITH {CHECKED}, rejected AS (FROM judged WHERE first_error IS NOT NULL)
SELECT article_id, failed_field FROM rejected UNION ALL SELECT article_id, failed_field FROM rejected WHERE category = 'fr'"""


def _batches(spark, sf_dir, batches: list[tuple[int, DataFrame]]) -> DataFrame:
    """Silver after some batches went through ingest, bronze and silver."""
    layout, settings = medallion.Layout(work_path(spark, "batches")), medallion.Settings()
    for batch, events in batches:
        medallion.ingest(as_json(events), ARTICLES, layout, batch)
        valid = read_valid(spark, layout.landing(batch), ARTICLES, with_source=True)
        medallion.load_bronze(valid, layout, batch, settings)
        medallion.load_silver(spark, ARTICLES, layout, batch, settings)
    return read_silver(spark, layout.at("silver")).select("article_id", "views", "title")


@query("silver_versions")
def silver_versions(spark, sf_dir):
    """Three versions of each article in one batch; the one published last has the least text and number."""
    rows = articles(spark, sf_dir, spread_out=True)
    early = rows.withColumns({"views": F.col("views") + 100, "title": F.concat(F.lit("Zeta "), "title")})
    late = rows.withColumns({"title": F.concat(F.lit("Alpha "), "title"), "published_timestamp": F.lit("2030-01-01T00:00:00Z")})
    middle = early.withColumns({"views": F.col("views") + 100, "published_timestamp": F.lit("2029-01-01T00:00:00Z")})
    return _batches(spark, sf_dir, [(1, late.unionByName(early).unionByName(middle))])


TWINS["silver_versions"] = f"""WITH {CHECKED}
SELECT article_id, views, 'Alpha ' || title AS title FROM judged
WHERE coalesce(e_author, e_category, e_content, e_views, e_rating) IS NULL"""


@query("silver_replay")
def silver_replay(spark, sf_dir):
    """Batches 1, 2 and 1 again: as after 1 and 2."""
    rows = articles(spark, sf_dir, spread_out=True)
    changed = rows.where("category = 'de'").withColumn("views", F.col("views") + 7)
    return _batches(spark, sf_dir, [(1, rows), (2, changed), (1, rows)])


TWINS["silver_replay"] = f"""WITH {CHECKED}
SELECT article_id, views + CASE WHEN category = 'de' THEN 7 ELSE 0 END AS views, title FROM judged WHERE first_error IS NULL"""


@query("index_refresh")
def index_refresh(spark, sf_dir):
    """An index whose French documents changed, whose Spanish ones went and which is then refreshed."""
    path = work_path(spark, "index")
    rows = articles(spark, sf_dir, spread_out=True)
    build_index(chunk_documents(rows), path)
    changed = rows.where("category = 'fr'").withColumn("content", F.concat(F.lit("renewed text "), "content"))
    gone = rows.where("category IN ('fr', 'es')").select(F.col("article_id").alias("doc_id"))
    index = refresh_index(chunk_documents(changed), gone, path)
    stats = index.stats
    return term_table(index.frequencies, stats).select(
        "term", "df", F.round("idf", 9).alias("idf"), F.lit(stats.chunks).cast("long").alias("n_chunks"),
        F.round(F.lit(stats.avgdl), 9).alias("avgdl"),
    )


_REFRESHED = CORPUS.replace("FROM documents d LEFT JOIN", "FROM kept d LEFT JOIN")
assert _REFRESHED != CORPUS
TWINS["index_refresh"] = f"""WITH kept AS (
  SELECT * REPLACE (CASE WHEN lang = 'fr' THEN 'renewed text ' || text ELSE text END AS text)
  FROM documents WHERE lang <> 'es'), {_REFRESHED}
SELECT term, df, round(idf, 9) AS idf, n AS n_chunks, round(avgdl, 9) AS avgdl FROM terms CROSS JOIN scalars"""


@query("quality_failing")
def quality_failing(spark, sf_dir):
    """The gate over lines whose key repeats, is missing or is out of range."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 3, F.col("l_orderkey").cast("string")).alias("article_id"),
        (F.col("l_quantity") - 5).alias("views"),
        (F.col("l_discount") * 60).alias("rating"),
    )
    return summarize(check_rows(rows, SILVER_SUITE))


TWINS["quality_failing"] = """
WITH rows_in AS (
  SELECT CASE WHEN l_linenumber <> 3 THEN l_orderkey END AS k, l_quantity - 5 AS v, l_discount * 60 AS r FROM lineitem),
checks AS (
  SELECT count(*) AS n, unnest([count(*) FILTER (k IS NULL), count(k) - count(DISTINCT k), count(*) FILTER (v < 0),
    count(*) FILTER (r < 0 OR r > 5), 0]) AS bad FROM rows_in)
SELECT max(n) AS dataset_row_count, count(*) AS total_checks, count(*) FILTER (bad = 0) AS passed_checks,
  count(*) FILTER (bad <> 0) AS failed_checks, bool_and(bad = 0) AS quality_gate_passed,
  CASE WHEN bool_and(bad = 0) THEN 'All checks passed' ELSE 'Data quality violations detected' END AS details
FROM checks"""


@query("quality_records")
def quality_records(spark, sf_dir):
    """The second suite over the articles as records."""
    rows = articles(spark, sf_dir).select(
        "article_id",
        F.size(F.split("content", " ")).cast("long").alias("word_count"),
        F.when(F.col("category") != "es", F.col("published_timestamp")).otherwise(F.lit("not a time")).alias("published_at"),
    )
    return check_rows(rows, RECORD_SUITE).select("check_number", "unexpected_count", "passed")


TWINS["quality_records"] = f"""WITH {ARTICLES_SQL},
counts AS (SELECT unnest([0, 0, count(*) FILTER (len(string_split(content, ' ')) NOT BETWEEN 1 AND 100000),
    count(*) FILTER (category = 'es')]) AS unexpected_count, unnest([1, 2, 3, 4])::INTEGER AS check_number FROM articles)
SELECT check_number, unexpected_count, unexpected_count = 0 AS passed FROM counts"""


@query("lineage_emitted")
def lineage_emitted(spark, sf_dir):
    """One event emitted for each event type, read back from its folder."""
    log = LineageLog(spark, work_path(spark, "lineage"))
    kinds = table(spark, sf_dir, "events").groupBy("event_type").count().collect()  # a handful of types
    for r in kinds:
        log.emit(f"job-{r['event_type']}", "complete", f"run-{r['count']}", [r["event_type"]], ["out", "more"])
    return log.read().select(
        "eventType", F.col("job.name").alias("job_name"), F.col("run.runId").alias("run_id"),
        F.array_join("inputs.name", ",").alias("inputs"), F.array_join("outputs.name", ",").alias("outputs"), "producer",
    )


TWINS["lineage_emitted"] = """
SELECT 'COMPLETE' AS eventType, 'job-' || event_type AS job_name, 'run-' || count(*) AS run_id, event_type AS inputs,
  'out,more' AS outputs, 'strata' AS producer FROM events GROUP BY event_type"""


@query("answers_without_hits")
def answers_without_hits(spark, sf_dir):
    """Every third query finds nothing; of the rest some chunks lack title and author."""
    found = hybrid(spark, sf_dir).where("query_id % 3 <> 0")
    bare = found.withColumns(
        {c: F.when(F.col("query_id") % 3 == 1, F.col(c)) for c in ("title", "author", "doc_id", "chunk_id", "text")}
    )
    answers = grounded_answers(bare, questions(spark, sf_dir))
    return answers.select("query_id", "answer", F.size("citations").alias("n_citations"))


TWINS["answers_without_hits"] = HYBRID + """, built AS (
  SELECT query_id,
    string_agg('Key Excerpt ' || final_rank || ': "' || CASE WHEN query_id % 3 = 1 THEN text ELSE '' END || '" [' || final_rank || ']',
      chr(10) || chr(10) ORDER BY final_rank) AS excerpts,
    string_agg('  - [' || final_rank || '] Document ''' || CASE WHEN query_id % 3 = 1 THEN title ELSE 'Untitled Document' END
      || ''' by ' || CASE WHEN query_id % 3 = 1 THEN author ELSE 'Unknown Author' END
      || ' (ID: ' || CASE WHEN query_id % 3 = 1 THEN doc_id ELSE 'DOC-UNKNOWN' END
      || ', Chunk: ' || CASE WHEN query_id % 3 = 1 THEN chunk_id ELSE 'C0' END || ')', chr(10) ORDER BY final_rank) AS refs,
    count(*) AS n FROM reranked WHERE query_id % 3 <> 0 GROUP BY query_id)
SELECT query_id,
  CASE WHEN n IS NULL THEN 'No relevant context documents were found in the knowledge base to answer this query.'
  ELSE '### Query Response' || chr(10) || 'Based strictly on the retrieved knowledge base documents:' || chr(10) || chr(10)
    || excerpts || chr(10) || chr(10) || '### Referenced Citations' || chr(10) || refs END AS answer,
  coalesce(n, 0)::INTEGER AS n_citations
FROM questions LEFT JOIN built USING (query_id)"""


@query("rerank_model")
def rerank_by_model(spark, sf_dir):
    """The full query with a model's scores in the place of the keyword rule; the model prefers long texts."""

    @F.pandas_udf("double")
    def longer(query, text):
        return (text.str.len() - query.str.len()).astype(float)

    found = hybrid_search(shared_index(spark, sf_dir), questions(spark, sf_dir), scorer=longer)
    return found.select("query_id", "chunk_id", "rerank_score", "final_rank")


TWINS["rerank_model"] = HYBRID + """, modelled AS (
  SELECT f.query_id, f.chunk_id, f.rank, (length(c.text) - length(q.query))::DOUBLE AS rerank_score
  FROM fused f JOIN chunks c USING (chunk_id) JOIN questions q USING (query_id))
SELECT query_id, chunk_id, rerank_score,
  (row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank))::INTEGER AS final_rank
FROM modelled QUALIFY final_rank <= 3"""


@query("quality_halt")
def quality_halt(spark, sf_dir):
    """A run whose gate allows fewer views than some articles have: it stops before gold and index."""
    root = work_path(spark, "halted")
    suite = (*SILVER_SUITE, Expectation("between", "views", high=1000))
    try:
        medallion.run(as_json(articles(spark, sf_dir)), root, 1, ARTICLES, suite)
        summary = None
    except QualityGateError as error:
        summary = error.summary
    silver = read_silver(spark, f"{root}/silver")
    gold_written = medallion.read_gold(spark, root, "category_metrics") is not None
    return silver.agg(F.count(F.lit(1)).alias("silver_rows"), F.count_if(F.col("views") > 1000).alias("beyond")).select(
        "silver_rows", "beyond", F.lit(summary is not None).alias("halted"),
        F.lit(summary["failed_checks"] if summary else 0).cast("long").alias("failed_checks"),
        F.lit(gold_written).alias("gold_written"),
    )


TWINS["quality_halt"] = f"""WITH {CHECKED}, counted AS (
  SELECT count(*) AS silver_rows, count(*) FILTER (views > 1000) AS beyond FROM judged WHERE first_error IS NULL)
SELECT silver_rows, beyond, beyond > 0 AS halted, (beyond > 0)::BIGINT AS failed_checks, beyond = 0 AND silver_rows > 0 AS gold_written
FROM counted"""
