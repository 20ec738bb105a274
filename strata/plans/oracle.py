"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

# Fixed value: the whitespace characters as a class for RE2, which has no (?U).
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

ARTICLES = """
articles AS (
  SELECT 'ART-' || d.doc_id AS article_id, split_part(d.text, chr(10), 1) AS title, d.source AS author,
         d.lang AS category, d.text AS content, d.n_chars AS views,
         coalesce(l.quality, 0) * 5.0::DOUBLE - coalesce(l.toxic, 0) * 1.0::DOUBLE AS rating,
         TIMESTAMP '2024-01-01' + to_minutes(d.doc_id) AS published,
         strftime(TIMESTAMP '2024-01-01' + to_minutes(d.doc_id), '%Y-%m-%dT%H:%M:%SZ') AS published_timestamp
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

# One column per contract field with its first broken rule, in declared order.
CHECKED = (
    ARTICLES
    + """,
checked AS (
  SELECT *,
    CASE WHEN length(title) < 3 THEN 'String should have at least 3 characters' END AS e_title,
    CASE WHEN length(author) < 2 THEN 'String should have at least 2 characters' END AS e_author,
    CASE WHEN category NOT IN ('de', 'en', 'fr') THEN 'Value error, Category ''' || category
         || ''' is not in allowed list: [''de'', ''en'', ''fr'']' END AS e_category,
    CASE WHEN length(content) < 10 THEN 'String should have at least 10 characters' END AS e_content,
    CASE WHEN views < 0 THEN 'Input should be greater than or equal to 0' END AS e_views,
    CASE WHEN rating < 0 THEN 'Input should be greater than or equal to 0'
         WHEN rating > 5 THEN 'Input should be less than or equal to 5' END AS e_rating
  FROM articles),
judged AS (
  SELECT *,
    coalesce(e_title, e_author, e_category, e_content, e_views, e_rating) AS first_error,
    CASE WHEN e_title IS NOT NULL THEN 'title' WHEN e_author IS NOT NULL THEN 'author'
         WHEN e_category IS NOT NULL THEN 'category' WHEN e_content IS NOT NULL THEN 'content'
         WHEN e_views IS NOT NULL THEN 'views' WHEN e_rating IS NOT NULL THEN 'rating' END AS failed_field
  FROM checked)"""
)

VALID_COLUMNS = "article_id, title, author, category, content, views, rating, published_timestamp"


def chunks_cte(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
cut AS (
  SELECT article_id AS doc_id, title, author, category, content,
         unnest(range(0, greatest(0, ceil((length(content) - {size}) / {step}.0)::BIGINT) + 1)) AS i
  FROM articles WHERE length(content) > 0),
chunks AS (
  SELECT doc_id || '_C' || i AS chunk_id, doc_id, i::INTEGER AS chunk_index, title, author, category,
         regexp_replace(substr(content, i * {step} + 1, {size}), '\\A{WHITESPACE}+|{WHITESPACE}+\\z', '', 'g') AS text,
         '[Doc ID: ' || doc_id || ', Chunk: ' || i || ' | ''' || substr(title, 1, 35) || '...'' by ' || author || ']'
           AS citation_label
  FROM cut)"""


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{WHITESPACE}+'), lambda t: t <> '')"


CORPUS = (
    ARTICLES
    + ","
    + chunks_cte(500, 50)
    + f""",
lists AS MATERIALIZED (SELECT chunk_id, doc_id, chunk_index, {words('text')} AS tokens FROM chunks),
sizes AS MATERIALIZED (SELECT chunk_id, doc_id, chunk_index, len(tokens) AS dl FROM lists),
tf AS MATERIALIZED (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(tokens) AS term FROM lists) GROUP BY ALL),
scalars AS MATERIALIZED (SELECT count(*) AS n, avg(dl) AS avgdl FROM sizes),
counted AS MATERIALIZED (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS MATERIALIZED (
  SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS idf FROM counted CROSS JOIN scalars),
mean AS MATERIALIZED (SELECT avg(idf) AS mean_idf FROM raw),
terms AS (
  SELECT term, df, CASE WHEN idf < 0 THEN 0.25::DOUBLE * mean_idf ELSE idf END AS idf FROM raw CROSS JOIN mean),
questions AS (SELECT item_id AS query_id, text AS query FROM benchmark),
asked AS (SELECT query_id, unnest({words('query')}) AS term FROM questions)"""
)

GRID = ", grid AS (SELECT query_id, chunk_id, doc_id, chunk_index FROM questions, sizes)"


def ranked(name: str, scored: str, k: int = 5) -> str:
    """The k best rows per query of a (query_id, chunk_id, doc_id, chunk_index, raw_score) select."""
    return f""", {name} AS (
  SELECT query_id, chunk_id, doc_id, chunk_index, round(raw_score, 6) AS score,
         (row_number() OVER (PARTITION BY query_id ORDER BY round(raw_score, 9) DESC, doc_id, chunk_index))::INTEGER AS rank
  FROM ({scored}) QUALIFY rank <= {k})"""


BM25 = ranked(
    "bm25",
    """
  SELECT query_id, chunk_id, doc_id, chunk_index, coalesce(part, 0::DOUBLE) AS raw_score
  FROM grid LEFT JOIN (
    SELECT query_id, chunk_id,
           sum(times * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS part
    FROM (SELECT query_id, term, count(*) AS times FROM asked GROUP BY ALL)
    JOIN terms USING (term) JOIN tf USING (term) JOIN sizes USING (chunk_id), scalars
    GROUP BY ALL) USING (query_id, chunk_id)""",
)

KEYWORD = ranked(
    "keyword",
    """
  SELECT query_id, chunk_id, doc_id, chunk_index, count(*) FILTER (contains(low, term))::DOUBLE AS raw_score
  FROM asked, (SELECT chunk_id, doc_id, chunk_index, lower(text) AS low FROM chunks)
  GROUP BY ALL""",
)


def unit_vectors(name: str, key: str, text_rows: str) -> str:
    """Hashed unit vectors as (key, bucket, w) rows of (key, term) rows."""
    return f""",
{name}_counts AS (
  SELECT {key}, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS bucket, count(*) AS c FROM ({text_rows}) GROUP BY ALL),
{name} AS (
  SELECT {key}, bucket, (c / sqrt(sum(c * c) OVER (PARTITION BY {key})::DOUBLE))::FLOAT::DOUBLE AS w FROM {name}_counts)"""


CHUNK_VECTORS = unit_vectors("chunk_vectors", "chunk_id", "SELECT chunk_id, unnest(tokens) AS term FROM lists")

DENSE = (
    CHUNK_VECTORS
    + unit_vectors("query_vectors", "query_id", "FROM asked")
    + ranked(
        "dense",
        """
  SELECT query_id, chunk_id, doc_id, chunk_index,
         coalesce(dot / (query_norm * chunk_norm + 1e-9::DOUBLE), 0::DOUBLE) AS raw_score
  FROM grid
  LEFT JOIN (SELECT query_id, chunk_id, sum(q.w * c.w) AS dot
             FROM query_vectors q JOIN chunk_vectors c USING (bucket) GROUP BY ALL) USING (query_id, chunk_id)
  LEFT JOIN (SELECT query_id, sqrt(sum(w * w)) AS query_norm FROM query_vectors GROUP BY ALL) USING (query_id)
  LEFT JOIN (SELECT chunk_id, sqrt(sum(w * w)) AS chunk_norm FROM chunk_vectors GROUP BY ALL) USING (chunk_id)""",
    )
)

FUSED = """,
fused_all AS (
  SELECT query_id, chunk_id, d.rank AS dense_rank, b.rank AS bm25_rank, coalesce(b.score, d.score) AS score,
         coalesce(1.0::DOUBLE / (60 + d.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0) AS rrf_score
  FROM dense d FULL JOIN bm25 b USING (query_id, chunk_id)),
fused AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id
              ORDER BY rrf_score DESC, dense_rank NULLS LAST, bm25_rank NULLS LAST))::INTEGER AS rank
  FROM fused_all QUALIFY rank <= 5)"""

MATCHES = f"""len(list_filter(list_distinct({words('query')}), lambda w: contains(lower(text), w)))"""

RERANKED = f""",
scored AS (
  SELECT query_id, query, chunk_id, doc_id, title, author, text, citation_label, rank, dense_rank, bm25_rank, rrf_score,
         rrf_score + {MATCHES} * 0.1::DOUBLE AS rerank_score
  FROM fused JOIN chunks USING (chunk_id) JOIN questions USING (query_id)),
reordered AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank))::INTEGER AS final_rank
  FROM scored),
reranked AS (FROM reordered WHERE final_rank <= 3)"""

HYBRID = "WITH " + CORPUS + GRID + BM25 + DENSE + FUSED + RERANKED

CENTROIDS = """
entries AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
centroids AS (
  SELECT label, list(mean ORDER BY pos) AS v
  FROM (SELECT label, pos, avg(x) AS mean FROM entries GROUP BY ALL) GROUP BY label)"""

CENTROID_TOP = (
    "WITH "
    + CENTROIDS
    + ranked(
        "nearest",
        """
  SELECT c.label AS query_id, 'V' || e.vec_id AS chunk_id, e.vec_id AS doc_id, e.label AS chunk_index,
         list_dot_product(e.embedding::DOUBLE[], c.v)
           / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(c.v, c.v)) + 1e-9::DOUBLE)
           AS raw_score
  FROM embeddings e, centroids c""",
    )
    + " SELECT query_id, chunk_id, doc_id, chunk_index, score, rank FROM nearest"
)

HIT_COLUMNS = "query_id, chunk_id, doc_id, chunk_index, score, rank"
BM25_TOP = "WITH " + CORPUS + GRID + BM25 + f" SELECT {HIT_COLUMNS} FROM bm25"

CATEGORY = """
  SELECT category, count(article_id) AS total_articles, sum(views)::BIGINT AS total_category_views,
         avg(views) AS avg_views_per_article, avg(rating) AS avg_category_rating, max(rating) AS top_rating
  FROM {source} GROUP BY category"""

ORDER_CHANGES = """
changes AS (
  SELECT l_orderkey AS o_orderkey, max(l_extendedprice) AS o_totalprice, 'R' AS o_orderstatus
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
  UNION ALL SELECT -1 - c_custkey, c_acctbal, 'N' FROM customer)"""

ORDERS_UPSERTED = f"""WITH {ORDER_CHANGES}
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)
UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM changes"""


def failures(fields: tuple[str, ...], starting: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT article_id, '{f}' AS field, e_{f} AS message FROM checked WHERE e_{f} LIKE '{starting}%'" for f in fields
    )
    return f"WITH {CHECKED} {parts}"


def gate_checks(source: str) -> str:
    return f"""
  SELECT unnest([
    {{'check_number': 1, 'check_name': 'not_null(article_id)', 'unexpected_count': count(*) FILTER (article_id IS NULL)}},
    {{'check_number': 2, 'check_name': 'unique(article_id)', 'unexpected_count': count(article_id) - count(DISTINCT article_id)}},
    {{'check_number': 3, 'check_name': 'between(views)', 'unexpected_count': count(*) FILTER (views < 0)}},
    {{'check_number': 4, 'check_name': 'between(rating)', 'unexpected_count': count(*) FILTER (rating < 0 OR rating > 5)}},
    {{'check_number': 5, 'check_name': 'row_count', 'unexpected_count': (count(*) < 1)::BIGINT}}
  ], recursive := true), count(*) AS dataset_row_count FROM {source}"""


ORACLE: dict[str, str] = {
    "ingest_json": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "contract_valid": f"WITH {CHECKED} SELECT {VALID_COLUMNS} FROM judged WHERE first_error IS NULL",
    "contract_quarantine": f"""WITH {CHECKED}
SELECT article_id, failed_field, 'Validation Failed: ' || first_error AS rejection_reason, content
FROM judged WHERE first_error IS NOT NULL""",
    "contract_all_failures": f"""WITH {CHECKED}
SELECT article_id, concat_ws(',', CASE WHEN e_title IS NOT NULL THEN 'title' END, CASE WHEN e_author IS NOT NULL THEN 'author' END,
  CASE WHEN e_category IS NOT NULL THEN 'category' END, CASE WHEN e_content IS NOT NULL THEN 'content' END,
  CASE WHEN e_views IS NOT NULL THEN 'views' END, CASE WHEN e_rating IS NOT NULL THEN 'rating' END) AS failed_fields
FROM judged WHERE first_error IS NOT NULL""",
    "contract_length": failures(("title", "author", "content"), "String should have"),
    "contract_range": failures(("views", "rating"), "Input should be"),
    "contract_enum": failures(("category",), "Value error"),
    "contract_coerce": """
WITH coerced AS (
  SELECT event_id,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_id END AS count,
    CASE event_type WHEN 'view' THEN value WHEN 'click' THEN value WHEN 'purchase' THEN 1.0::DOUBLE END AS amount,
    CASE event_type
      WHEN 'signup' THEN 'Input should be a valid integer, got a number with a fractional part'
      WHEN 'error' THEN 'Input should be a valid integer, unable to parse string as an integer' END AS m_count,
    CASE WHEN event_type = 'signup' THEN 'Input should be a valid number'
         WHEN event_type = 'error' THEN 'Input should be a valid number, unable to parse string as a number'
         WHEN event_type IN ('view', 'click') AND value > 400 THEN 'Input should be less than or equal to 400' END AS m_amount
  FROM events)
SELECT event_id, count, amount, concat_ws('; ', m_count, m_amount) AS messages FROM coerced""",
    "contract_timestamp": """
SELECT event_id,
  CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 'click' THEN strftime(ts, '%Y-%m-%d')
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || ',5+02:00'
    ELSE strftime(ts, '%d/%m/%Y') END AS stamp,
  CASE event_type WHEN 'view' THEN date_trunc('second', ts) WHEN 'click' THEN date_trunc('day', ts)::TIMESTAMP
    WHEN 'purchase' THEN date_trunc('minute', ts)
    WHEN 'signup' THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND - INTERVAL 2 HOUR END AS parsed,
  event_type <> 'error' AS accepted
FROM events""",
    "contract_record": f"""WITH {ARTICLES},
records AS (SELECT *, md5(article_id) AS h, len(string_split(content, ' ')) - 3 AS word_count FROM articles),
judged AS (
  SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) AS article_id,
    CASE WHEN length(title) < 5 THEN 'title' WHEN length(content) < 10 THEN 'content'
         WHEN category NOT IN ('de', 'en', 'fr') THEN 'category' WHEN word_count < 1 THEN 'word_count' END AS field_failed,
    CASE WHEN length(title) < 5 THEN 'String should have at least 5 characters'
         WHEN length(content) < 10 THEN 'String should have at least 10 characters'
         WHEN category NOT IN ('de', 'en', 'fr') THEN 'Value error, Category ''' || category
           || ''' is not in allowed list: [''de'', ''en'', ''fr'']'
         WHEN word_count < 1 THEN 'Input should be greater than or equal to 1' END AS error_message
  FROM records)
SELECT article_id, 'ValidationError' AS error_type, field_failed, error_message FROM judged WHERE field_failed IS NOT NULL""",
    "ingest_counts": f"""WITH {CHECKED}
SELECT count(*) AS total_processed, count(*) FILTER (first_error IS NULL) AS valid_count,
       count(*) FILTER (first_error IS NOT NULL) AS quarantine_count FROM judged""",
    "landing_split": f"""WITH {CHECKED}
SELECT article_id, CASE WHEN first_error IS NULL THEN 'valid' ELSE 'quarantined' END AS status, failed_field FROM judged""",
    "stream_contract": f"WITH {CHECKED} SELECT {VALID_COLUMNS} FROM judged WHERE first_error IS NULL",
    "stream_silver_upsert": f"""WITH {CHECKED}
SELECT article_id, title, author, category, content, views, rating, published AS published_timestamp
FROM judged WHERE first_error IS NULL""",
    "bronze_append": """
SELECT event_id, event_type, value, ts::DATE AS ingestion_date, 'events' AS _source, batch AS _batch_id
FROM events, (SELECT unnest([1, 2])::BIGINT AS batch)""",
    "bronze_incremental": "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderdate::DATE AS day FROM orders",
    "silver_standardize": """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS views,
  CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS rating,
  CASE o_orderstatus WHEN 'F' THEN date_trunc('minute', o_orderdate)
    WHEN 'O' THEN date_trunc('day', o_orderdate)::TIMESTAMP END AS published_timestamp
FROM orders""",
    "silver_dedup": """
WITH versions AS (
  SELECT o_orderkey, o_orderdate AS _ingested_at, o_totalprice AS price, o_orderstatus FROM orders
  UNION ALL SELECT l_orderkey, l_shipdate, l_extendedprice, l_linestatus FROM lineitem)
SELECT * FROM versions QUALIFY row_number() OVER (
  PARTITION BY o_orderkey ORDER BY _ingested_at DESC, price DESC, o_orderstatus DESC) = 1""",
    "silver_upsert": ORDERS_UPSERTED,
    "silver_merge": ORDERS_UPSERTED,
    "gold_category": f"WITH {ARTICLES} {CATEGORY.format(source='articles')}",
    "gold_author": f"""WITH {ARTICLES}
SELECT author, count(article_id) AS published_articles_count, avg(rating) AS author_avg_rating,
       sum(views)::BIGINT AS author_total_reach FROM articles GROUP BY author""",
    "gold_word_count": f"""WITH {ARTICLES}
SELECT category, count(article_id) AS total_articles, avg(len({words('content')})) AS avg_word_count
FROM articles GROUP BY category""",
    "gold_daily": f"""WITH {ARTICLES}
SELECT published::DATE AS published_date, count(article_id) AS published_articles FROM articles GROUP BY ALL""",
    "append_enforced": f"""WITH {ARTICLES}, metrics AS ({CATEGORY.format(source='articles')})
FROM metrics UNION ALL SELECT 'again-' || category, * EXCLUDE (category) FROM metrics""",
    "quality_gate": f"""WITH {ARTICLES}, checks AS ({gate_checks('articles')})
SELECT dataset_row_count, check_number, check_name, unexpected_count, unexpected_count = 0 AS passed FROM checks""",
    "quality_summary": f"""WITH {CHECKED}, rows_kept AS (FROM judged WHERE first_error IS NULL),
checks AS ({gate_checks('rows_kept')})
SELECT max(dataset_row_count) AS dataset_row_count, count(*) AS total_checks,
  count(*) FILTER (unexpected_count = 0) AS passed_checks, count(*) FILTER (unexpected_count <> 0) AS failed_checks,
  bool_and(unexpected_count = 0) AND max(dataset_row_count) > 0 AS quality_gate_passed,
  CASE WHEN max(dataset_row_count) = 0 THEN 'FAILED_EMPTY' WHEN bool_and(unexpected_count = 0) THEN 'All checks passed'
       ELSE 'Data quality violations detected' END AS details
FROM checks""",
    "lineage_events": """
SELECT CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'START' ELSE 'COMPLETE' END AS eventType,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS eventTime, 'strata' AS job_namespace, 'job-' || user_id AS job_name,
  'run-' || event_id AS run_id, event_type AS inputs, 0 AS n_outputs, 'strata' AS producer
FROM events""",
    "medallion_gold": f"""WITH {CHECKED}, silver AS (FROM judged WHERE first_error IS NULL)
{CATEGORY.format(source='silver')}""",
    "chunk_documents": f"WITH {ARTICLES}, {chunks_cte(500, 50)} SELECT chunk_id, doc_id, chunk_index, text FROM chunks",
    "chunk_citations": f"""WITH {ARTICLES}, {chunks_cte(200, 30)}
SELECT chunk_id, title, author, category, citation_label FROM chunks
UNION ALL SELECT chunk_id, title, author, category, '[Article ID: ' || doc_id || ', Chunk: ' || chunk_id || ']' FROM chunks""",
    "embed_chunks": f"""WITH {CORPUS} {CHUNK_VECTORS}
SELECT chunk_id, bucket::INTEGER AS dimension, round(w, 4) AS weight FROM chunk_vectors""",
    "bm25_stats": f"""WITH {CORPUS}
SELECT term, df, round(idf, 9) AS idf, n AS n_chunks, round(avgdl, 9) AS avgdl, round(mean_idf, 9) AS mean_idf
FROM terms CROSS JOIN scalars CROSS JOIN mean""",
    "bm25_postings": f"""WITH {CORPUS}
SELECT term, count(*) AS df, sum(tf)::BIGINT AS occurrences, max(tf)::INTEGER AS most, min(dl)::INTEGER AS least
FROM tf JOIN sizes USING (chunk_id) GROUP BY term""",
    "bm25_topk": BM25_TOP,
    "bm25_topk_blocks": BM25_TOP,
    "keyword_topk": "WITH " + CORPUS + KEYWORD + f" SELECT {HIT_COLUMNS} FROM keyword",
    "first_k": f"""WITH {CORPUS}, firsts AS (
  SELECT chunk_id, doc_id, chunk_index, (row_number() OVER (ORDER BY doc_id, chunk_index))::INTEGER AS rank
  FROM chunks QUALIFY rank <= 5)
SELECT query_id, chunk_id, doc_id, chunk_index, rank FROM questions, firsts""",
    "dense_topk": CENTROID_TOP,
    "dense_topk_blocks": CENTROID_TOP,
    "dense_topk_chunks": "WITH " + CORPUS + GRID + DENSE + f" SELECT {HIT_COLUMNS} FROM dense",
    "index_upsert": f"""WITH {CENTROIDS},
french AS (SELECT doc_id FROM documents WHERE lang = 'fr')
SELECT 'V' || vec_id AS chunk_id, vec_id,
  round(list_sum(embedding::DOUBLE[]) * CASE WHEN vec_id IN (FROM french) THEN -1 ELSE 1 END, 6) AS total,
  len(embedding)::INTEGER AS width
FROM embeddings
UNION ALL SELECT 'L' || label, label::BIGINT, round(list_sum(v), 6), len(v)::INTEGER FROM centroids""",
    "rrf_fuse": "WITH "
    + CORPUS
    + GRID
    + BM25
    + DENSE
    + FUSED
    + " SELECT query_id, chunk_id, dense_rank, bm25_rank, round(rrf_score, 9) AS rrf_score, score, rank FROM fused",
    "hybrid_search": HYBRID
    + """ SELECT query_id, chunk_id, text, citation_label, round(rrf_score, 9) AS rrf_score,
  round(rerank_score, 9) AS rerank_score, final_rank FROM reranked""",
    "rerank_keyword": HYBRID
    + " SELECT query_id, chunk_id, rank AS fused_rank, round(rerank_score, 9) AS rerank_score, final_rank FROM reordered",
    "rag_eval": HYBRID
    + """ SELECT query_id, (SELECT count(*) FROM dense d WHERE d.query_id = r.query_id) AS dense_hits_count,
  (SELECT count(*) FROM bm25 b WHERE b.query_id = r.query_id) AS bm25_hits_count,
  (SELECT count(*) FROM fused f WHERE f.query_id = r.query_id) AS rrf_fused_count,
  count(*) AS final_reranked_count FROM reranked r GROUP BY query_id""",
    "grounded_answer": HYBRID
    + """, built AS (
  SELECT query_id,
    string_agg('Key Excerpt ' || final_rank || ': "' || text || '" [' || final_rank || ']', chr(10) || chr(10) ORDER BY final_rank) AS excerpts,
    string_agg('  - [' || final_rank || '] Document ''' || title || ''' by ' || author || ' (ID: ' || doc_id || ', Chunk: '
      || chunk_id || ')', chr(10) ORDER BY final_rank) AS refs,
    string_agg(chunk_id, ',' ORDER BY final_rank) AS cited, count(*) AS n FROM reranked GROUP BY query_id)
SELECT query_id, query,
  CASE WHEN n IS NULL THEN 'No relevant context documents were found in the knowledge base to answer this query.'
  ELSE '### Query Response' || chr(10) || 'Based strictly on the retrieved knowledge base documents:' || chr(10) || chr(10)
    || excerpts || chr(10) || chr(10) || '### Referenced Citations' || chr(10) || refs END AS answer,
  coalesce(cited, '') AS cited, coalesce(n, 0)::INTEGER AS n_retrieved,
  (SELECT count(*) FROM fused f WHERE f.query_id = q.query_id) AS rrf_fused_count
FROM questions q LEFT JOIN built USING (query_id)""",
    "retrieval_compare": HYBRID
    + """, method_lists AS (
  SELECT 'dense' AS method, query_id, chunk_id, rank FROM dense
  UNION ALL SELECT 'bm25', query_id, chunk_id, rank FROM bm25
  UNION ALL SELECT 'fused', query_id, chunk_id, rank FROM fused
  UNION ALL SELECT 'reranked', query_id, chunk_id, final_rank FROM reordered)
SELECT method, (SELECT count(DISTINCT query_id) FROM questions) AS queries, count(*) AS hits,
  count(*) FILTER (final_rank <= 3) AS shared_with_reranked,
  round(coalesce(sum(1.0::DOUBLE / l.rank) FILTER (final_rank = 1), 0) / (SELECT count(DISTINCT query_id) FROM questions), 9) AS mrr
FROM method_lists l LEFT JOIN (SELECT query_id, chunk_id, final_rank FROM reordered) USING (query_id, chunk_id)
GROUP BY method""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
