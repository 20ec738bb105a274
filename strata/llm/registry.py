"""Names of the text operators' queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import oracle, queries as q
from strata.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_secrets": q.op1_secrets,
    "op2_url_filter": q.op2_url_filter,
    "op3_quality": q.op3_quality,
    "op4_packing": q.op4_packing,
    "op5_language_id": q.op5_language_id,
    "op6_nearest": q.op6_nearest,
    "op7_minhash": q.op7_minhash,
    "op8_sentencepiece": q.op8_sentencepiece,
    "op9_line_dedup": q.op9_line_dedup,
    "op10_pii": q.op10_pii,
    "op11_bpe": q.op11_bpe,
    "op12_importance": q.op12_importance,
    "op13_manifest": q.op13_manifest,
}

ORACLE: dict[str, str] = {
    "op1_secrets": oracle.SECRETS,
    "op2_url_filter": oracle.URL_FILTER,
    "op3_quality": oracle.QUALITY,
    "op7_minhash": oracle.NEAR_DUPLICATES,
    "op9_line_dedup": oracle.LINE_DEDUP,
    "op12_importance": oracle.IMPORTANCE,
    "op13_manifest": oracle.MANIFEST,
}


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__doc__ = query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
