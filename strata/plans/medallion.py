"""The whole run: ingest, bronze, silver, gate, gold, index, with lineage."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.config import Settings
from strata.operators import gold
from strata.operators.chunks import UNKNOWN_DOC, chunk_documents
from strata.operators.contract import ARTICLE_EVENT, Contract, check
from strata.operators.embed import Embedder
from strata.operators.lineage import LineageLog
from strata.operators.merge import ROW_ORDER, latest_rows, standardize
from strata.operators.quality import SILVER_SUITE, Expectation, enforce
from strata.operators.sizing import broadcast_if_small
from strata.plans.retrieval import Index, build_index, refresh_index
from strata.sources.silver import merge_silver, read_silver
from strata.sources.versions import published
from strata.sources.writers import (
    append_batch,
    bronze_schema,
    latest_snapshot,
    read_batches,
    read_valid,
    with_audit,
    write_snapshot,
    write_split,
)

JOB = "article_run"


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables; everything below one root."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def landing(self, batch_id: int) -> str:
        return self.at("landing", f"batch={batch_id}")


def ingest(events: DataFrame, contract: Contract, layout: Layout, batch_id: int) -> dict:
    """Check raw events and land them split; returns the counts."""
    source_file = "_source_file" if "_source_file" in events.columns else None
    return write_split(
        check(events, contract), contract, layout.landing(batch_id), source_file=source_file, batch=batch_id
    )


def load_bronze(valid: DataFrame, layout: Layout, batch_id: int, settings: Settings) -> int:
    return append_batch(with_audit(valid, settings.source_name), layout.at("bronze"), batch_id)


def load_silver(spark, contract: Contract, layout: Layout, batch_id: int, settings: Settings) -> None:
    """Merge the rows of this bronze batch only; other batches are pruned away.

    A row is replaced by one of the same or a later batch, so running an old
    batch again changes nothing that came after it.
    """
    bronze = read_batches(spark, layout.at("bronze"), bronze_schema(contract))
    rows = bronze.where(f"_batch_id = {batch_id}")
    staged = latest_rows(standardize(rows), settings.business_key, ROW_ORDER, settings.broadcast_bytes)
    folder = layout.at("staging", f"batch={batch_id}")
    staged.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    merge_silver(
        spark.read.parquet(folder), layout.at("silver"), settings.business_key, settings.broadcast_bytes, ROW_ORDER,
        bucket_bytes=settings.bucket_bytes, task_bytes=settings.task_bytes,
    )


GOLD_TABLES = {
    "category_metrics": gold.category_metrics,
    "author_metrics": gold.author_metrics,
    "category_word_counts": gold.category_word_counts,
    "daily_velocity": gold.daily_velocity,
}


def load_index(
    silver: DataFrame, layout: Layout, batch_id: int, settings: Settings, embedder: Embedder | None
) -> Index:
    """Index the documents of this batch as silver has them now; those of other batches stay as they are."""
    key = settings.business_key
    spark = silver.sparkSession
    if published(spark, layout.at("index"))[1] is None:
        everything = chunk_documents(silver, settings.chunk_size, settings.chunk_overlap)
        return build_index(everything, layout.at("index"), settings, embedder)
    ids = spark.read.parquet(layout.at("staging", f"batch={batch_id}")).select(key).distinct()
    changed = silver.join(broadcast_if_small(ids, settings.broadcast_bytes), key, "left_semi")
    chunks = chunk_documents(changed, settings.chunk_size, settings.chunk_overlap)
    doc_ids = ids.select(F.coalesce(key, F.lit(UNKNOWN_DOC)).alias("doc_id"))
    return refresh_index(chunks, doc_ids, layout.at("index"), settings, embedder)


def load_gold(silver: DataFrame, layout: Layout) -> None:
    """A new version of each gold table, with the columns of the last one."""
    for name, metrics in GOLD_TABLES.items():
        write_snapshot(metrics(silver), layout.at("gold", name), enforce=True)


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The latest version of a gold table."""
    return latest_snapshot(spark, Layout(root).at("gold", name))


def run(
    events: DataFrame,
    root: str,
    batch_id: int,
    contract: Contract = ARTICLE_EVENT,
    suite: tuple[Expectation, ...] = SILVER_SUITE,
    settings: Settings = Settings(),
    embedder: Embedder | None = None,
) -> tuple[dict, Index]:
    """One batch of raw events through every stage.

    A failing gate raises ``QualityGateError`` before gold and index are
    touched. Any failure leaves a FAIL event for its stage and for the run.
    Running a batch again overwrites its own folders and leaves silver as it is.
    """
    spark = events.sparkSession
    layout = Layout(root)
    log = LineageLog(spark, layout.at("lineage"), settings.lineage_namespace, settings.lineage_producer)
    run_id = str(uuid.uuid4())
    summary: dict = {"run_id": run_id, "batch_id": batch_id}

    def stage(name: str, inputs: list[str], outputs: list[str], work):
        log.emit(name, "START", run_id, inputs, outputs)
        try:
            result = work()
        except Exception:
            log.emit(name, "FAIL", run_id, inputs, outputs)
            raise
        log.emit(name, "COMPLETE", run_id, inputs, outputs)
        return result

    def stages() -> Index:
        summary.update(
            stage("ingest", ["raw"], ["landing"], lambda: ingest(events, contract, layout, batch_id))
        )
        valid = read_valid(spark, layout.landing(batch_id), contract, with_source=True)
        summary["bronze_count"] = stage(
            "bronze", ["landing"], ["bronze"], lambda: load_bronze(valid, layout, batch_id, settings)
        )
        stage("silver", ["bronze"], ["silver"], lambda: load_silver(spark, contract, layout, batch_id, settings))
        silver = read_silver(spark, layout.at("silver"))
        summary["gate"] = stage("quality_gate", ["silver"], [], lambda: enforce(silver, suite))
        stage("gold", ["silver"], ["gold"], lambda: load_gold(silver, layout))
        return stage(
            "index", ["silver"], ["index"], lambda: load_index(silver, layout, batch_id, settings, embedder)
        )

    index = stage(JOB, ["raw"], ["gold", "index"], stages)
    return summary, index
