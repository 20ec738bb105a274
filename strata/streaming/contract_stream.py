"""The contract as a stream, and a silver table fed by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.config import Settings
from strata.operators.contract import Contract, check
from strata.operators.merge import ROW_ORDER, latest_rows, standardize
from strata.sources.silver import merge_silver
from strata.sources.writers import read_quarantine, read_valid, send_to_kafka, with_audit, write_split


def stream_contract(
    events: DataFrame,
    contract: Contract,
    out: str,
    checkpoint: str,
    position: tuple[str, ...] = (),
    dead_letters: Settings | None = None,
) -> StreamingQuery:
    """Split a stream of JSON texts into valid and quarantined rows, then stop when drained.

    Each micro-batch lands in its own folder and a replay overwrites that
    folder, so a restart from the checkpoint neither loses nor doubles rows.
    With ``dead_letters`` the quarantined rows also go to its Kafka topic.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out}/batch_id={batch_id}"
        write_split(check(batch, contract), contract, folder, position=position, batch=batch_id)
        if dead_letters is not None:
            rejected = read_quarantine(batch.sparkSession, folder, contract)
            send_to_kafka(rejected, dead_letters.kafka_bootstrap, dead_letters.kafka_dlq_topic)

    return _drain(events, land, checkpoint)


def stream_silver(
    events: DataFrame,
    contract: Contract,
    silver: str,
    staging: str,
    checkpoint: str,
    settings: Settings = Settings(),
    position: tuple[str, ...] = (),
) -> StreamingQuery:
    """Upsert the valid rows of each micro-batch into a silver table.

    Each micro-batch lands split under ``staging`` before the merge, so rejected
    rows stay as quarantine records (``quarantined``) and the merge does not
    depend on the stream's source again. The latest version of a key wins: by
    batch, then publication time, then place in the batch.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landing = f"{staging}/landing/batch_id={batch_id}"
        source_file = "_source_file" if "_source_file" in batch.columns else None
        write_split(check(batch, contract), contract, landing, position=position, source_file=source_file, batch=batch_id)
        valid = read_valid(spark, landing, contract, with_source=True)
        rows = standardize(with_audit(valid, settings.source_name)).withColumn("_batch_id", F.lit(batch_id).cast("long"))
        folder = f"{staging}/rows/batch_id={batch_id}"
        latest = latest_rows(rows, settings.business_key, ROW_ORDER, settings.broadcast_bytes)
        latest.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        merge_silver(spark.read.parquet(folder), silver, settings.business_key, settings.broadcast_bytes, ROW_ORDER,
                     bucket_bytes=settings.bucket_bytes, task_bytes=settings.task_bytes)

    return _drain(events, merge, checkpoint)


def quarantined(spark: SparkSession, contract: Contract, staging: str) -> DataFrame:
    """All rows that a stream-fed silver table rejected."""
    return read_quarantine(spark, f"{staging}/landing", contract)


def _drain(events: DataFrame, each_batch, checkpoint: str) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
