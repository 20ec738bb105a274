"""Sinks: landing folders, appends, enforced appends, snapshots, Kafka."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from strata.operators.contract import ID_DIGITS, Contract, is_valid, observe_counts, rejection_columns
from strata.sources.versions import fresh_folder, publish, published

log = logging.getLogger(__name__)

QUARANTINE_COLUMNS = (
    "quarantine_id",
    "rejection_timestamp",
    "rejection_reason",
    "failed_field",
    "raw_payload",
)


class SchemaMismatchError(ValueError):
    """An append whose columns or types differ from the table's."""


def write_split(
    checked: DataFrame,
    contract: Contract,
    path: str,
    value: str = "value",
    position: tuple[str, ...] = (),
    source_file: str | None = None,
    fmt: str = "parquet",
    digits: int = ID_DIGITS,
    batch: int | None = None,
) -> dict:
    """Land checked rows in one job, valid and quarantined in a folder each.

    ``fmt`` is parquet or json.

    The rows are scanned and parsed once; readers prune to their folder. A
    rerun overwrites. Returns the counts, taken during the write.

    ``position`` are the columns that tell rows of one text apart, as topic,
    partition and offset. Without them the file and the line's number do, where
    ``read_events`` gave them as ``_source_row``: ids and the order of rows then stay
    the same however the files are split. Rows with neither are numbered in the
    batch, which is stable only for the same splits.
    """
    observed, seen = observe_counts(checked)
    placed = "_source_row" in checked.columns
    numbered = observed if placed else observed.withColumn("_source_row", F.monotonically_increasing_id())
    if placed and source_file and not position:
        position = (source_file, "_source_row")
    rejected = ~is_valid()
    record = rejection_columns(value, position or ("_source_row",), digits, batch)
    rows = numbered.select(
        *[F.when(is_valid(), F.col(c)).alias(c) for c in contract.columns],
        *[F.when(rejected, column).alias(name) for name, column in record.items()],
        (F.col(source_file) if source_file else F.lit(None).cast("string")).alias("_source_file"),
        "_source_row",
        F.when(rejected, "quarantined").otherwise("valid").alias("_status"),
    )
    writer = rows.write.mode("overwrite").partitionBy("_status").format(fmt)
    (writer.option("compression", "zstd") if fmt == "parquet" else writer).save(path)
    return seen.get


def landing_schema(contract: Contract) -> str:
    """Schema of a landing folder; given to the reader, as a batch may hold no row."""
    texts = ", ".join(f"{c} string" for c in (*QUARANTINE_COLUMNS, "_source_file", "_status"))
    return f"{contract.sql_schema}, {texts}, _source_row bigint"


def read_valid(
    spark: SparkSession, path: str, contract: Contract, with_source: bool = False, fmt: str = "parquet"
) -> DataFrame:
    """The contract columns of the valid rows, with the file and place they came from on demand."""
    rows = spark.read.schema(landing_schema(contract)).format(fmt).load(path)
    source = ["_source_file", "_source_row"] if with_source else []
    return rows.where("_status = 'valid'").select(*contract.columns, *source)


def read_quarantine(spark: SparkSession, path: str, contract: Contract, fmt: str = "parquet") -> DataFrame:
    rows = spark.read.schema(landing_schema(contract)).format(fmt).load(path)
    return rows.where("_status = 'quarantined'").select(*QUARANTINE_COLUMNS)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def send_to_kafka(df: DataFrame, bootstrap: str, topic: str) -> bool:
    """Send each row as JSON; a failed delivery is logged and reported, not raised.

    A missing connector or a wrong option is a fault of the set-up and is raised.
    """
    try:
        (
            df.select(F.to_json(F.struct(*df.columns)).alias("value"))
            .write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .save()
        )
        return True
    except AnalysisException:
        raise
    except Exception:
        log.exception("rows were not sent to topic %s", topic)
        return False


def with_audit(df: DataFrame, source_name: str = "kafka_ingestion_boundary") -> DataFrame:
    """Bronze audit columns: when and from where a row was taken in."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source": F.lit(source_name),
            "ingestion_date": F.current_date(),
        }
    )


def append_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ("ingestion_date",)
) -> int:
    """Append one batch as its own ``_batch_id`` folder; replaying it overwrites that folder only.

    Returns the number of rows, counted during the write.
    """
    seen = Observation("appended")
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = counted.write.mode("overwrite").partitionBy(*partition_by).option("compression", "zstd")
    writer.parquet(f"{path}/_batch_id={batch_id}")
    return seen.get["n"]


def bronze_schema(contract: Contract) -> str:
    audit = "_source_file string, _source_row bigint, _ingested_at timestamp, _source string, ingestion_date date, _batch_id bigint"
    return f"{contract.sql_schema}, {audit}"


def read_batches(
    spark: SparkSession, path: str, schema: str | None = None, after: int | None = None
) -> DataFrame:
    """An append log; ``after`` keeps the batches behind a given one, by partition pruning."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path)
    return rows if after is None else rows.where(F.col("_batch_id") > after)


def schema_diff(target: T.StructType, incoming: T.StructType) -> list[tuple[str, str]]:
    """(column, problem) for each extra, missing or differently typed column."""
    have = {f.name: f.dataType for f in target.fields}
    new = {f.name: f.dataType for f in incoming.fields}
    problems = [(c, "extra column") for c in new if c not in have]
    problems += [(c, "missing column") for c in have if c not in new]
    problems += [
        (c, f"type {new[c].simpleString()} instead of {have[c].simpleString()}")
        for c in have
        if c in new and new[c] != have[c]
    ]
    return sorted(problems)


def append_enforced(df: DataFrame, path: str) -> None:
    """Append only when names and types equal the table's; else nothing is written."""
    target = df.sparkSession.read.parquet(path)
    problems = schema_diff(target.schema, df.schema)
    if problems:
        raise SchemaMismatchError(f"append to {path} refused: {problems}")
    df.select(*target.columns).write.mode("append").parquet(path)


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    _, manifest = published(spark, root)
    return spark.read.parquet(f"{root}/{manifest['folder']}") if manifest else None


def write_snapshot(df: DataFrame, root: str, enforce: bool = False) -> int:
    """Publish a new version of a table that is written whole; returns its row count.

    With ``enforce`` its columns and types must equal the last version's.
    """
    spark = df.sparkSession
    version, manifest = published(spark, root)
    if enforce and manifest:
        problems = schema_diff(T.StructType.fromJson(manifest["schema"]), df.schema)
        if problems:
            raise SchemaMismatchError(f"version of {root} refused: {problems}")
    folder = fresh_folder(version + 1)
    seen = Observation("snapshot")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{folder}")
    publish(spark, root, version + 1, {"folder": folder, "schema": df.schema.jsonValue()})
    return seen.get["n"]
