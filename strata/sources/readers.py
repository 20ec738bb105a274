"""Sources: JSON files, Kafka topics and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.operators.sizing import broadcast_if_small
from strata.session import delta_available, work_path
from strata.sources.json_array import read_array


def _numbered_lines(spark: SparkSession, path: str, broadcast_bytes: int) -> DataFrame:
    """(value, _source_file, _source_row): text lines with their number, from 0, in their file.

    A first pass counts the lines of each split; sums over the splits before it in the
    file say where a split's lines begin. So a line has one number however the files are
    split, and the lines themselves are not shuffled.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    counted = lines.groupBy("_source_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    folder = work_path(spark, "splits")
    counted.write.parquet(folder)
    before = Window.partitionBy("_source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    splits = spark.read.schema(counted.schema).parquet(folder).select("_source_file", "_block", shift.alias("_shift"))
    found = lines.join(broadcast_if_small(splits, broadcast_bytes), ["_source_file", "_block"])
    return found.select("value", "_source_file", (F.col("_at") + F.col("_shift")).alias("_source_row"))


def read_events(
    spark: SparkSession, path: str, layout: str = "lines", numbered: bool = True, broadcast_bytes: int = 64 << 20
) -> DataFrame:
    """Raw events as JSON text in ``value``, plus the file they came from.

    ``lines`` is one object per line and keeps malformed lines; each has its number in
    the file as ``_source_row`` unless ``numbered`` is off, which saves a pass that counts
    lines. ``array`` is a JSON array, of any size, whose elements become rows; what is
    malformed stays as text for the contract to reject.
    """
    if layout == "array":
        return read_array(spark, path)
    if layout != "lines":
        raise ValueError(f"layout must be lines or array, got {layout!r}")
    if numbered:
        return _numbered_lines(spark, path, broadcast_bytes)
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_file"))


def read_json(spark: SparkSession, path: str, schema: str, array: bool = False) -> DataFrame:
    """Typed rows of a JSON file; a missing path is an AnalysisException."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def _kafka_value(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_kafka(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """A topic from its earliest offset to its current end, as a batch."""
    return _kafka_value(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def stream_kafka(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """A topic as a stream; later runs go on from the checkpoint."""
    return _kafka_value(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of JSON texts."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("value")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Delta table where Delta is installed and the path holds one, else Parquet."""
    if delta_available():
        from delta.tables import DeltaTable

        if DeltaTable.isDeltaTable(spark, path):
            return spark.read.format("delta").load(path)
    return spark.read.parquet(path)
