"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from importlib.util import find_spec

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import strata

# Session settings that results depend on, or that hold at every scale.
# Master, memory and shuffle width are left to whoever submits the job.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A union that claims its children's partitioning was seen to split equal keys over
    # two groups (Spark 4.1, union of two ranked lists, then a group-by and a join).
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.variant.allowDuplicateKeys": "true",  # the last duplicate key wins
    # Look-ups by key compare each key with a row group's bounds, not just the least and greatest one.
    "spark.sql.parquet.pushdown.inFilterThreshold": "300",
}

_local_root: tempfile.TemporaryDirectory | None = None


def delta_available() -> bool:
    """True when the Delta Python package (and so its jar) is installed."""
    return find_spec("delta") is not None


def build_session(app_name: str = "strata", conf: dict[str, str] | None = None) -> SparkSession:
    """Build or reuse a session; Delta is switched on only where it is installed."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(RUNTIME_CONF)
    if delta_available():
        settings["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        settings["spark.sql.catalog.spark_catalog"] = "org.apache.spark.sql.delta.catalog.DeltaCatalog"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    Functions of this package travel to the Python workers by value, so the
    executors need not have it installed.
    """
    cloudpickle.register_pickle_by_value(strata)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder, which
    goes when the process ends.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="strata-", ignore_cleanup_errors=True)
    return _local_root.name


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table in the shared folder."""
    return os.path.join(shared_dir(spark), "strata", f"{name}-{uuid.uuid4().hex}")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input with fewer splits than the session has task slots.

    For CPU-heavy work on a small or unsplittable input. An input that already
    has enough splits, as any large one has, is returned as it is: no shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
