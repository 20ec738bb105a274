"""Published versions of a table: a small manifest that names the folders it is made of.

Data is written to fresh folders and counts only once a manifest names it, so a
lost job leaves the table as it was. A manifest is created exclusively: of two
writers that start from one version the second one fails instead of undoing the
first one's work.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class ConcurrentWriteError(RuntimeError):
    """Somebody else published the version this writer was about to publish."""


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_versions")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _read(spark: SparkSession, root: str, version: int) -> dict | None:
    lines = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    folder, fs = _folder(spark, root)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{version}.json"))
    try:
        text = lines.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None  # its writer was lost before it ended; not published


def published(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(highest version claimed, manifest of the latest finished one)."""
    folder, fs = _folder(spark, root)
    if not fs.exists(folder):
        return 0, None
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    versions = sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))
    for version in reversed(versions):
        if (manifest := _read(spark, root, version)) is not None:
            return versions[-1], manifest
    return (versions[-1] if versions else 0), None


def publish(spark: SparkSession, root: str, version: int, manifest: dict) -> None:
    """Make ``manifest`` the given version, unless that version exists."""
    folder, fs = _folder(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{version}.json")
    try:
        stream = fs.create(path, False)
    except Exception as error:
        if fs.exists(path):
            raise ConcurrentWriteError(f"version {version} of {root} was published by another writer") from error
        raise
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()


def fresh_folder(version: int) -> str:
    """A folder name that no other writer uses."""
    return f"data/{version:06d}-{uuid.uuid4().hex[:12]}"
