"""Elements of JSON array files of any size, as rows of JSON text.

A JSON text holds no raw line feed inside a string, so every line can be read for
itself: its brackets outside of strings say how the depth changes. The first pass
sums that change over each split of a file; the driver adds the sums up (one row
a split) to the depth at which each split begins; the second pass cuts the lines
into elements. An element that reaches over a split's edge leaves its parts,
which are put together by element. Files are split like any text; no whole file
is ever held, only one line and one element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

TOKENS = re.compile(r'"(?:[^"\\]|\\.)*"?|[\[\]{},]')
HELD = 1 << 20  # bytes of lines or elements that are Python objects at a time, or one line


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``HELD`` bytes; what a task holds besides the batch hangs on these alone."""
    rows = max(1, HELD * batch.num_rows // max(batch.nbytes, 1))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        for part in _slices(batch):
            yield from zip(*[c.to_pylist() for c in part.columns], strict=True)


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, change, first): the change of depth in each split and its first character."""
    seen: dict[tuple[str, int], list] = {}
    for file, start, line in _by_split(batches):
        entry = seen.setdefault((file, start), [0, ""])
        entry[1] = entry[1] or line.strip()[:1]
        for token in TOKENS.findall(line):
            entry[0] += (token in "[{") - (token in "]}")
    rows = [(f, s, d, c) for (f, s), (d, c) in seen.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())],
        names=["file", "start", "change", "first"],
    )


class _Cutter:
    """Cuts one split into elements; ``base`` is the depth of the file's elements."""

    def __init__(self, file: str, start: int, depth: int, base: int, ordinal: int):
        self.file, self.start, self.depth, self.base = file, start, depth, base
        self.text: list[str] = []
        self.number, self.ordinal = 0, ordinal
        self.rows: list[tuple[str, int, int, str, bool]] = []
        self.held = 0

    def end(self, closed: bool) -> None:
        text = " ".join(t for part in self.text if (t := part.strip()))  # one line: strings hold no line feed
        if text or not closed or not self.number:
            self.rows.append((self.file, self.ordinal, self.number, text, closed))
            self.held += len(text) + 100
        self.text = []
        self.number += closed

    def line(self, line: str) -> None:
        begin = 0
        for m in TOKENS.finditer(line):
            token = m.group()
            if token in "[{":
                self.depth += 1
                if self.depth == self.base:  # the file's own bracket
                    begin = m.end()
            elif token in "]}":
                self.depth -= 1
                if self.depth < self.base:
                    self.text.append(line[begin : m.start()])
                    self.end(True)
                    begin = m.end()
                elif self.base == 0 and self.depth == 0:
                    self.text.append(line[begin : m.end()])
                    self.end(True)
                    begin = m.end()
            elif token == "," and self.depth == self.base and self.base:
                self.text.append(line[begin : m.start()])
                self.end(True)
                begin = m.end()
        self.text.append(line[begin:])


def _cut(places: dict[tuple[str, int], tuple[int, int, int]]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = None

        def flush() -> pa.RecordBatch:
            out, cutter.rows, cutter.held = cutter.rows, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.string()),
                 pa.array([r[4] for r in out], pa.bool_())],
                names=["file", "split", "number", "text", "closed"],
            )

        for file, start, line in _by_split(batches):
            if cutter is None or (cutter.file, cutter.start) != (file, start):
                if cutter is not None:
                    cutter.end(False)
                    yield flush()
                cutter = _Cutter(file, start, *places[file, start])
            cutter.line(line)
            if cutter.held >= HELD:
                yield flush()
        if cutter is not None:
            cutter.end(False)
            yield flush()

    return rows


def as_array(rows: DataFrame) -> DataFrame:
    """Lines of indented array files from JSON texts in ``value``; each partition is one file."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            for part in _slices(batch):
                out = []
                for text in part.column(0).to_pylist():
                    out += [before, "  " + text]
                    before = ","
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]"] if before == "," else ["[", "]"])], names=["value"])

    return rows.select("value").mapInArrow(lines, "value string")


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """(value, _source_file): each element of the array files under ``path``, on one line.

    A file that is one object is one element. What an unbalanced file leaves
    over is a row too, for the contract to reject.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    splits = lines.mapInArrow(_changes, "file string, start bigint, change bigint, first string")
    places: dict[tuple[str, int], tuple[int, int, int]] = {}
    depth, base, before, ordinal = 0, 0, None, 0
    for r in splits.orderBy("file", "start").collect():  # one row a split
        if r["file"] != before:
            before, depth, base, ordinal = r["file"], 0, int(r["first"] == "["), 0
        places[r["file"], r["start"]] = (depth, base, ordinal)
        depth += r["change"]
        ordinal += 1
    parts = lines.mapInArrow(_cut(places), "file string, split bigint, number bigint, text string, closed boolean")
    whole = parts.where("number > 0 AND closed").select(F.col("text").alias("value"), F.col("file").alias("_source_file"))
    # The first part of a split ends what earlier splits began; an open last part begins an element.
    edges = parts.where("number = 0 OR NOT closed")
    ends = edges.groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("split", "number", "closed", "text"))).alias("parts")
    )
    joined = ends.select(
        F.col("file").alias("_source_file"),
        F.explode(
            F.aggregate(
                "parts",
                F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open")),
                lambda acc, p: F.struct(
                    F.when(p["closed"], F.concat(acc["done"], F.array(F.concat(acc["open"], F.lit(" "), p["text"]))))
                    .otherwise(acc["done"]).alias("done"),
                    F.when(p["closed"], F.lit("")).otherwise(F.concat(acc["open"], F.lit(" "), p["text"])).alias("open"),
                ),
                lambda acc: F.concat(acc["done"], F.array(acc["open"])),
            )
        ).alias("value"),
    )
    rest = joined.select(F.trim("value").alias("value"), "_source_file").where("value <> ''")
    return whole.where("value <> ''").unionByName(rest)
