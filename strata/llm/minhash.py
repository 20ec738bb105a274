"""Near-duplicate classes by b-bit MinHash (operator 7).

1. One pass makes each document's set of word shingles (64-bit hashes), its
   minima under ``bands * rows`` hash functions, the band keys, and the low
   ``bits`` bits of the minima packed into longs. The rows are staged; texts are not.
2. Documents with one shingle set are one class, stood for by the smallest id.
3. Classes that share a band key are candidates. Each bucket ties its members to
   one centre: candidates grow with the bucket, not with its square.
4. The collision-corrected similarity of the packed signatures, by bit counts,
   drops candidates more than ``margin`` standard deviations below the threshold.
5. The rest are confirmed on their full shingle sets.
6. Where a bucket still spans several components, its members meet in tiles of
   bounded size: those whose signatures come near one of another component get
   their texts, are compared on their full sets inside the task, and leave one link
   for each two components joined, not one for each pair. So no link is lost to the
   choice of a centre, and what leaves a tile is no larger than what enters it.

Texts are fetched by a Bloom filter of fixed size over the ids wanted, not by a
shuffle of all texts.

Components come from alternating stars over confirmed links.

Defined cases: null, empty and blank texts have no shingles and link with
nothing; rows of one id are one document; rows without id link with nothing,
have no component and are kept; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.bloom import keep_passing
from strata.llm.common import PREFIX, long_id, staged, text_bytes
from strata.llm.components import components


@dataclass(frozen=True)
class MinHashSettings:
    words: int = 5  # words in a shingle
    percent: int = 80  # links need 100 * intersection >= percent * union
    bands: int = 32
    rows: int = 5  # a pair at 0.8 shares no band once in 300,000 times
    bits: int = 4  # kept of each minimum: 1, 2, 4 or 8
    margin: float = 5.0  # standard deviations allowed below the threshold
    tile: int = 2048  # members of a bucket in one side of a tile
    seed: int = 20240501

    @property
    def least_estimate(self) -> float:
        s, c = self.percent / 100, 2.0**-self.bits
        p = s + (1 - s) * c
        return s - self.margin * math.sqrt(p * (1 - p) / (self.bands * self.rows)) / (1 - c)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hash of a word, made once per word; emptied when it is large."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, size: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; fewer words than ``size`` are one shingle."""
    words = text.lower().split()  # of bytes: ASCII letters and blanks alone
    if not words:
        return np.empty(0, dtype=np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    out = codes[: len(codes) - size + 1].copy()
    for i in range(1, size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[i : len(codes) - size + 1 + i]
    return np.unique(_mixed(out))


def _signatures(s: MinHashSettings):
    n = s.bands * s.rows
    random = np.random.default_rng(s.seed)
    factor = random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offset = random.integers(0, 2**63, n, dtype=np.uint64)
    salt = random.integers(0, 2**63, s.bands, dtype=np.uint64)
    per_long = 64 // s.bits
    n_longs = -(-n // per_long)

    def minima(codes: np.ndarray) -> np.ndarray:
        least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(codes), 512):
            np.minimum(least, (codes[start : start + 512, None] * factor + offset).min(axis=0), out=least)
        return least

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            size = batch.num_rows
            counts = np.zeros(size, dtype=np.int64)
            keys = np.zeros((size, 2), dtype=np.int64)
            least = np.zeros((size, n), dtype=np.uint64)
            for i, text in enumerate(text_bytes(batch.column(1))):
                codes = shingles(text, s.words, hashes) if text else ()
                if len(codes):
                    counts[i] = len(codes)
                    keys[i] = np.frombuffer(xxhash.xxh3_128_digest(codes.tobytes()), dtype=np.int64)
                    least[i] = minima(codes)
            bands = np.zeros((size, s.bands), dtype=np.uint64)
            for r in range(s.rows):
                bands = bands * np.uint64(0x9E3779B97F4A7C15) + least[:, r :: s.rows]
            bands = _mixed(bands + salt)
            low = np.zeros((size, n_longs * per_long), dtype=np.uint64)
            low[:, :n] = least & np.uint64(2**s.bits - 1)
            shifts = (np.arange(per_long, dtype=np.uint64) * np.uint64(s.bits))[None, None, :]
            packed = np.bitwise_or.reduce(low.reshape(size, n_longs, per_long) << shifts, axis=2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())]
                + [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(size + 1, dtype=np.int32) * m.shape[1]), pa.array(m.view(np.int64).ravel())
                    )
                    for m in (packed, bands)
                ],
                names=["doc_id", "n_shingles", "set1", "set2", "packed", "bands"],
            )

    return rows


def _mask(bits: int) -> int:
    mask = sum(1 << i for i in range(0, 64, bits))
    return mask - (1 << 64) if mask >> 63 else mask


def estimate(a: Column, b: Column, s: MinHashSettings) -> Column:
    """Similarity from packed signatures: differing places by bit counts, corrected for chance matches."""

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        width = 1
        while width < s.bits:
            d = d.bitwiseOR(F.shiftrightunsigned(d, width))
            width *= 2
        return F.bit_count(d.bitwiseAND(F.lit(_mask(s.bits)).cast("long")))

    unlike = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, x: acc + x)
    chance = 2.0**-s.bits
    return (1 - unlike / (s.bands * s.rows) - chance) / (1 - chance)


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a tile's two sides; a tile of one block is compared with itself."""
    side = rows.column("side").to_numpy()
    left = np.flatnonzero(side == 0)
    return (left, np.flatnonzero(side == 1)) if (side == 1).any() else (left, left)


def _near_in_tile(s: MinHashSettings):
    """The rows of a tile that come near a row of another component, by their signatures."""
    n, chance, mask = s.bands * s.rows, 2.0**-s.bits, np.uint64(_mask(s.bits) % 2**64)
    most = math.floor(n * (1 - chance) * (1 - s.least_estimate) + 1e-9)

    def near(rows: pa.Table) -> pa.Table:
        labels = rows.column("label").to_numpy()
        packed = rows.column("packed").combine_chunks()
        packed = packed.flatten().to_numpy().view(np.uint64).reshape(len(labels), -1)
        left, right = _sides(rows)
        keep = np.zeros(len(labels), dtype=bool)
        for start in range(0, len(left), 64):
            part = left[start : start + 64]
            unlike = np.zeros((len(part), len(right)), dtype=np.int32)
            for k in range(packed.shape[1]):
                d = packed[part, k][:, None] ^ packed[right, k][None, :]
                width = 1
                while width < s.bits:
                    d |= d >> np.uint64(width)
                    width *= 2
                unlike += np.bitwise_count(d & mask)
            hit = (unlike <= most) & (labels[part][:, None] != labels[right][None, :])
            keep[part] |= hit.any(axis=1)
            keep[right] |= hit.any(axis=0)
        return rows.select(["key", "i", "j", "side", "node", "label"]).filter(pa.array(keep))

    return near


def _linked_in_tile(s: MinHashSettings):
    """One confirmed link for each two components of a tile that have any."""

    def links(rows: pa.Table) -> pa.Table:
        hashes = _WordHashes()
        nodes = rows.column("node").to_numpy()
        sets = [shingles(t, s.words, hashes) for t in text_bytes(rows.column("text").combine_chunks())]
        sizes = np.array([len(x) for x in sets])
        distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        group = {label: label for label in rows.column("label").to_pylist()}
        of = rows.column("label").to_pylist()

        def root(x):
            while group[x] != x:
                group[x] = x = group[group[x]]
            return x

        left, right = _sides(rows)
        marks = np.zeros(len(distinct), dtype=np.int32)
        found = []
        for x in left:
            roots = np.array([root(of[y]) for y in right])
            others = right[(roots != root(of[x])) & (sizes[right] > 0)]
            others = others[100 * np.minimum(sizes[others], sizes[x]) >= s.percent * np.maximum(sizes[others], sizes[x])]
            if not len(others):
                continue
            own = codes[starts[x] : starts[x + 1]]
            marks[own] = 1
            both = np.array([int(marks[codes[starts[y] : starts[y + 1]]].sum()) for y in others])
            marks[own] = 0
            for y in others[100 * both >= s.percent * (sizes[x] + sizes[others] - both)]:
                a, b = root(of[x]), root(of[y])
                if a != b:
                    group[a] = b
                    found.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
        )

    return links


def _confirm(s: MinHashSettings):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        last, last_set = None, None
        for batch in batches:
            keep = []
            for left, right in zip(text_bytes(batch.column(2)), text_bytes(batch.column(3)), strict=True):
                if left != last:
                    last, last_set = left, shingles(left, s.words, hashes)
                other = shingles(right, s.words, hashes)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(100 * both >= s.percent * (len(last_set) + len(other) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return rows


def _texts(given: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts with a word of the ids, and by chance of a few others, by a scan with a filter.

    An id may be repeated with a null or an empty text, which is linked to nothing.
    """
    given = given.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return staged(keep_passing(given, ids), "candidate-texts")


def _confirmed(given: DataFrame, pairs: DataFrame, s: MinHashSettings) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    pairs = staged(pairs, "candidates")
    texts = _texts(given, pairs.select(F.explode(F.array("a", "b"))))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return staged(both.mapInArrow(_confirm(s), "a long, b long").distinct(), "links")


def _ties(linkable: DataFrame, same_set: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one id: rows of one id are one document, whatever their texts."""
    sets = F.struct("set1", "set2")
    repeated = linkable.groupBy("doc_id").agg(F.min(sets).alias("low"), F.max(sets).alias("high")).where("low <> high")
    rows = linkable.join(repeated.select("doc_id"), "doc_id", "leftsemi").join(same_set, ["set1", "set2"])
    return rows.select(F.col("node").alias("a"), F.col("doc_id").alias("b")).where("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: MinHashSettings = MinHashSettings()
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links; ``kept`` marks it.
    """
    s = settings
    given = docs.select(long_id(docs, id_col).alias("doc_id"), docs[text_col].alias("text"))
    signed = staged(
        given.mapInArrow(
            _signatures(s),
            "doc_id long, n_shingles long, set1 long, set2 long, packed array<long>, bands array<long>",
        ),
        "signatures",
    )
    linkable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same_set = linkable.groupBy("set1", "set2").agg(F.min("doc_id").alias("node"))
    classes = staged(
        linkable.groupBy("set1", "set2").agg(
            F.min("doc_id").alias("node"), F.first("packed").alias("packed"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    banded = classes.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    members = staged(banded.join(buckets, "key"), "buckets")
    signature = classes.select("node", "packed")

    def promising(pairs: DataFrame) -> DataFrame:
        a = signature.select(F.col("node").alias("a"), F.col("packed").alias("packed_a"))
        b = signature.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))
        near = estimate(F.col("packed_a"), F.col("packed_b"), s) >= s.least_estimate - 1e-9
        return pairs.join(b, "b").join(a, "a").where(near).select("a", "b")

    stars = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = staged(_confirmed(given, promising(stars), s).unionByName(_ties(linkable, same_set)), "ties")
    found = staged(components(links), "components")

    open_rows = members.where("n > 2").join(found, "node", "left").select(
        "key", "node", "n", F.coalesce("component", "node").alias("label")
    )
    still_open = open_rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    still_open = still_open.where("low <> high").select("key")
    blocks = F.ceil(F.col("n") / s.tile).cast("int")
    tiles = (
        open_rows.join(still_open, "key", "leftsemi")
        .join(signature, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key", "node", "label", "packed",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
        )
    )
    tile = ["key", "i", "j"]
    near = staged(
        tiles.groupBy(tile).applyInArrow(
            _near_in_tile(s), "key long, i int, j int, side int, node long, label long"
        ),
        "near",
    )
    texts = _texts(given, near.select("node")).withColumnRenamed("doc_id", "node")
    more = staged(
        near.join(texts, "node").groupBy(tile).applyInArrow(_linked_in_tile(s), "a long, b long").distinct(), "links"
    )
    if not more.isEmpty():
        found = staged(components(links.unionByName(more)), "components")

    whole = signed.join(same_set, ["set1", "set2"], "left").join(found, "node", "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    return whole.select("doc_id", "n_shingles", F.coalesce(own, "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: MinHashSettings = MinHashSettings()
) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest id, once.

    Rows without id stay. Of rows alike in id and text one stays.
    """
    kept = near_duplicates(docs, id_col, text_col, settings).where("kept AND doc_id IS NOT NULL")
    kept = kept.select(F.col("doc_id").alias(f"{PREFIX}id")).distinct()
    named = docs.withColumn(f"{PREFIX}id", docs[id_col].cast("long")).withColumn(f"{PREFIX}crc", F.crc32(docs[text_col]))
    stay = named.join(kept, f"{PREFIX}id", "leftsemi").dropDuplicates([f"{PREFIX}id", f"{PREFIX}crc"])
    return stay.unionByName(named.where(F.col(f"{PREFIX}id").isNull())).select(*docs.columns)
