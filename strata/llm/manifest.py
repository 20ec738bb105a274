"""Merkle manifest of a dataset as a persistent, path-copying tree (operator 13).

Each row is a leaf. The leaves of a key (a source) form a tree in the order of their ids,
``fanout`` nodes to a parent, and the roots of all keys form a second tree in the order of
the keys. The trees are cut into aligned blocks of ``fanout ** levels`` nodes. A block is
one row: a task builds the levels inside, and the block's root is a node of the next
round's blocks. So a key with a third of all rows is many blocks, and a round shrinks
the nodes 4096-fold.

Going down again, each node gets its path: for each level up to the root, its siblings
left and right. A tampered leaf makes a version of the tree: the version copies the
ancestors inside the leaf's aligned block and shares all other nodes with the untampered
tree; above the block it goes on along the block's path. Versions are made where their
block is, so no task sees more than a block's.

Rounds are written to the shared folder, digests as 32 bytes; texts are hashed by the
scan and travel no further.

Defined cases: a null value counts as ``-``, also a null text, which tampering leaves null;
null keys come first, as one key; null ids come first within their key and are never
tampered with; rows of one id are leaves each, in the order of their digests; a text of
any length is one leaf; an empty table gives no row; columns beyond those named are not
part of a leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import ascii_lower, staged
from strata.llm.numbering import RANK, numbered


@dataclass(frozen=True)
class ManifestSettings:
    fanout: int = 16
    levels: int = 3  # inside a block


def digest(values: list[Column]) -> Column:
    """SHA-256, in hexadecimal, of the values one after the other, each with its length in bytes."""
    texts = [v.cast("string") for v in values]
    marked = [
        F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts
    ]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def node(children: list[bytes]) -> bytes:
    """The parent of nodes; nodes are digests in hexadecimal."""
    return sha256(b"".join(children)).hexdigest().encode()


class Tree:
    """Nodes of one block by level, from its leaves (level 0) to the block's root.

    ``height``: how many levels to build; by default until one node is left.
    """

    def __init__(self, leaves: list[bytes], fanout: int, height: int | None = None):
        self.fanout = fanout
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if height is None else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([node(below[i : i + fanout]) for i in range(0, len(below), fanout)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, at: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
        """Left and right siblings of leaf ``at`` and of its ancestors below the root."""
        for nodes in self.levels[:-1]:
            first = at - at % self.fanout
            yield nodes[first:at], nodes[at + 1 : first + self.fanout]
            at //= self.fanout

    def version(self, at: int, leaf: bytes) -> dict[tuple[int, int], bytes]:
        """The copied nodes, by level and place, of the tree whose leaf ``at`` is ``leaf``; it shares all others."""
        copied = {(0, at): leaf}
        changed = leaf
        for level, (left, right) in enumerate(self.siblings(at)):
            at //= self.fanout
            changed = copied[level + 1, at] = node([*left, changed, *right])
        return copied


def _packed(levels: Iterator[tuple[list[bytes], list[bytes]]]) -> bytes:
    """A path as bytes: per level the numbers of left and right siblings, then their digests."""
    return b"".join(
        bytes([len(left), len(right)]) + bytes.fromhex(b"".join([*left, *right]).decode()) for left, right in levels
    )


def _unpacked(path: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    levels, at = [], 0
    while at < len(path):
        n_left, n_right = path[at], path[at + 1]
        at += 2
        nodes = _hex(path[at : at + 32 * (n_left + n_right)])
        levels.append((nodes[:n_left], nodes[n_left:]))
        at += 32 * (n_left + n_right)
    return levels


def _hex(digests: bytes) -> list[bytes]:
    text = digests.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _tree(digests: bytes, block: int, s: ManifestSettings) -> Tree:
    """A key's only block ends where one node is left; a block among several has all its levels."""
    return Tree(_hex(digests), s.fanout, s.levels if block else None)


NODES = "key string, place long, id long, leaf binary, tampered binary"
BLOCKS = "key string, block long, root binary, leaves binary, ids array<long>, tampered array<binary>"


def _build(s: ManifestSettings, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Block rows from nodes (key, block, leaf, id, tampered) sorted by key, block and place."""
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    names = ["key", "block", "root", "leaves", "ids", "tampered"]

    def row(key: str, block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        leaves = b"".join([x for p in parts for x in p.column(2).to_pylist()])
        root = bytes.fromhex(_tree(leaves, block, s).root.decode())
        more = [[x for p in parts for x in p.column(c).to_pylist()] if whole else None for c in (3, 4)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kind) for v, kind in zip([key, block, root, leaves, *more], kinds, strict=True)], names=names
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            heads = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            start = 0
            for i, head in enumerate(heads):
                if head != current:
                    if i > start:
                        parts.append(batch.slice(start, i - start))
                    if current is not None:
                        yield row(*current, parts)
                    current, parts, start = head, [], i
            if len(heads) > start:
                parts.append(batch.slice(start))
        if current is not None:
            yield row(*current, parts)

    return rows


def _blocks(nodes: DataFrame, s: ManifestSettings, whole: bool, name: str) -> DataFrame:
    size = s.fanout**s.levels
    width = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = nodes.select("key", F.floor(F.col("place") / size).cast("long").alias("block"), "leaf", "id", "tampered", "place")
    return staged(
        split.repartition(width, "key", "block")
        .sortWithinPartitions("key", "block", "place")
        .mapInArrow(_build(s, whole), BLOCKS),
        name,
    )


def _rounds(nodes: DataFrame, s: ManifestSettings, whole: bool, name: str) -> list[DataFrame]:
    """Block tables from the leaves up, until each key has one block."""
    rounds = [_blocks(nodes, s, whole, f"{name}-0")]
    while (rounds[-1].agg(F.max("block")).first()[0] or 0) > 0:
        upper = rounds[-1].select(
            "key", F.col("block").alias("place"), F.lit(None).cast("long").alias("id"), F.col("root").alias("leaf"),
            F.lit(None).cast("binary").alias("tampered"),
        )
        rounds.append(_blocks(upper, s, False, f"{name}-{len(rounds)}"))
    return rounds


def _descend(s: ManifestSettings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, block, top, path) of every node of block rows (key, block, leaves, top, path)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, block, leaves, top, above in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                tree = _tree(leaves, block, s)
                n = len(tree.levels[0])
                first = block * s.fanout**s.levels
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * n, pa.string()),
                        pa.array(range(first, first + n), pa.int64()),
                        pa.array([top] * n, pa.binary()),
                        pa.array([_packed(tree.siblings(i)) + above for i in range(n)], pa.binary()),
                    ],
                    names=["key", "block", "top", "path"],
                )

    return rows


def _paths(rounds: list[DataFrame], tops: DataFrame, s: ManifestSettings, name: str) -> DataFrame:
    """(key, block, top, path) of the lowest blocks; ``tops``: (key, block 0, top, path) of each key's last block."""
    found = tops
    for i in range(len(rounds) - 1, 0, -1):
        joined = rounds[i].join(found, ["key", "block"]).select("key", "block", "leaves", "top", "path")
        found = staged(joined.mapInArrow(_descend(s), "key string, block long, top binary, path binary"), f"{name}-{i}")
    return found


ROWS = (
    "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "copied int"
)


def _prove(s: ManifestSettings, root: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the leaves of block rows (block, leaves, ids, tampered, top, path)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, leaves, ids, tampered, top, path = (c[r].as_py() for c in batch.columns)
                tree = _tree(leaves, block, s)
                above = _unpacked(path)
                rest = b"".join([x for left, right in above for x in (*left, *right)])
                proofs, folded, copied = [], [], []
                for i, changed in enumerate(tampered):
                    inside = [x for left, right in tree.siblings(i) for x in (*left, *right)]
                    proofs.append(sha256(b"".join(inside) + rest).hexdigest())
                    if changed is None:
                        folded.append(root)
                        copied.append(0)
                        continue
                    version = tree.version(i, changed.hex().encode())
                    up = version[len(tree.levels) - 1, 0]
                    for left, right in above:
                        up = node([*left, up, *right])
                    folded.append(up)
                    copied.append(len(version) + len(above))
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([x.decode() for x in tree.levels[0]]),
                        pa.array([top.hex()] * n),
                        pa.array([root.decode()] * n),
                        pa.array(proofs),
                        pa.array([x.decode() for x in folded]),
                        pa.array([x == root for x in folded]),
                        pa.array(copied, pa.int32()),
                    ],
                    names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copied"],
                )

    return rows


def manifest(
    docs: DataFrame,
    tampered: Column,
    id_col: str = "doc_id",
    key_col: str = "source",
    text_col: str = "text",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    settings: ManifestSettings = ManifestSettings(),
) -> DataFrame:
    """One row for each row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified, copied.

    A row where ``tampered`` is true becomes a version in which the text's A-Z are lower-cased;
    ``folded_root`` is the version's root, ``copied`` the number of nodes the version holds
    for itself, and ``verified`` whether the root stayed the same.
    """
    s = settings
    changed = [ascii_lower(docs[c]) if c == text_col else docs[c] for c in columns]
    key = F.coalesce(F.concat(F.lit("1"), docs[key_col].cast("string")), F.lit("0"))  # null first
    leaves = docs.select(
        key.alias("key"),
        docs[id_col].cast("long").alias("id"),
        F.unhex(digest([docs[c] for c in columns])).alias("leaf"),
        F.when(tampered, F.unhex(digest(changed))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("leaf"), F.col("row")]
    nodes = numbered(leaves, "key", order, "manifest-leaves").withColumnRenamed(RANK, "place")
    rounds = _rounds(nodes.select("key", "place", "id", "leaf", "tampered"), s, True, "manifest")

    subroots = rounds[-1].select(
        F.lit("").alias("tree"), "key", F.lit(None).cast("long").alias("id"), F.col("root").alias("leaf"),
        F.lit(None).cast("binary").alias("tampered"),
    )
    keys = staged(numbered(subroots, "tree", [F.col("key").asc()], "manifest-keys"), "manifest-places")
    upper = _rounds(
        keys.select(F.col("tree").alias("key"), F.col(RANK).alias("place"), "id", "leaf", "tampered"), s, False, "manifest-top"
    )
    top = upper[-1].select("root").first()
    root = top["root"].hex().encode() if top else b""

    start = upper[-1].select("key", "block", F.col("root").alias("top"), F.lit(b"").alias("path"))
    lowest = _paths(upper, start, s, "manifest-top-paths")
    of_keys = staged(
        upper[0].join(lowest, ["key", "block"]).select("key", "block", "leaves", "top", "path")
        .mapInArrow(_descend(s), "key string, block long, top binary, path binary"),
        "manifest-key-paths",
    )
    at_key = keys.select("key", F.col("leaf").alias("top"), F.col(RANK).alias("place")).join(
        of_keys.select(F.col("block").alias("place"), "path"), "place"
    )
    tops = at_key.select("key", F.lit(0).cast("long").alias("block"), "top", "path")
    paths = _paths(rounds, tops, s, "manifest-paths")
    blocks = rounds[0].join(paths, ["key", "block"]).select("block", "leaves", "ids", "tampered", "top", "path")
    return blocks.mapInArrow(_prove(s, root), ROWS)
