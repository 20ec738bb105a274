"""The Merkle manifest against a plain version, for keys of one to several rounds of blocks."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import manifest
from strata.llm.manifest import ManifestSettings, Tree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def leaf(row, lower=False):
    out = b""
    for name, value in zip(COLUMNS, row, strict=True):
        if value is None:
            out += b"-"
            continue
        text = str(value).translate(LOWER) if lower and name == "text" else str(value)
        out += f"{len(text.encode())}:".encode() + text.encode()
    return h(out)


def levels(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(tree, at, fanout):
    for nodes in tree[:-1]:
        first = at - at % fanout
        yield nodes[first:at], nodes[at + 1 : first + fanout]
        at //= fanout


def plain(rows, fanout):
    keys = sorted({r[1] for r in rows}, key=lambda k: (k is not None, (k or "").encode()))
    of = {k: sorted((r for r in rows if r[1] == k), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in keys}
    trees = {k: levels([leaf(r) for r in of[k]], fanout) for k in keys}
    top = levels([trees[k][-1][0] for k in keys], fanout)
    root = top[-1][0]
    out = []
    for n, k in enumerate(keys):
        for i, r in enumerate(of[k]):
            path = [*siblings(trees[k], i, fanout), *siblings(top, n, fanout)]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, tampered)
            for left, right in path:
                folded = h("".join([*left, folded, *right]))
            proof = h("".join(x for left, right in path for x in (*left, *right)))
            out.append((r[0], leaf(r), trees[k][-1][0], root, proof, folded, folded == root))
    return out


def table(n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choice(["hot", "hot", None, "a", "é", "Z", f"s{r.randrange(25)}"])
        text = r.choice([None, "", "Plain Text", "lower", "ÄÖ x" * r.randrange(9), "T" * 70_000])
        rows.append((i * 3, source, r.choice([None, "en"]), r.choice([None, i]), text))
    rows += [(None, "hot", "en", 1, "No id")] * 3 + [(5, "hot", "en", 1, "Same Id")] * 9 + [(5, "hot", "en", 2, "Other")]
    return rows


@pytest.mark.parametrize("settings", [ManifestSettings(), ManifestSettings(fanout=3, levels=2), ManifestSettings(fanout=2, levels=1)])
def test_equals_the_plain_version(spark, settings):
    rows = table(300 if settings.levels > 1 else 60)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumn("key", F.lit("clash")).withColumn("leaf", F.lit(1)).repartition(5)
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    got = manifest.manifest(docs, tampered, settings=settings)
    found = [tuple(r)[:7] for r in got.collect()]
    assert sorted(found, key=repr) == sorted(plain(rows, settings.fanout), key=repr)
    assert any(not r[6] for r in found)


def test_one_row_and_no_row(spark):
    docs = spark.createDataFrame([(5, None, None, None, "AbC")], "doc_id long, source string, lang string, n_chars long, text string")
    row = manifest.manifest(docs, F.lit(True)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf((5, None, None, None, "AbC"))
    assert row["proof_sha256"] == h("") and row["folded_root"] == leaf((5, None, None, None, "AbC"), True)
    assert not row["verified"] and row["copied"] == 1
    assert manifest.manifest(docs.where("false"), F.lit(True)).count() == 0


def test_a_version_shares_what_it_does_not_copy():
    leaves = [h(str(i)).encode() for i in range(70)]
    tree = Tree(leaves, 16)
    before = [list(nodes) for nodes in tree.levels]
    changed = h("x").encode()
    version = tree.version(37, changed)
    assert set(version) == {(0, 37), (1, 2), (2, 0)} and tree.levels == before
    assert version[2, 0] == Tree([*leaves[:37], changed, *leaves[38:]], 16).root
