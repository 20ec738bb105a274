"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import resample
from strata.llm.resample import PositionTable, ResampleSettings

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("span", [3, 16, 256])
def test_position_table_gives_the_checksum(span):
    r = random.Random(span)
    spans = [r.randbytes(n) for n in [1, 2, 3, 4, 15, 16, 17, 255, 256, 257, 513, 70_000, 1]]
    got = PositionTable(span).crc32(np.frombuffer(b"".join(spans), dtype=np.uint8), np.array([len(s) for s in spans]))
    assert got.tolist() == [zlib.crc32(s) for s in spans]
    assert len(PositionTable(span).crc32(np.empty(0, dtype=np.uint8), np.empty(0, dtype=np.int64))) == 0


def features(text, s):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, s.longest_run + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(f.encode()) % s.buckets for f in runs], len(words)


def plain(docs, target, s):
    counts = [Counter(), Counter()]
    for k, texts in enumerate(([t for _, t in docs], target)):
        for t in texts:
            counts[k].update(features(t, s)[0])
    total = [sum(c.values()) for c in counts]

    def gain(b):
        top = (counts[1][b] + 1) * (total[0] + s.buckets)
        return math.floor(1000 * math.log(top / ((counts[0][b] + 1) * (total[1] + s.buckets))))

    rows = []
    for i, t in docs:
        found, words = features(t, s)
        weight = sum(map(gain, found))
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{s.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, words])
    able = sorted((r for r in rows if r[3] is not None and r[4] >= s.least_words), key=lambda r: (-r[3], r[0]))
    drawn = len(able) * s.percent // 100
    ranked = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return ranked + [(*r[:4], None) for r in rows if r[3] is None or r[4] < s.least_words]


def texts(n, seed):
    r = random.Random(seed)
    pool = ["river", "Stone", "house", "the", "of", "42nd", "größe", "naïve-ish", "日本", "x" * 700, "end."]
    return [" ".join(r.choice(pool) for _ in range(r.randrange(1, 60))) for _ in range(n)]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("settings", [ResampleSettings(), ResampleSettings(longest_run=3, buckets=97, batch_bytes=100, percent=37, span=8)])
def test_equals_the_plain_version(spark, settings):
    docs = list(enumerate(texts(120, 1)))
    docs += [(500, None), (501, ""), (502, " \x00 -- "), (None, docs[3][1]), (503, "Zebra " * 5000), (504, "y" * 200_000)]
    docs += [(7, docs[7][1])] * 40  # one row holds a fourth of the table
    target = ["the River of STONE " * 12, None, ""]
    given = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("'c' AS score", "doc_id", "text", "1 AS weight")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(given, wanted, settings=settings)
    assert got.columns[:3] == ["score", "doc_id", "weight"]
    rows = [(r["doc_id"], r["_strata_n_features"], r["_strata_weight"], r["_strata_score"], r["_strata_rank"]) for r in got.collect()]
    assert order(rows) == order(plain(docs, target, settings))
    assert any(r[4] for r in rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "the river " * 20)], "doc_id long, text string")
    none = docs.where("false")
    assert resample.resample(none, docs).count() == 0
    assert resample.resample(docs, none).first()["_strata_n_features"] == 40
