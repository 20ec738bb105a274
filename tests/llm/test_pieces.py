from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.pieces import Lattices, PieceSettings, Vocabulary, decode, encode, sample_texts, sampled_with_check

S = PieceSettings()


@pytest.fixture(scope="module")
def v():
    return Vocabulary(S)


def paths(word, v):
    """Every segmentation and its weight."""
    if not word:
        return [((), 0.0)]
    out = []
    for n in range(1, len(word) + 1):
        if word[:n] in v.pieces:
            i = v.pieces[word[:n]]
            out += [((i, *rest), w + v.weights[i]) for rest, w in paths(word[n:], v)]
    if word[0] not in v.pieces:
        raw = word[0].encode()
        ids = tuple(int(v.byte_ids[b]) for b in raw)
        out += [(ids + rest, w + len(raw) * S.byte_weight) for rest, w in paths(word[1:], v)]
    return out


@pytest.mark.parametrize("text", ["hello", "thé", "a 🙂", "in"])
def test_shares_equal_the_enumerated_ones(v, text):
    words = [w for w in ([" " + text] if " " not in text else [" a", " 🙂"])]
    every = {(): 0.0}
    for w in words:
        every = {a + b: x + y for a, x in every.items() for b, y in paths(w, v)}
    total = sum(math.exp(x) for x in every.values())
    n = 40_000
    ids, counts = sample_texts([text] * n, np.arange(n, dtype=np.uint64), v, S)
    ends = np.cumsum(counts)
    seen = Counter(tuple(ids[e - c : e].tolist()) for e, c in zip(ends, counts, strict=True))
    assert set(seen) <= set(every)
    for path, weight in every.items():
        share = math.exp(weight) / total
        assert abs(seen[path] / n - share) < 4 * math.sqrt(share / n) + 5e-4


def test_edges_are_all_the_matching_pieces(v):
    words = [" other", "x", "日本🙂", " " * 20, "\n", " th"]
    found = Lattices(words, v, S)
    want = 0
    for w in words:
        for i in range(len(w)):
            inside = [w[i:j] for j in range(i + 1, len(w) + 1) if w[i:j] in v.pieces]
            want += len(inside) + (w[i] not in inside)
    assert len(found.piece) == want


TEXTS = [
    "plain words here", "", " ", "  two  blanks  ", "tab\tand\nline\n\n  x", "▁ literal ▁▁x▁", "é 日本語 🙂 \x00\x01", "a" * 5000,
    "none" + " " * 3000 + "end", "�   \xa0", "the end. " * 2000, None,
]


def test_round_trip_and_reproducible(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x"), (None, "no id", "y"), (77, TEXTS[0], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lossless string")
    docs = docs.withColumn("pieces", F.lit("own"))
    out = "_strata_pieces"
    one = encode(docs.coalesce(1)).withColumn("again", decode(F.col(out))).collect()
    many = encode(docs.repartition(5)).collect()
    assert {r["pieces"] for r in one} == {"own"} and {r["lossless"] for r in one} == {"x", "y", "z"}
    assert all(r["again"] == r["text"] for r in one)
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["lossless"])
    assert [r[out] for r in sorted(one, key=key)] == [r[out] for r in sorted(many, key=key)]
    by_id = {r["doc_id"]: r[out] for r in one}
    assert by_id[1] == [] and by_id[11] is None
    long_text = {r["doc_id"]: r[out] for r in encode(spark.createDataFrame([(1, TEXTS[10]), (2, TEXTS[10])], "doc_id long, text string")).collect()}
    assert long_text[1] != long_text[2]
    both = sampled_with_check(docs, "doc_id", "text")
    assert both.where("NOT _strata_lossless").count() == 0 and both.where("lossless IN ('x', 'y', 'z')").count() == len(rows)


def test_shares_do_not_hang_on_the_words_beside(v):
    r = np.random.default_rng(3)
    words = [" " + "".join(r.choice(list("theandingsor"), r.integers(1, 25))) for _ in range(4000)]
    whole, half = Lattices(words, v, PieceSettings()), Lattices(words[2000:], v, PieceSettings())
    assert _by_word(whole, 2000) == _by_word(half, 0)


def _by_word(lattices, first):
    """The shares of each word from ``first`` on."""
    out = []
    for a, b in zip(lattices.first[first:], lattices.last[first:], strict=True):
        shares = []
        for node in range(a + 1, b + 1):
            at = lattices.into[node]
            while True:
                shares.append(float(lattices.cumulative[at]))
                if shares[-1] == 2.0:
                    break
                at += 1
        out.append(shares)
    return out


def test_sharp_sampling_is_the_best_path(v):
    sharp = Vocabulary(PieceSettings(sharpness=200.0))
    ids, _ = sample_texts(["other"], np.array([5], dtype=np.uint64), sharp, PieceSettings(sharpness=200.0))
    assert tuple(ids.tolist()) == max(paths(" other", v), key=lambda p: p[1])[0]


def test_empty(spark):
    assert encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0
