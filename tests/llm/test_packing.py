from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer
import public_tokenizers

from strata.llm import packing
from strata.llm.packing import Encoder, PackSettings, best_cuts, cut_points, pack

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PackSettings())


def test_ids_equal_those_of_the_tokenizer(encoder):
    latin = "".join(map(chr, range(0x250)))
    texts = [latin, latin[::-1], "a<|endoftext|> b  \n\n c", "naïve déjà  vu\t\t x", "日本語 and – dash", " " * 5000, "a" * 5000,
             "x" + "\n" * 3000 + "y", "don't we'll I'M", "\x85\x1c\x1d y\xa0\xa0 z", "1²³ ½x", "🙂 ok"]
    for a, b in itertools.product("a 1.\n\t\xa0\x85é²'", repeat=2):
        texts += [c + a + b + "s" for c in latin[:: 7]]
    for text in texts:
        assert encoder(text).tolist() == ids_of(text)[:-1], text[:40]


def cost(cuts, places, penalty, s):
    at = {p: c for p, c in zip(places, penalty)}
    total = 0
    for a, b in zip(cuts, cuts[1:]):
        n = b - a
        pad = 0 if n >= s.shortest_power and n & (n - 1) == 0 else s.length - n
        total += pad + at[b]
    return total


def test_cuts_are_the_cheapest():
    s = PackSettings(length=16, shortest_power=4, stride=8, sentence_penalty=1, cut_penalty=3, window_penalty=0.5)
    random = np.random.default_rng(3)
    for _ in range(60):
        size = int(random.integers(1, 45))
        ends = random.random(size) < 0.2
        doc_ends = np.unique(np.append(random.integers(1, size + 1, 2), size))
        places, penalty = cut_points(ends, doc_ends, s)
        found = best_cuts(places, penalty, s, True)
        assert found[0] == 0 and found[-1] == size and max(np.diff(found)) <= 16
        least = {0: 0.0}
        for j in range(1, len(places)):
            least[j] = min(least[i] + cost([places[i], places[j]], places, penalty, s) for i in range(j)
                           if places[j] - places[i] <= 16)
        assert cost(found, places, penalty, s) == pytest.approx(least[len(places) - 1])


def test_round_trip(spark, monkeypatch):
    random = np.random.default_rng(5)
    texts = [None, "", "  ", "same text.", "same text.", "long " * 9000]
    texts += [" ".join(["word" + str(i) + ("." if random.random() < 0.1 else "") for i in random.integers(0, 99, n)])
              for n in random.integers(1, 900, 60)]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)] + [(3, "same text.", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string").coalesce(2)
    got = pack(docs, settings=PackSettings(block=1 << 13)).toPandas()
    want = sorted(zlib.crc32(np.array(ids_of(t), "<u4").tobytes()) for _, t, _ in rows)
    whole, used = [], 0
    for _, g in got.groupby("doc_id", dropna=False):
        g = g.sort_values(["start", "sequence_id"])
        if g["doc_tokens"].iloc[0] * len(g[g.start == 0]) == g["length"].sum() and len(g[g.start == 0]) > 1:
            whole += [zlib.crc32(x) for x in g["ids"]]
            continue
        assert (g["start"].to_numpy() == np.cumsum([0, *g["length"][:-1]])).all()
        assert (g["doc_tokens"] == g["length"].sum()).all()
        whole.append(zlib.crc32(b"".join(g["ids"])))
    assert sorted(whole) == want
    windows = got.groupby("sequence_id")["length"].sum()
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g["offset"].to_numpy() == np.cumsum([0, *g["length"][:-1]])).all()
    assert windows.max() <= 2048
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in windows)
    assert padding < 0.02 * windows.sum() + 2 * 2048


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert packing.PIECES.startswith("doc_id")
