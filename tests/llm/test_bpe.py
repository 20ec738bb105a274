"""BPE by a pair occurrence index, against the library it must equal."""

from __future__ import annotations

import json
import random
from itertools import chain

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import bpe

ODD = [
    None, "", "   ", "Hello <|endoftext|> Wörld's", "a" * 3000, "ab" * 2000 + "İ" + "Σ ΑΣ", "日本語テキスト 👍🏽 नमस्ते",
    "<|startoftext|><|endoftext|>x", "\x00\x1c\x1f\x85\xa0 a", "it's 'SAT''S we'LL", " < | <|end", "é K Å",
]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec()


def same(codec, texts):
    ids = codec.encode(texts)
    for text, coded in zip(texts, ids, strict=True):
        want = codec.library.encode(text or "", add_special_tokens=False).ids
        assert np.array(want, dtype="<u4").tobytes() == coded, text
        assert codec.library.decode(want, skip_special_tokens=False) == codec.decode(coded), text


def test_equals_the_library_on_every_character_of_the_plain_rule(codec):
    signs = chain(range(0x260), range(0x2000, 0x2070), [0x20AC])
    same(codec, ODD + [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}'s" for c in signs])


def test_equals_the_library_on_random_texts(codec):
    r = random.Random(5)
    same(codec, ["".join(r.choice("abestn's '’é.,!?ÀÉ12\nβЖ") for _ in range(r.randrange(120))) for _ in range(600)])


def test_blocks_and_cache_do_not_change_ids(codec):
    texts = [f"the {w} of rivers and stones {w * 30}" for w in ("walk", "bright", "Größe", "xyzzy")] * 3
    small = bpe.Codec(bpe.BpeSettings(block_chars=50, known_words=3))
    assert small.encode(texts) == codec.encode(texts)


@pytest.mark.parametrize("few", [0, 3, 10_000])
def test_single_and_array_merges_agree(codec, monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    r = random.Random(9)
    words = ["".join(r.choice("thesaingrour") for _ in range(r.randrange(1, 30))) for _ in range(3000)]
    words += ["ll" * 50, "s" * 999, "é" * 40]
    want = [np.array(codec.library.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words]
    assert codec.merge_words(words) == want


def test_merges_out_of_order_are_refused(tmp_path, codec):
    with open(_path(), encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["merges"].reverse()
    broken = tmp_path / "reversed.json"
    broken.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="comes before"):
        bpe.Codec(bpe.BpeSettings(vocabulary=str(broken)))


def _path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_columns_stay_and_clashes_are_refused(spark, codec):
    rows = [(1, t, "x") for t in ODD] + [(None, "the house", "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    out = bpe.decode(bpe.encode(docs)).collect()
    assert len(out) == len(rows) and {r["decoded"] for r in out} == {"x", "y"}
    for r in out:
        ids = codec.library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.array(ids, dtype="<u4").tobytes() == bytes(r["_strata_ids"])
        assert codec.library.decode(ids, skip_special_tokens=False) == r["_strata_decoded"]
    assert bpe.encode(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, out="decoded")
    both = bpe.round_trip(docs).collect()
    assert [(r["_strata_coded"]["ids"], r["_strata_coded"]["text"]) for r in both] == [
        (r["_strata_ids"], r["_strata_decoded"]) for r in out
    ]
    gaps = spark.range(1).select(F.lit(np.array([5, 1 << 30], dtype="<u4").tobytes()).alias("i"))
    assert bpe.decode(gaps, "i").first()["_strata_decoded"] == codec.tokens[5]
