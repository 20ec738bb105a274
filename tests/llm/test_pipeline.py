from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm.pii import base_spans
from tests.llm.test_minhash import plain_components

LINE = "This very long line of notice text stands in many documents."


def texts():
    r = np.random.default_rng(4)
    words = {"en": "the of and river stone house water green walking under bright".split(),
             "de": "der und nicht straße haus wasser grün gehen unter über schön".split()}
    out = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        body = [" ".join(r.choice(words[lang], 12)) + "." for _ in range(r.integers(3, 12))]
        if i % 9 == 0:
            body.insert(1, LINE + " " * (i % 4))
        if i % 10 == 0:
            body.append(f"write to a{i}@example.com or +1 (555) 010-{1000 + i} now.")
        out.append((i, "\n".join(body), lang, "s", 0))
    out += [(200 + i, out[5][1] + f"\nextra{i}", "en", "t", 0) for i in range(4)]
    out += [(300, "12345 !!! 999", "en", "t", 0), (301, None, "en", "t", 0), (302, "", None, "t", 0), out[7]]
    return out


def plain_run(rows):
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    holders = {}
    for i, t, *_ in rows:
        for line in t.split("\n"):
            key = line.strip().lower()
            if len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    cut = []
    for i, t, *_ in rows:
        lines = [x for x in t.split("\n")
                 if len(holders.get(x.strip().lower(), ())) < 5 or max(holders[x.strip().lower()]) == i]
        cut.append((i, "\n".join(lines)))
    label = plain_components(cut, 5)
    kept = sorted({(i, t) for i, t in cut if label[i] == i})
    out = {}
    for i, t in kept:
        for kind, a, b in sorted(base_spans(t), key=lambda x: -x[1]):
            t = t[:a] + f"<{kind.upper()}>" + t[b:]
        out[i] = t
    return out


def test_pipeline_equals_the_plain_run(spark, tmp_path):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    current = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
    want = plain_run(rows)
    got = current.collect()
    assert {r["doc_id"]: r["text"] for r in got} == want and len(got) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got if "<" in r["text"])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, g in pieces.groupby("doc_id"):
        ids = np.array(whole.encode(want[doc_id], add_special_tokens=False).ids + [1], "<u4")
        assert zlib.crc32(b"".join(g.sort_values("start")["ids"])) == zlib.crc32(ids.tobytes())
    assert set(pieces["doc_id"]) == set(want)


def test_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


