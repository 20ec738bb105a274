from __future__ import annotations

import random

import numpy as np
import pytest

from strata.llm import components as stars
from strata.llm.minhash import MinHashSettings, _WordHashes, drop_near_duplicates, near_duplicates, shingles


def plain_sets(text, size):
    words = text.encode().lower().split() if text else []
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain_components(rows, size):
    """Every pair compared."""
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(plain_sets(text, size))
    ids = sorted(i for i in sets if i is not None)
    label = {i: i for i in ids}

    def linked(a, b):
        return any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b])

    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] > label[a] and linked(a, b):
                    label[b], changed = label[a], True
                elif label[a] > label[b] and linked(a, b):
                    label[a], changed = label[b], True
    return label


def corpus(seed, families, copies, edits):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(families):
        base = r.choices(vocabulary, k=r.randint(60, 160))
        for _ in range(copies):
            words = list(base)
            for _ in range(r.randint(0, edits)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append((n * 7 % 1009, " ".join(words)))
            n += 1
    return rows


@pytest.mark.parametrize("size,tile", [(4, 2048), (5, 8)])
def test_components_equal_brute_force(spark, size, tile):
    rows = corpus(size, 8, 18, 5)
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one two"), (2004, "ONE  two"), (2005, "one two three")]
    rows += [rows[0], rows[3], (None, rows[0][1]), (2006, "x " * 20_000), (2007, "x " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    got = near_duplicates(docs, settings=MinHashSettings(words=size, tile=tile)).collect()
    want = plain_components(rows, size)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    counts = {r["doc_id"]: r["n_shingles"] for r in got}
    assert all(counts[i] == len(plain_sets(t, size)) for i, t in rows if i is not None)
    kept = drop_near_duplicates(docs, settings=MinHashSettings(words=size, tile=tile))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()))


def test_shingles():
    assert len(shingles(b"a b c d a b c d", 4, _WordHashes())) == 4
    assert len(shingles(b"a B", 4, _WordHashes())) == 1
    assert (shingles(b"a B", 4, _WordHashes()) == shingles(b"A b ", 4, _WordHashes())).all()
    assert len(np.intersect1d(shingles(b"a b", 4, _WordHashes()), shingles(b"b a", 4, _WordHashes()))) == 0


def test_empty_and_unlinked(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = near_duplicates(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in rows) == [(1, 1, True, 0), (2, 2, True, 0)]


def test_an_id_repeated_with_a_null_and_a_linked_text(spark):
    rows = corpus(4, 3, 8, 4)
    ids = [i for i, _ in rows]
    rows += [(i, t) for i in ids for t in (None, "", " ")] + [(None, None), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = MinHashSettings(words=4, tile=4)
    got = near_duplicates(docs, settings=settings).collect()
    want = plain_components(rows, 4)
    counted = {r["doc_id"]: r["component_id"] for r in got if r["n_shingles"] > 0 and r["doc_id"] is not None}
    assert len(got) == len(rows) and counted == want


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(10, 60)] + [(300, 200), (200, 300), (7, 7)]
    r.shuffle(links)
    got = {x["node"]: x["component"] for x in stars.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 5 for i in [5, *range(10, 60)])
    assert got[300] == got[200] == 200 and 7 not in got


def test_rows_of_one_id_are_one_document(spark):
    """Two texts under one id tie the documents that hold either; a chain of such ids goes on."""
    text = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcd"]
    rows = [(3, text[0]), (5, text[0]), (5, text[1]), (9, text[1]), (20, text[2]), (20, text[3]), (21, text[3]), (9, text[1]), (30, "x y")]
    want = plain_components(rows, 5)
    assert want == {3: 3, 5: 3, 9: 3, 20: 20, 21: 20, 30: 30}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(i, c, i == c) for i, c in want.items()}
    kept = {(r["doc_id"], r["text"]) for r in drop_near_duplicates(docs).collect()}
    assert kept == {(3, text[0]), (20, text[2]), (20, text[3]), (30, "x y")}
