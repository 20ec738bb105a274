from __future__ import annotations

import re

import numpy as np
import pytest

from strata.llm import bloom, pii
from strata.llm.pii import PiiSettings, base_spans, find_pii, luhn, mask_pii


def plain_spans(text):
    """The rules as written, by the plain patterns."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


TEXTS = [
    "", "é a.b+c@x-y.co.uk, @ a@b a@b.c@d.e ..@..", "x@y.z@w.v q@r.s", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 5", "+1 (743) 555-3824 +12 +1 2 3 +44 20 7946 0958 99",
    "+1 743 555 3824+1 743 555 3824", "日本 +81 3-1234-5678 🙂 a@b.jp", "9" * 50, "1 2 3 4 5 6 7 8 9 0 1 2 3 4",
    "a" * 5000 + "@" + "b." * 300 + "c", "1." * 4000, "@" * 300,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_equals_the_plain_rules(text):
    assert base_spans(text) == plain_spans(text)


def test_long_texts_take_linear_time():
    for text in ("7" * 300_000, "a" * 300_000, "+1" * 100_000, "1-" * 100_000, "@a" * 100_000, "a.b" * 100_000 + "@"):
        base_spans(text)


def rows(spark):
    texts = [f"Please write. Member ref: mail{i}@example.com today" for i in range(6)]
    texts += ["Your Member ref: QX-48213-77 is new", "the 55321-a of Member ref: ZZ99881", "nothing to see the 99887-b"]
    texts += [f"the a{i}@example.com the and the or the if the but the" for i in range(6)]
    texts += [None, "", "x" * 50_000]
    data = [(i, t, "clash") for i, t in enumerate(texts)]
    data += [data[6], (None, "Member ref: 12345-9 a@b.cd", "n")]
    return spark.createDataFrame(data, "doc_id long, text string, spans string")


def test_context_spans(spark):
    docs = rows(spark)
    got = {(r["doc_id"]): r["spans"] for r in find_pii(docs).collect()}
    assert find_pii(docs).count() == docs.count()
    kinds = {k: [(s["kind"], s["start"], s["end"]) for s in v] for k, v in got.items()}
    assert kinds[6] == [("context", 17, 28)]
    assert kinds[7] == [("context", 27, 34)]  # "the" stands before seeds, but mostly before other words
    assert kinds[8] == [] and kinds[15] == [] and kinds[16] == []
    assert kinds[None] == [("email", 20, 26)]
    masked = {r["doc_id"]: r["text"] for r in mask_pii(docs).collect()}
    assert masked[6] == "Your Member ref: <CONTEXT> is new"
    assert masked[0] == "Please write. Member ref: <EMAIL> today"
    assert masked[15] is None and masked[16] == "" and len(masked[17]) == 50_000
    assert mask_pii(docs).columns == docs.columns and mask_pii(docs).count() == docs.count()


def test_patterns_glued_to_what_follows(spark):
    texts = [t.format(f"mail{i}@example.com") for t in ("see ref={} now", 'Ref: "{}" c', "user <{}> d") for i in range(4)]
    texts += ["see ref=QX-48213 now", 'Ref: "QX-48213" c', "user <QX-48213> d", "(ZZ-55512)"]
    texts += [f"so ({word}) the" for word in ("one", "two", "three", "four", "five", "six")] + [f"in ({i}x@example.com) by" for i in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in find_pii(docs).collect()}
    for i, start in ((12, 8), (13, 6), (14, 6)):
        assert got[i] == [("context", start, start + 8)], texts[i]
    assert got[15] == []  # most tokens behind the bracket are plain words


@pytest.mark.parametrize("text", [*TEXTS, 'x ref=QX-48213 "a.b@c.de" (+1 743 555 3824) ΑΣ:x1@y.zw ip1.2.3.4 a@b.c%d@e.fg é12345-6 é=<99999>'])
def test_every_pattern_is_counted(text):
    words = pii._Words()
    tokens = pii._tokens(text[:3000])
    known = {words[t] for t in tokens} | {h for t in tokens for h in pii._Glued(words)[t]}
    base = base_spans(text[:3000])
    starts = [a for _, a, _ in base] + [a for a, _ in pii.candidates(text[:3000], base, PiiSettings())]
    for found in (pii._patterns(text[:3000], a, words) for a in starts):
        assert not found or found[0] % 2**64 in known


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert find_pii(docs).count() == 0 and mask_pii(docs).count() == 0


class _Same(dict):
    """Words as they are, in place of their hashes."""

    def __missing__(self, word):
        return word


def plain_context(docs, s):
    """The rounds by plain loops over words: {doc_id: {(start, end)}} of the context spans."""
    occurs, ties, places = {}, {}, {}
    glued = pii._Glued(_Same())
    for doc_id, text in docs:
        text = text or ""
        tokens = pii._tokens(text)
        for i, token in enumerate(tokens):
            for word in [token, *glued[token]]:
                for pattern in [(word,)] + ([(tokens[i - 1], word)] if i else []):
                    occurs[pattern] = occurs.get(pattern, 0) + 1
        base = base_spans(text)
        found = [(True, a, b) for _, a, b in base] + [(False, a, b) for a, b in pii.candidates(text, base, s)]
        for seed, a, b in found:
            before = pii._tokens(text[:a].rpartition("\n")[2])[-2:]
            for pattern in {tuple(before[-1:]), tuple(before)} - {()}:
                old = ties.setdefault(pattern, {}).get(text[a:b].lower(), (False, 0))
                ties[pattern][text[a:b].lower()] = (old[0] or seed, old[1] + 1)
                if not seed and doc_id is not None:
                    places.setdefault(pattern, set()).add((doc_id, a, b))
    ties = {p: held for p, held in ties.items() if len(held) >= s.support}
    base = {i for held in ties.values() for i, (seed, _) in held.items() if seed}
    trust, reliable = dict.fromkeys(base, 1.0), {}
    for _ in range(s.rounds):
        reliable = {
            p: sum(trust.get(i, 0) * n for i, (_, n) in held.items()) / max(occurs.get(p, 0), sum(n for _, n in held.values()))
            for p, held in ties.items()
            if sum(trust.get(i, 0) >= s.promote for i in held) >= s.support
        }
        doubt = {}
        for p, share in reliable.items():
            for i in ties[p]:
                doubt[i] = doubt.get(i, 1.0) * max(1 - share, 1e-12)
        trust = {i: 1 - d for i, d in doubt.items()} | dict.fromkeys(base, 1.0)
    out = {}
    for p, share in reliable.items():
        if share >= s.confidence:
            for doc_id, a, b in places.get(p, ()):
                out.setdefault(doc_id, set()).add((a, b))
    return out


def planted():
    """Identifiers one, two and three hops from the e-mail addresses, and numbers behind an unreliable word."""
    ids = [f"QX-{48213 + i}" for i in range(12)]
    texts = [f"write to member ref: mail{i}@example.com today" for i in range(12)]
    texts += [f"the member ref: {x} is new" for x in ids[:6]]  # one hop
    texts += [f"open case file {x} again" for x in ids[:9]]  # ids 6 to 8 are two hops away
    texts += [f'see <dossier="{x}"> there' for x in ids[:2] + ids[6:11]]  # ids 9 and 10 are three
    texts += [f"in the year {2000 + i} all" for i in range(9)] + ["the year the year case of a folder " * 3, None, "", "ref:\n12345-6"]
    return [(i if i % 17 else None, t) for i, t in enumerate(texts, 1)]


@pytest.mark.parametrize("rounds", [1, 2, 3])
@pytest.mark.parametrize("hot_rows", [1, 256])
def test_each_round_reaches_one_hop_further(spark, rounds, hot_rows):
    docs, s = planted(), PiiSettings(rounds=rounds, hot_rows=hot_rows)
    frame = spark.createDataFrame(docs + docs[:3], "doc_id long, text string").repartition(3)
    got = {}
    for r in find_pii(frame, settings=s).collect():
        got.setdefault(r["doc_id"], set()).update((x["start"], x["end"]) for x in r["spans"] if x["kind"] == "context")
    want = plain_context(docs + docs[:3], s)
    assert {k: v for k, v in got.items() if v} == want
    texts = dict(docs)
    names = {texts[k][a:b] for k, v in want.items() for a, b in v}
    hops = {"QX-48213": 1, "QX-48219": 2, "QX-48222": 3}
    assert {x for x, hop in hops.items() if hop <= rounds} == names & set(hops)
    assert not any(x.startswith("20") for x in names)


def test_context_spans_of_the_tables_equal_the_plain_rounds(spark):
    """Loose bars, so that the words of real texts are admitted and scored over the rounds."""
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    s = PiiSettings(support=1, confidence=0.002, promote=0.004, hot_rows=4)
    want = plain_context([tuple(r) for r in frame.collect()], s)
    got = {}
    for r in find_pii(frame, settings=s).collect():
        got.setdefault(r["doc_id"], set()).update((x["start"], x["end"]) for x in r["spans"] if x["kind"] == "context")
    assert want and {k: v for k, v in got.items() if v} == want


def test_filter_grows_with_its_keys_and_holds_them_all(spark):
    assert [bloom.bits_for(n) for n in (0, 1, 1 << 16, (1 << 16) + 1, 1 << 40)] == [1 << 20, 1 << 20, 1 << 20, 1 << 21, bloom.MOST_BITS]
    for n in (0, 1, 200_000):
        keys = spark.range(0, 3 * n, 3, numPartitions=12)
        held = bloom.build(keys, bloom.bits_for(n))
        assert len(held) * 8 == bloom.bits_for(n)
        assert bloom.passes(held, np.arange(0, 3 * n, 3)).all()
        assert bloom.passes(held, np.arange(-300_001, 0)).mean() < 0.03
