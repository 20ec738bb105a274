"""Personal data by bootstrapped contextual extraction (operator 10).

Base rules find e-mail addresses, IPv4 addresses, card and phone numbers in
whole texts. They are the seeds. The one and the two words before a seed are
lexical patterns; tokens with digits that no base rule covers are candidate
identifiers, tied to the patterns before them.

1. One pass gives each document's base spans, candidates and patterns; it is staged.
2. Patterns that stand before at least ``support`` different instances, the only ones
   that any round can admit, are looked up in the whole corpus, through a Bloom filter
   of bounded size, to count how often they occur at all, with a blank after them or
   glued to what follows (``ref=``, ``<``).
3. Spark scores the graph of patterns and instances in rounds. A round admits the
   patterns that stand before ``support`` different seeds; a pattern is as reliable as
   the share of its occurrences followed by trusted instances, an instance as trusted as
   the round's patterns before it together. Instances trusted by ``promote`` or more are
   seeds of the next round beside the base rules' own, whose trust stays 1; so each
   round reaches patterns and identifiers one hop further. After ``rounds`` rounds it ends.
4. Candidates behind a pattern of reliability ``confidence`` or more become spans of
   kind ``context``; base spans stay as they are.

No text is shuffled. A pattern or an instance of very many rows is split over several
join keys. Offsets are code points, ends exclusive.

Defined cases: null texts count as empty and have no spans; a text of many
spans is handled whole; rows alike in id and text have the same spans; rows
without id have base spans and feed patterns, but get no ``context`` spans; an
empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm import bloom
from strata.llm.common import PREFIX, long_id, staged

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

_EMAIL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_NOT_DIGIT = re.compile("[^0-9]+")
_EDGES = "\"'`()[]{}<>.,;:!?#*$%&|="
_ANY_DIGIT = str.maketrans("123456789ς", "000000000σ")  # a final sigma too, as what follows a word decides on it
_LEFT = 200  # characters before a place that are looked at
# where a seed or a candidate can begin inside a token, as ``_tokens`` gives it
_SPLIT = re.compile(r"(?<=[^a-z0-9._%+-])|(?<=[" + re.escape(_EDGES) + r"])|(?<![0-9])(?=[0-9])|(?=\+)")
_AFTER_DOMAIN = re.compile("(?=[._%])")  # an address can begin where the last one's domain ends


@dataclass(frozen=True)
class PiiSettings:
    support: int = 3  # different seeds behind a pattern
    confidence: float = 0.5  # reliability of a pattern whose candidates become spans
    promote: float = 0.8  # trust that makes a candidate a seed of the next round
    rounds: int = 3
    least_digits: int = 4  # in a candidate
    least_chars: int = 5
    most_chars: int = 64
    most_filter_bits: int = bloom.MOST_BITS
    hot_rows: int = 256  # rows of a key in one join task, or a 100,000th of all rows if that is more


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            found.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def candidates(text: str, covered: list[tuple[str, int, int]], s: PiiSettings) -> list[tuple[int, int]]:
    """Tokens with digits, trimmed of punctuation, that touch no covered span."""
    spans = sorted((a, b) for _, a, b in covered)
    found, end, k = [], 0, 0
    for m in _DIGITS.finditer(text):
        if m.start() < end:
            continue
        start, end = m.start(), m.end()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        a, b = start, end
        while a < b and text[a] in _EDGES:
            a += 1
        while b > a and text[b - 1] in _EDGES:
            b -= 1
        if "=" in text[a:b]:
            a += text[a:b].rindex("=") + 1
            while a < b and text[a] in _EDGES:
                a += 1
        if not s.least_chars <= b - a <= s.most_chars or len(_NOT_DIGIT.sub("", text[a:b])) < s.least_digits:
            continue
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        if not any(x < b and y > a for x, y in spans[k : k + 8]):
            found.append((a, b))
    return found


class _Words(dict):
    """64-bit hash of a pattern's word."""

    limit = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return value


class _Glued(dict):
    """Hashes of a token's beginnings before which a seed or a candidate can stand: ``ref=`` of ``ref=00000``."""

    limit = 500_000

    def __init__(self, words: _Words):
        self.words = words

    def __missing__(self, token: str) -> list[int]:
        ends = {m.start() for m in _SPLIT.finditer(token)}
        if "@" in token:
            ends |= {m.start() for m in _AFTER_DOMAIN.finditer(token, token.index("@"))}
        value = [self.words[token[max(0, end - _LEFT) : end]] for end in sorted(ends - {0, len(token)})]
        if len(token) <= _LEFT:
            if len(self) >= self.limit:
                self.clear()
            self[token] = value
        return value


def _tokens(text: str) -> list[str]:
    return text.lower().translate(_ANY_DIGIT).split()


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _patterns(text: str, start: int, words: _Words) -> list[int]:
    """Hashes of the one and the two words before ``start``, on its line."""
    left = text[max(0, start - _LEFT) : start]
    left = left[left.rfind("\n") + 1 :]
    before = _tokens(left)[-2:]
    if not before:
        return []
    one = np.array([words[before[-1]]], dtype=np.uint64)
    if len(before) == 1:
        return [int(one.view(np.int64)[0])]
    two = _pair(np.array([words[before[0]]], dtype=np.uint64), one)
    return [int(one.view(np.int64)[0]), int(two.view(np.int64)[0])]


_SPAN = T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())
_PLACE = (
    T.StructType()
    .add("seed", T.BooleanType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("instance", T.LongType())
    .add("patterns", T.ArrayType(T.LongType()))
)
_FOUND = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("text_crc", T.LongType())
    .add("base", T.ArrayType(_SPAN))
    .add("places", T.ArrayType(_PLACE))
)


def _find(s: PiiSettings):
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_crc", pa.int64()),
            ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
            (
                "places",
                pa.list_(
                    pa.struct(
                        [
                            ("seed", pa.bool_()),
                            ("start", pa.int32()),
                            ("end", pa.int32()),
                            ("instance", pa.int64()),
                            ("patterns", pa.list_(pa.int64())),
                        ]
                    )
                ),
            ),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()

        def place(text: str, seed: bool, start: int, end: int) -> dict:
            key = xxhash.xxh3_64_intdigest(text[start:end].lower().encode("utf-8", "replace"))
            return {
                "seed": seed, "start": start, "end": end, "instance": key - (key >> 63 << 64),
                "patterns": _patterns(text, start, words),
            }

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                base = base_spans(text)
                places = [place(text, True, a, b) for _, a, b in base]
                places += [place(text, False, a, b) for a, b in candidates(text, base, s)]
                out.append(
                    {
                        "doc_id": doc_id,
                        "text_crc": zlib.crc32(text.encode("utf-8", "replace")),
                        "base": [{"kind": k, "start": a, "end": b} for k, a, b in base],
                        "places": places,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows


def _occurrences(sent):
    """How often each pattern of the filter occurs, as whole words or glued to what follows: (pattern, n), summed in each batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held = _Words(), sent.value
        glued = _Glued(words)
        for batch in batches:
            found = []
            for text in batch.column(0):
                tokens = _tokens(text.as_py() or "")
                one = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
                inside = list(map(glued.__getitem__, tokens))
                part = np.fromiter(chain.from_iterable(inside), dtype=np.uint64)
                at = np.repeat(np.arange(len(tokens)), np.fromiter(map(len, inside), dtype=np.int64, count=len(tokens)))
                after = at > 0
                for hashes in (one, _pair(one[:-1], one[1:]), part, _pair(one[at[after] - 1], part[after])):
                    found.append(hashes[bloom.passes(held, hashes.view(np.int64))])
            keys, counts = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["pattern", "n"]
            )

    return rows


def _hot(rows: DataFrame, key: str, weight: str, s: PiiSettings) -> DataFrame:
    """(key, parts) of the keys with many rows: below 100,000 keys, as each holds a 100,000th of all rows at least."""
    sizes = staged(rows.groupBy(key).agg(F.sum(weight).alias("size")), "pii-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    least = max(s.hot_rows, -(-total // 100_000))
    return sizes.where(F.col("size") > least).select(key, F.ceil(F.col("size") / least).alias("parts"))


def _split(rows: DataFrame, hot: DataFrame, key: str, by: list[str], part: str) -> DataFrame:
    """``rows`` with the part of ``key`` that each belongs to, by a hash of ``by``."""
    at = F.pmod(F.xxhash64(*by), F.coalesce("parts", F.lit(1).cast("long")))
    return rows.join(F.broadcast(hot), key, "left").select(*rows.columns, at.alias(part))


def _copied(rows: DataFrame, hot: DataFrame, key: str, part: str) -> DataFrame:
    """``rows``, one for each key, once for each part of their key."""
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1)
    return rows.join(F.broadcast(hot), key, "left").select(*rows.columns, F.explode(parts).alias(part))


def _graph(texts: DataFrame, edges: DataFrame, hot: DataFrame, s: PiiSettings) -> DataFrame:
    """``edges`` of the patterns with ``support`` instances, with ``seen``: how often the pattern occurs in all texts."""
    spark = texts.sparkSession
    usual = edges.groupBy("pattern").agg(F.count("*").alias("instances")).where(F.col("instances") >= s.support)
    usual = staged(usual.select("pattern"), "pii-patterns")
    sent = spark.sparkContext.broadcast(bloom.build(usual, bloom.bits_for(usual.count(), s.most_filter_bits)))
    seen = texts.mapInArrow(_occurrences(sent), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("seen"))
    counted = usual.join(seen, "pattern", "left").select("pattern", F.coalesce("seen", F.lit(0)).alias("seen"))
    edges = _split(edges, hot, "pattern", ["instance"], "pattern_part")
    return edges.join(_copied(counted, hot, "pattern", "pattern_part"), ["pattern", "pattern_part"])


def _reliable_patterns(texts: DataFrame, found: DataFrame, s: PiiSettings) -> tuple[DataFrame, DataFrame]:
    """(pattern, reliability) of the patterns admitted in ``rounds`` rounds over the graph, and the hot patterns."""
    edges = (
        found.select(F.explode("places").alias("p"))
        .select(F.col("p.seed").alias("seed"), F.col("p.instance").alias("instance"), F.explode("p.patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    )
    edges = staged(edges, "pii-edges")
    hot = _hot(edges, "pattern", "n", s)
    graph = _graph(texts, edges, hot, s)
    hot_instances = _hot(edges.withColumn("n", F.lit(1)), "instance", "n", s)
    graph = staged(_split(graph, hot_instances, "instance", ["pattern"], "instance_part"), "pii-graph")
    known = graph.groupBy("instance").agg(F.max("seed").cast("double").alias("trust"))
    for _ in range(s.rounds):
        trusted = _copied(known.where("trust > 0"), hot_instances, "instance", "instance_part")
        patterns = (
            graph.join(trusted, ["instance", "instance_part"], "left")
            .groupBy("pattern")
            .agg(
                (F.sum(F.coalesce("trust", F.lit(0.0)) * F.col("n")) / F.greatest(F.max("seen"), F.sum("n"))).alias("reliability"),
                F.count_if(F.col("trust") >= s.promote).alias("seeds"),
            )
            .where(F.col("seeds") >= s.support)
            .select("pattern", "reliability")
        )
        patterns = staged(patterns, "pii-patterns")
        doubt = F.sum(F.log(F.greatest(1 - F.coalesce("reliability", F.lit(0.0)), F.lit(1e-12))))
        known = (
            graph.join(_copied(patterns, hot, "pattern", "pattern_part"), ["pattern", "pattern_part"], "left")
            .groupBy("instance")
            .agg(F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(doubt)).alias("trust"))
        )
    return patterns, hot


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: PiiSettings = PiiSettings()
) -> DataFrame:
    """(doc_id, text_crc, base, spans), one row per row of ``docs``.

    ``base`` and ``spans`` are arrays of (kind, start, end): the base rules' spans by
    kind as listed, then start; and those with the ``context`` spans after them.
    """
    s = settings
    given = docs.select(long_id(docs, id_col).alias("doc_id"), docs[text_col].alias("text"))
    found = staged(given.mapInArrow(_find(s), _FOUND), "pii")
    patterns, hot = _reliable_patterns(given.select("text"), found, s)
    good = _copied(patterns.where(F.col("reliability") >= s.confidence), hot, "pattern", "part")
    places = (
        found.where("doc_id IS NOT NULL")
        .select("doc_id", "text_crc", F.explode("places").alias("p"))
        .where("NOT p.seed")
        .select("doc_id", "text_crc", "p.start", "p.end", F.explode("p.patterns").alias("pattern"))
    )
    more = (
        _split(places, hot, "pattern", ["doc_id", "text_crc", "start"], "part")
        .join(good, ["pattern", "part"], "leftsemi")
        .groupBy("doc_id", "text_crc")
        .agg(F.array_sort(F.collect_set(F.struct(F.lit(CONTEXT).alias("kind"), "start", "end"))).alias("more"))
    )
    return found.join(more, ["doc_id", "text_crc"], "left").select(
        "doc_id", "text_crc", "base", F.concat("base", F.coalesce("more", F.array().cast("array<" + _SPAN.simpleString() + ">"))).alias("spans")
    )


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        ),
        ",",
    )


@F.pandas_udf(T.StringType())
def _masked(text: pd.Series, spans: pd.Series) -> pd.Series:
    def mask(value: str | None, found) -> str | None:
        if value is None or found is None or not len(found):
            return value
        out, done = [], 0
        for start, end, kind in sorted((x["start"], -x["end"], x["kind"]) for x in found):
            if start >= done:
                out += [value[done:start], f"<{kind.upper()}>"]
                done = -end
            elif -end > done:
                done = -end
        return "".join([*out, value[done:]])

    return pd.Series([mask(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)


def mask_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: PiiSettings = PiiSettings()
) -> DataFrame:
    """``docs`` with each span replaced by its kind, as ``<EMAIL>``; overlapping spans by the first one's."""
    found = find_pii(docs, id_col, text_col, settings).where(F.size("spans") > 0)
    marks = found.select(
        F.col("doc_id").alias(f"{PREFIX}id"), F.col("text_crc").alias(f"{PREFIX}crc"), F.col("spans").alias(f"{PREFIX}spans")
    ).dropDuplicates([f"{PREFIX}id", f"{PREFIX}crc"])
    same = docs[id_col].cast("long").eqNullSafe(marks[f"{PREFIX}id"]) & (
        F.crc32(F.coalesce(docs[text_col], F.lit(""))) == marks[f"{PREFIX}crc"]
    )
    joined = docs.join(marks, same, "left")
    return joined.withColumn(text_col, _masked(joined[text_col], F.col(f"{PREFIX}spans"))).select(*docs.columns)
