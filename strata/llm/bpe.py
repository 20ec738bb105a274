"""BPE encoding and decoding by an index of pair occurrences (operator 11).

A task takes its texts in blocks, splits them into words and sets the symbols of all
words it has not met before side by side. An index maps each pair that a merge rule
knows to all its positions in the block. The ranks that have positions are then
applied in ascending order, each to all its positions from left to right, and the
lists of the two neighbouring pairs are updated after each merge. A pair that holds
a merged symbol always has a higher rank than the merge that made the symbol (checked
when the vocabulary is read), so one pass over the ascending ranks gives, in each
word, what the textbook rule (merge the best pair of the word, again and again) gives.

Ids are those of the ``tokenizers`` library for the same file. Texts of Latin letters
and common punctuation are split by one regular expression (equal to the library's
rule for every character it is used for, which a test checks); all others by the
library's own normalizer and pre-tokenizer. Special tokens written in a text become
their ids, as in the library.

Work is linear in the text. A task holds the word numbers of one block of texts
(``block_chars`` characters, or one text), the index of its new words, and the ids of the
words met before, which it forgets after a block with which they exceed ``known_words``.

Defined cases: null and empty texts, and texts of blanks alone, have no ids and decode
to the empty text; very long words go through the same index; repeated rows are coded
each; an empty table gives no row; other columns are kept.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.common import PREFIX, worker_cache

# The normalizer and pre-tokenizer for which ``PLAIN_WORD`` holds.
PLAIN_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
LETTERS = "a-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
BLANKS = "\\t-\\r \\x85\\xa0"
PLAIN_WORD = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+"
# Characters that need the library's rules: all but the Latin letters up to U+017F whose small
# form is one letter, and the dashes, quotation marks, dots and signs from U+2010 on.
NOT_PLAIN = "[^\\x00-\\u012f\\u0131-\\u017f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]"


@dataclass(frozen=True)
class BpeSettings:
    vocabulary: str | None = None  # a tokenizers file; by default word_bpe_49k.json of public_tokenizers
    block_chars: int = 16_000_000
    known_words: int = 400_000  # kept from block to block


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Partners:
    """The merges of each symbol on one side, by the symbol on the other side."""

    def __init__(self, of: np.ndarray, other: np.ndarray, size: int):
        self.rank = np.lexsort((other, of)) if len(of) else np.empty(0, dtype=np.int64)
        self.other = other[self.rank].astype(np.int32)
        self.edges = np.searchsorted(of[self.rank], np.arange(size + 1)).tolist()

    def ranks(self, symbol: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``others`` merge with ``symbol``, the ranks of these merges)."""
        a, b = self.edges[symbol], self.edges[symbol + 1]
        if a == b:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        partners = self.other[a:b]
        at = np.minimum(np.searchsorted(partners, others), b - a - 1)
        known = np.flatnonzero(partners[at] == others)
        return known, self.rank[a + at[known]]


FEW = 16  # positions that are merged one by one; more are merged by array operations


def _merged(codec: Codec, data: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Symbols of words after all merges, -1 where a symbol went into its left neighbour.

    ``data``: the bytes of all words, ``lasts``: the place of each word's last byte.
    """
    n = len(data)
    sym = np.empty(n + 1, dtype=np.int32)  # place n stands for no neighbour
    sym[:n] = codec.byte_ids[data]
    sym[lasts] = codec.last_ids[data[lasts]]
    sym[n] = -2
    after = np.arange(1, n + 2, dtype=np.int32)
    after[lasts] = n
    before = np.arange(-1, n, dtype=np.int32)
    before[0] = n
    before[lasts[:-1] + 1] = n
    one_sym, one_after, one_before = memoryview(sym), memoryview(after), memoryview(before)

    index: dict[int, list] = {}  # rank -> positions of its pair, single or in arrays
    active: list[int] = []
    rank_of, merges, size = codec.ranks.get, codec.merges, codec.size

    def note(known: int, place: object) -> None:
        places = index.get(known)
        if places is None:
            index[known] = [place]
            heapq.heappush(active, known)
        else:
            places.append(place)

    def note_all(known: np.ndarray, places: np.ndarray) -> None:
        if len(known) <= FEW:
            for k, place in zip(known.tolist(), places.tolist(), strict=True):
                note(k, place)
            return
        order = np.argsort(known, kind="stable")
        known, places = known[order], places[order]
        edges = np.flatnonzero(np.diff(known, prepend=-1))
        for k, group in zip(known[edges].tolist(), np.split(places, edges[1:]), strict=True):
            note(k, group)

    def merge_one(p: int, left: int, right: int, new: int) -> None:
        q = one_after[p]
        if one_sym[p] != left or one_sym[q] != right:
            return
        r, back = one_after[q], one_before[p]
        one_sym[p], one_sym[q], one_after[p] = new, -1, r
        if r < n:
            one_before[r] = p
            known = rank_of(new * size + one_sym[r])
            if known is not None:
                note(known, p)
        if back < n:
            known = rank_of(one_sym[back] * size + new)
            if known is not None:
                note(known, back)

    pairs = np.flatnonzero(after[:n] < n)
    keys = sym[pairs].astype(np.int64) * size + sym[after[pairs]]
    kinds, kind_of = np.unique(keys, return_inverse=True)
    known = np.array([rank_of(k, -1) for k in kinds.tolist()], dtype=np.int64)[kind_of]
    note_all(known[known >= 0], pairs[known >= 0].astype(np.int32))

    while active:
        now = heapq.heappop(active)
        left, right, new = merges[now]
        held = index.pop(now)
        arrays = [x for x in held if type(x) is not int]
        places = np.sort(np.concatenate([*arrays, np.array([x for x in held if type(x) is int], dtype=np.int32)]))
        if len(places) <= FEW or left == right:  # like symbols may overlap: from left to right
            for p in places.tolist():
                merge_one(p, left, right, new)
            continue
        p = places[(sym[places] == left) & (sym[after[places]] == right)]
        q = after[p]
        r = after[q]
        sym[p], sym[q], after[p] = new, -1, r
        before[r] = p
        which, found = codec.after_left.ranks(new, sym[r])
        note_all(found, p[which])
        back = before[p]
        which, found = codec.before_right.ranks(new, sym[back])
        note_all(found, back[which])
    return sym[:n]


class Codec:
    """Encodes and decodes with one vocabulary file."""

    def __init__(self, s: BpeSettings = BpeSettings()):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = s.vocabulary or public_tokenizers.path("word_bpe_49k.json")
        self.s = s
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.plain = all(spec[part] == rule for part, rule in PLAIN_RULES.items())
        self.word = re.compile(PLAIN_WORD)
        self.not_plain = re.compile(NOT_PLAIN)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {text: np.uint32(i).tobytes() for text, i in special.items()}
        by_length = sorted(special, key=len, reverse=True)
        self.split_special = re.compile(f"({'|'.join(map(re.escape, by_length))})").split if special else None
        self.size = max([*vocab.values(), *special.values()]) + 1
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        symbols = byte_symbols()
        self.byte_ids = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.last_ids = np.array([vocab[c + suffix] for c in symbols], dtype=np.int64)
        self.merges: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, new = vocab[left], vocab[right], vocab[left + right]
            if made.setdefault(new, rank) != rank:
                raise ValueError(f"merges {made[new]} and {rank} of {path} make one symbol")
            self.merges.append((a, b, new))
        for rank, (a, b, _) in enumerate(self.merges):
            if max(made.get(a, -1), made.get(b, -1)) >= rank:
                raise ValueError(f"merge {rank} of {path} comes before a merge that makes its parts")
        self.ranks = {a * self.size + b: rank for rank, (a, b, _) in enumerate(self.merges)}
        left, right, _ = np.array(self.merges, dtype=np.int64).reshape(-1, 3).T
        self.after_left = _Partners(left, right, self.size)
        self.before_right = _Partners(right, left, self.size)
        self.codes: defaultdict[str, int] = defaultdict(count().__next__)  # number of each word met
        self.coded: list[bytes] = []  # ids of each numbered word

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if self.plain and (text.isascii() or not self.not_plain.search(text)):
            return self.word.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit numbers."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(w) for w in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        if not len(data):
            return [b""] * len(words)
        stops = np.cumsum(sizes)
        sym = _merged(self, data, stops[sizes > 0] - 1)
        alive = sym >= 0
        ids = sym[alive].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(alive)])[stops] * 4
        starts = np.concatenate([[0], ends[:-1]])
        return [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _parts(self, text: str) -> list[str]:
        """Stretches of a text and, at odd places, the special tokens between them."""
        return self.split_special(text) if self.split_special and "<|" in text else [text]

    def _numbered(self, text: str | None) -> list[np.ndarray | bytes]:
        """A text's words by number, and the ids of the special tokens between them."""
        if not text:
            return []
        number = self.codes.__getitem__
        return [
            self.special[part] if k % 2 else np.array(list(map(number, self.words(part))), dtype=np.int32)
            for k, part in enumerate(self._parts(text))
        ]

    def _finish(self, block: list[list[np.ndarray | bytes]]) -> list[bytes]:
        """Ids of a block's texts; the pairs of all its new words share one index."""
        new = list(islice(self.codes, len(self.coded), None))
        self.coded += self.merge_words(new)
        ids = self.coded.__getitem__
        out = [b"".join([p if type(p) is bytes else b"".join(map(ids, p.tolist())) for p in parts]) for parts in block]
        if len(self.codes) > self.s.known_words or sum(map(len, new)) > self.s.block_chars:
            self.codes = defaultdict(count().__next__)
            self.coded = []
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, block by block."""
        out: list[bytes] = []
        block: list[list[np.ndarray | bytes]] = []
        held = 0
        for text in texts:
            block.append(self._numbered(text))
            held += len(text or "")
            if held >= self.s.block_chars:
                out += self._finish(block)
                block, held = [], 0
        return out + self._finish(block)

    def decode(self, ids: bytes | None) -> str:
        """Tokens joined by a blank, special ones too; ids that the vocabulary lacks are left out."""
        numbers = np.frombuffer(ids or b"", dtype="<u4").tolist()
        try:
            return " ".join(map(self.tokens.__getitem__, numbers))
        except KeyError:
            return " ".join([self.tokens[i] for i in numbers if i in self.tokens])


def _codec(s: BpeSettings) -> Codec:
    return worker_cache(("bpe", s), lambda: Codec(s))


def coded_column(text: Column, settings: BpeSettings = BpeSettings(), decoded: bool = False) -> Column:
    """Struct of a text column's ``ids``, as little-endian unsigned 32-bit numbers, and, if ``decoded``, their ``text``."""
    kind = "ids binary, text string" if decoded else "ids binary"

    @F.pandas_udf(kind)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(settings)
        for texts in batches:
            rows = {"ids": codec.encode(texts.tolist())}
            if decoded:
                rows["text"] = [codec.decode(i) for i in rows["ids"]]
            yield pd.DataFrame(rows, dtype=object)

    return coded(text)


def text_column(ids: Column, settings: BpeSettings = BpeSettings()) -> Column:
    """The decoded text of a column of ids; empty for null."""

    @F.pandas_udf(T.StringType())
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(settings)
        for ids in batches:
            yield pd.Series([codec.decode(i) for i in ids], dtype=object)

    return decoded(ids)


def encode(
    docs: DataFrame, text_col: str = "text", out: str = f"{PREFIX}ids", settings: BpeSettings = BpeSettings()
) -> DataFrame:
    """``docs`` with the ids of their texts in the new column ``out``."""
    if out in docs.columns:
        raise ValueError(f"the column {out} exists already")
    return docs.withColumn(out, coded_column(docs[text_col], settings)["ids"])


def round_trip(
    docs: DataFrame, text_col: str = "text", out: str = f"{PREFIX}coded", settings: BpeSettings = BpeSettings()
) -> DataFrame:
    """``docs`` with the new struct ``out`` of the texts' ``ids`` and of the ``text`` these decode to, in one pass."""
    if out in docs.columns:
        raise ValueError(f"the column {out} exists already")
    return docs.withColumn(out, coded_column(docs[text_col], settings, decoded=True))


def decode(
    coded: DataFrame, ids_col: str = f"{PREFIX}ids", out: str = f"{PREFIX}decoded", settings: BpeSettings = BpeSettings()
) -> DataFrame:
    """``coded`` with the texts of its ids in the new column ``out``."""
    if out in coded.columns:
        raise ValueError(f"the column {out} exists already")
    return coded.withColumn(out, text_column(coded[ids_col], settings))
