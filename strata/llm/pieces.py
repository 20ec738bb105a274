"""Sampled SentencePiece segmentation and exact decoding (operator 8).

A text's piece lattice has an edge for every vocabulary piece that matches, and
one through byte pieces for every character that has no piece of its own. Forward
filtering sums, for each place, the weight of all paths to it; backward sampling
then draws a path from the end, edge by edge, in proportion to its weight. Draws
come from a hash of the seed, the row's key, the word's number in the text and
the step, so a row's segmentation is the same in any partitioning and on any retry.

No piece holds a blank after another character, or a line feed, so the lattice falls
apart into words and the words' paths are independent. In a task the lattices of the
different words of some million characters are built, filtered and sampled together
by numpy. Stretches without a blank are cut every ``longest`` characters.

The vocabulary gives each piece a weight: its score in a unigram model; in a
byte-pair model, whose scores only rank the pieces, the logarithm of 1 / rank.
``sharpness`` multiplies it: high values come near the single best path.

Encoding begins with one blank, as SentencePiece does, and decoding drops it, so
any text comes back exactly; blanks are never normalised. A null text gives null, an
empty one no pieces. Rows without id are keyed by their text; repeated rows get the
same pieces; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.common import PREFIX, worker_cache

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PieceSettings:
    model: str | None = None  # a SentencePiece file; by default piece_bpe_32k.model of public_tokenizers
    sharpness: float = 1.0
    byte_weight: float = -12.0  # of each byte piece
    seed: int = 1
    longest: int = 1024
    chars: int = 3_000_000  # sampled together


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces of a model: their weights, a table of all prefixes, and their bytes."""

    def __init__(self, s: PieceSettings):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=s.model or public_tokenizers.path("piece_bpe_32k.model"))
        size = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.pieces: dict[str, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[i], self.byte_ids[value] = bytes([value]), i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                self.bytes[i] = text.encode()
                if "\n" not in text and " " not in text.lstrip(" "):
                    self.pieces[text] = i
        scores = np.array([model.get_score(i) for i in range(size)])
        ids = np.array(sorted(self.pieces.values()), dtype=np.int64)
        if len(ids) > 1 and np.median(np.diff(scores[ids])) == -1:  # ranks, not logarithms
            ranked = ids[np.lexsort((ids, -scores[ids]))]
            scores[ranked] = -np.log(1.0 + np.arange(len(ids)))
        self.weights = scores * s.sharpness
        table: dict[int, int] = {}
        for text, i in self.pieces.items():
            code = 0
            for n, c in enumerate(text, start=1):
                code = (code * int(_STEP) + ord(c) + 1) % 2**64
                if n == len(text):
                    table[code] = i
                else:
                    table.setdefault(code, -1)
        # An open hash table: key, and the id or -1; 0 is a free place, and the table ends in free places.
        self.bits = max(12, (4 * len(table)).bit_length())
        self.keys = np.zeros((1 << self.bits) + 64, dtype=np.uint64)
        self.ids = np.full(len(self.keys), -2, dtype=np.int32)
        for key, i in table.items():
            at = int(self.place(np.array([key], dtype=np.uint64))[0])
            while self.keys[at]:
                at += 1
            self.keys[at], self.ids[at] = key, i

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The id of each key, -1 for a mere prefix of a piece, -2 if it is none."""
        at = self.place(keys)
        there = self.keys[at]
        out = self.ids[at]
        left = np.flatnonzero((there != keys) & (there != 0))
        while len(left):
            at[left] += 1
            there = self.keys[at[left]]
            out[left] = self.ids[at[left]]
            left = left[(there != keys[left]) & (there != 0)]
        return out


class Lattices:
    """The lattices of several words, filtered forward and ready to be sampled.

    Nodes are the places before, between and after a word's characters; the edges into
    a node lie side by side from ``into``, and ``cumulative`` rises to 1 over them.
    """

    def __init__(self, words: list[str], v: Vocabulary, s: PieceSettings):
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        word = np.repeat(np.arange(len(words)), sizes)
        first_char = np.cumsum(sizes) - sizes
        self.first = first_char + np.arange(len(words))  # each word's first node
        self.last = self.first + sizes
        n_nodes = len(codes) + len(words)
        local = np.arange(len(codes)) - first_char[word]
        room = sizes[word] - local
        at, h = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        starts, lengths, pieces = [], [], []
        alone = np.zeros(len(codes), dtype=bool)
        n = 0
        while len(at):
            n += 1
            h = h * _STEP + codes[at + n - 1] + np.uint64(1)
            ids = v.find(h)
            found = np.flatnonzero(ids >= 0)
            starts.append(at[found])
            lengths.append(np.full(len(found), n))
            pieces.append(ids[found].astype(np.int64))
            if n == 1:
                alone[at[found]] = True
            go_on = np.flatnonzero((ids > -2) & (room[at] > n))
            at, h = at[go_on], h[go_on]
        rest = np.flatnonzero(~alone)
        starts.append(rest)
        lengths.append(np.ones(len(rest), dtype=np.int64))
        pieces.append(-1 - codes[rest].astype(np.int64))  # a character in bytes
        # Long pieces first: they are the likelier ones, so sampling finds its edge sooner.
        char, length, piece = (np.concatenate(x[::-1]) for x in (starts, lengths, pieces))
        weight = v.weights[np.maximum(piece, 0)]
        spelled = np.flatnonzero(piece < 0)
        value = -1 - piece[spelled]
        n_bytes = 1 + (value > 0x7F) + (value > 0x7FF) + (value > 0xFFFF)
        weight[spelled] = n_bytes * (s.byte_weight * s.sharpness)
        start = char + word[char]
        end_local = local[char] + length
        order = np.argsort(end_local * n_nodes + start + length, kind="stable")
        end, end_local, weight = (start + length)[order], end_local[order], weight[order]
        self.start, self.piece = start[order].astype(np.int32), piece[order].astype(np.int32)
        groups = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1]) if len(end) else np.empty(0, dtype=np.int64)
        counts = np.diff(np.append(groups, len(end)))
        nodes = end[groups]
        self.into = np.zeros(n_nodes, dtype=np.int64)
        self.into[nodes] = groups
        total = np.zeros(n_nodes)
        stops = np.append(np.flatnonzero(np.diff(end_local[groups])) + 1, len(groups)) if len(groups) else []
        done = 0
        for stop in stops:
            a, b = groups[done], groups[stop] if stop < len(groups) else len(end)
            reach = total[self.start[a:b]] + weight[a:b]
            cuts, many = groups[done:stop] - a, counts[done:stop]
            top = np.maximum.reduceat(reach, cuts)
            total[nodes[done:stop]] = top + np.log(np.add.reduceat(np.exp(reach - np.repeat(top, many)), cuts))
            done = stop
        weight += total[self.start]
        weight -= total[end]
        share = np.exp(weight, out=weight)
        summed = share  # within each node alone, so that the draws do not hang on the words beside it
        more, step = np.flatnonzero(counts > 1), 1
        while len(more):
            at = groups[more] + step
            summed[at] += summed[at - 1]
            step += 1
            more = more[counts[more] > step]
        self.cumulative = summed.astype(np.float32)
        self.cumulative[groups + counts - 1] = 2.0  # the last edge takes what rounding leaves

    def sample(self, words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled pieces of the words side by side, and their numbers; ``keys`` seed each word's draws."""
        active, node, stop = np.arange(len(words)), self.last[words], self.first[words]
        owners, drawn = [], []
        step = 0
        while len(active):
            u = _mixed(keys[active] + np.array([step], dtype=np.uint64) * _STEP) >> np.uint64(36)
            u = (u / 2.0**28).astype(np.float32)
            at = self.into[node]
            left = np.flatnonzero(self.cumulative[at] <= u)
            while len(left):
                at[left] += 1
                left = left[self.cumulative[at[left]] <= u[left]]
            owners.append(active)
            drawn.append(self.piece[at])
            node = self.start[at]
            go_on = node != stop
            active, node, stop = active[go_on], node[go_on], stop[go_on]
            step += 1
        if not owners:
            return np.empty(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        counts = np.bincount(np.concatenate(owners), minlength=len(words))
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), dtype=np.int64)
        for step, (owner, piece) in enumerate(zip(owners, drawn, strict=True)):
            out[ends[owner] - 1 - step] = piece
        return out, counts


def split_words(text: str, longest: int) -> list[str]:
    """Words with their blanks, after the blank that encoding begins with."""
    return re.findall(f" {{0,{longest}}}[^ \n]{{1,{longest}}}| {{1,{longest}}}|\n", " " + text)


def _bytes_of(pieces: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the characters in bytes spelled out, and how many ids each piece became."""
    n = np.ones(len(pieces), dtype=np.int64)
    spelled = {int(i): v.byte_ids[np.frombuffer(chr(-1 - int(pieces[i])).encode("utf-8", "surrogatepass"), dtype=np.uint8)]
               for i in np.flatnonzero(pieces < 0)}
    if not spelled:
        return pieces.astype(np.int32), n
    for i, ids in spelled.items():
        n[i] = len(ids)
    out = np.repeat(pieces, n).astype(np.int32)
    place = np.cumsum(n) - n
    for i, ids in spelled.items():
        out[place[i] : place[i] + len(ids)] = ids
    return out, n


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def sample_texts(texts: list[str], keys: np.ndarray, v: Vocabulary, s: PieceSettings) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts side by side, and how many each has."""
    numbers = _Numbers()
    of, per_text = [], []
    for text in texts:
        words = split_words(text, s.longest) if text else []
        per_text.append(len(words))
        of += map(numbers.__getitem__, words)
    counts = np.zeros(len(texts), dtype=np.int64)
    if not of:
        return np.empty(0, dtype=np.int32), counts
    per_text = np.array(per_text)
    owner = np.repeat(np.arange(len(texts)), per_text)
    place = np.arange(len(of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    seeds = _mixed(_mixed(keys + np.array([s.seed], dtype=np.uint64) * _STEP)[owner] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    pieces, n = Lattices(list(numbers), v, s).sample(np.array(of), seeds)
    ids, spelled = _bytes_of(pieces, v)
    by_piece = np.repeat(owner, n)
    counts += np.bincount(by_piece, weights=spelled, minlength=len(texts)).astype(np.int64)
    return ids, counts


def _vocabulary(s: PieceSettings) -> Vocabulary:
    return worker_cache(("pieces", s.model, s.sharpness), lambda: Vocabulary(s))


def _sampled(keys: pa.Array, texts: pa.Array, s: PieceSettings) -> pa.Array:
    """Lists of sampled ids, a few million characters at a time."""
    v = _vocabulary(s)
    values = texts.to_pylist()
    seeds = np.array(
        [
            (k if k is not None else xxhash.xxh3_64_intdigest((t or "").encode("utf-8", "replace"))) % 2**64
            for k, t in zip(keys.to_pylist(), values, strict=True)
        ],
        dtype=np.uint64,
    )
    found, counts, start, size = [], [], 0, 0
    for i, text in enumerate(values):
        size += len(text or "")
        if size >= s.chars or i + 1 == len(values):
            ids, n = sample_texts([t or "" for t in values[start : i + 1]], seeds[start : i + 1], v, s)
            found.append(ids)
            counts.append(n)
            start, size = i + 1, 0
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1)
    flat = pa.array(np.concatenate(found) if found else np.empty(0, dtype=np.int32), pa.int32())
    missing = pa.array([t is None for t in values], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat, mask=missing if len(values) else None)


def _decoded(pieces: pa.Array, s: PieceSettings) -> pa.Array:
    """Texts of lists of ids."""
    v = _vocabulary(s)
    out = []
    for ids in pieces:
        if not ids.is_valid:
            out.append(None)
            continue
        ids = ids.values.to_numpy(zero_copy_only=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(v.bytes)):
            ids = ids[(ids >= 0) & (ids < len(v.bytes))]
        out.append(b"".join(map(v.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:])
    return pa.array(out, pa.string())


def _key(docs: DataFrame, id_col: str) -> Column:
    text_key = isinstance(docs.schema[id_col].dataType, T.StringType)
    return F.xxhash64(docs[id_col]) if text_key else docs[id_col].cast("long")


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = f"{PREFIX}pieces",
    settings: PieceSettings = PieceSettings(),
) -> DataFrame:
    """``docs`` with a column of sampled piece ids."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def sample(keys: pa.Array, texts: pa.Array) -> pa.Array:
        return _sampled(keys, texts, settings)

    return docs.withColumn(out_col, sample(_key(docs, id_col), docs[text_col]))


def decode(pieces: Column, settings: PieceSettings = PieceSettings()) -> Column:
    """The text of a column of piece ids; ids outside the vocabulary and control pieces are left out."""

    @F.arrow_udf(T.StringType())
    def join(pieces: pa.Array) -> pa.Array:
        return _decoded(pieces, settings)

    return join(pieces)


def sampled_with_check(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: PieceSettings = PieceSettings()
) -> DataFrame:
    """``docs`` with ``_strata_pieces`` and ``_strata_lossless``: whether decoding them gave the text again.

    One function does both: a decode upon an encode would sample each text twice.
    """

    @F.arrow_udf(T.StructType().add("pieces", T.ArrayType(T.IntegerType())).add("lossless", T.BooleanType()))
    def both(keys: pa.Array, texts: pa.Array) -> pa.Array:
        coded = _sampled(keys, texts, settings)
        again = pc.equal(_decoded(coded, settings), texts.cast(pa.string()))
        same = pc.if_else(pc.is_null(again), pc.and_(pc.is_null(texts), pc.is_null(coded)), again)
        return pa.StructArray.from_arrays([coded, same], names=["pieces", "lossless"])

    found = docs.withColumn(f"{PREFIX}found", both(_key(docs, id_col), docs[text_col]))
    for name in ("pieces", "lossless"):
        found = found.withColumn(f"{PREFIX}{name}", F.col(f"{PREFIX}found.{name}"))
    return found.drop(f"{PREFIX}found")
