"""Order-preserving packing of tokenized documents (operator 4).

Each task tokenizes its documents in their order, joins them (an end id after
each) and cuts the stream into windows of at most ``length`` tokens. The cuts come
from dynamic programming over document ends, sentence ends and, in long
sentences, places every ``stride`` tokens. A window costs its padding plus a
penalty for where it ends, so

    best(j) = penalty(j) + min over i of best(i) + length - (pos(j) - pos(i)),

a sliding minimum of best(i) + pos(i) that a monotone queue keeps in constant
time. Windows whose length is a power of two cost no padding and are looked up
apart. The programme runs over blocks of ``block`` tokens; what follows the last
cut of a block begins the next one, so a task holds one block and one Arrow batch.

There is no shuffle: a task is one split of the input, and sequence ids come
from the split's number, so a task that runs again gives the same rows.

Ids are those of ``tokenizers`` for the given file. Texts of Latin letters (below
U+0250) go through ``tiktoken`` with the same vocabulary, which is some four times
as fast and gives the same ids; all others through ``tokenizers`` itself.

Defined cases: null and empty texts are the end id alone; rows without id are
packed like any other; repeated rows are packed each; an empty table gives no row.
"""

from __future__ import annotations

import base64
import os
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strata.llm.common import long_id, worker_cache

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class PackSettings:
    vocabulary: str | None = None  # a tokenizers file; by default byte_bpe_50k.json of public_tokenizers
    ranks: str | None = None  # the same vocabulary for tiktoken
    end_id: int = 1
    length: int = 2048
    shortest_power: int = 128  # shorter powers of two are not sought as windows
    sentence_penalty: float = 8.0  # in tokens of padding
    cut_penalty: float = 64.0  # inside a sentence
    window_penalty: float = 2.0  # for each window, so that long ones win ties
    stride: int = 256
    block: int = 1 << 17


class Encoder:
    """Token ids of texts, and which ids end a sentence."""

    def __init__(self, s: PackSettings):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(s.vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
        with open(s.ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.latin = tiktoken.Encoding(
            "latin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.other = re.compile("[^\x00-ɏ]|[^ ]{2000}|\\s{2000}")
        size = max([*ranks.values(), *special.values(), s.end_id]) + 1
        self.ends = np.zeros(size, dtype=bool)
        for token, rank in ranks.items():
            self.ends[rank] = token.rstrip(b" \"')")[-1:] in (b".", b"!", b"?", b"\n")

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.uint32)
        if text.isascii() and len(text) < 2000 or not self.other.search(text):
            return np.asarray(self.latin.encode_to_numpy(text, allowed_special="all"), dtype=np.uint32)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cut_points(ends: np.ndarray, doc_ends: np.ndarray, s: PackSettings) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending from 0, and the penalty of each.

    ``ends``: per token, whether it ends a sentence; ``doc_ends``: positions after
    each document's last token, the last of them the end of all.
    """
    sentence = np.flatnonzero(ends) + 1
    places = np.unique(np.concatenate([[0], sentence, doc_ends]))
    wide = np.flatnonzero(np.diff(places) > s.stride)
    if len(wide):
        more = [np.arange(places[i] + s.stride, places[i + 1], s.stride) for i in wide]
        places = np.unique(np.concatenate([places, *more]))
    penalty = np.full(len(places), s.cut_penalty)
    penalty[np.isin(places, sentence)] = s.sentence_penalty
    penalty[np.isin(places, doc_ends)] = 0.0
    return places, penalty + s.window_penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, s: PackSettings, whole: bool) -> list[int]:
    """Positions of the cheapest cuts, from 0; to the last place if ``whole``, else to one in the last window."""
    n = len(places)
    jumps: dict[int, list[int]] = {}
    power = s.shortest_power
    while power < s.length:
        at = np.searchsorted(places, places - power)
        for j in np.flatnonzero((places >= power) & (places[at] == places - power)):
            jumps.setdefault(int(j), []).append(int(at[j]))
        power *= 2
    pos, cost = places.tolist(), penalty.tolist()
    best, came, key = [0.0] * n, [0] * n, [0.0] * n
    queue: deque[int] = deque()
    for j in range(1, n):
        here = pos[j]
        last = key[j - 1]
        while queue and key[queue[-1]] > last:
            queue.pop()
        queue.append(j - 1)
        while here - pos[queue[0]] > s.length:
            queue.popleft()
        i = queue[0]
        least = key[i] + s.length - here
        for other in jumps.get(j, ()):
            if best[other] < least:
                least, i = best[other], other
        best[j] = least + cost[j]
        came[j] = i
        key[j] = best[j] + here
    j = n - 1
    if not whole:
        first = int(np.searchsorted(places, places[-1] - s.length, side="right"))
        j = min(range(max(first, 1), n), key=lambda x: (best[x], -x)) if n > 1 else 0
    cuts = [pos[j]]
    while j:
        j = came[j]
        cuts.append(pos[j])
    return cuts[::-1]


class _Packer:
    """Packs one task's documents, block by block."""

    def __init__(self, ends: np.ndarray, s: PackSettings, first_sequence: int):
        self.ends, self.s, self.sequence = ends, s, first_sequence
        self.docs: list[tuple[int | None, int, int]] = []  # id, tokens already packed, tokens in all
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids)))
        self.parts.append(ids)
        self.size += len(ids)

    def flush(self, whole: bool) -> pa.RecordBatch | None:
        if not self.size:
            return None
        tokens = np.concatenate(self.parts)
        held = np.array([total - done for _, done, total in self.docs])
        doc_ends = np.cumsum(held)
        doc_starts = doc_ends - held
        places, penalty = cut_points(self.ends[tokens], doc_ends, self.s)
        cuts = np.array(best_cuts(places, penalty, self.s, whole))
        stop = int(cuts[-1])
        edges = np.unique(np.concatenate([cuts, doc_starts[doc_starts < stop]]))
        starts, sizes = edges[:-1], np.diff(edges)
        doc = np.searchsorted(doc_starts, starts, side="right") - 1
        window = np.searchsorted(cuts, starts, side="right") - 1
        done = np.array([d[1] for d in self.docs])
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array([self.docs[d][0] for d in doc], pa.int64()),
                pa.array(starts - doc_starts[doc] + done[doc], pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array([tokens[a : a + n].astype("<u4").tobytes() for a, n in zip(starts, sizes, strict=True)], pa.binary()),
                pa.array([self.docs[d][2] for d in doc], pa.int64()),
                pa.array(self.sequence + window, pa.int64()),
                pa.array(starts - cuts[window], pa.int64()),
            ],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        self.sequence += len(cuts) - 1
        self.parts, self.size = [tokens[stop:].copy()], len(tokens) - stop
        left = np.flatnonzero(doc_ends > stop)
        self.docs = [
            (self.docs[d][0], self.docs[d][1] + max(0, stop - int(doc_starts[d])), self.docs[d][2]) for d in left
        ]
        return rows


def _pack(s: PackSettings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(("encoder", s.vocabulary, s.ranks, s.end_id), lambda: Encoder(s))
        packer = _Packer(encode.ends, s, TaskContext.get().partitionId() << 40)
        end = np.array([s.end_id], dtype=np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, np.concatenate([encode(text.as_py()), end]))
                if packer.size >= s.block:
                    yield packer.flush(False)
        last = packer.flush(True)
        if last is not None:
            yield last

    return rows


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: PackSettings = PackSettings()
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's ids as unsigned 32-bit little-endian numbers; a
    sequence's pieces lie side by side from offset 0. Every id, the end id too,
    lies in one piece.
    """
    given = docs.select(long_id(docs, id_col).alias("doc_id"), docs[text_col].alias("text"))
    return given.mapInArrow(_pack(settings), PIECES)
