"""Plain Python statements of the rules, to check the Spark jobs against."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

EVENTS = str(Path(__file__).parent / "fixtures" / "events.json")
SAMPLE = "/root/testdata/sf0.001"


def windows(text: str, size: int, overlap: int) -> list[str]:
    """All windows of a text by the textbook rule."""
    if not text:
        return []
    starts = [0]
    while starts[-1] + size < len(text):
        starts.append(starts[-1] + size - overlap)
    return [text[s : s + size].strip() for s in starts]


def bm25(chunks: dict[str, str], query: str) -> dict[str, float]:
    """Okapi scores of every chunk for one query."""
    words = {c: text.lower().split() for c, text in chunks.items()}
    n = len(words)
    mean_length = sum(map(len, words.values())) / n
    df = Counter(t for w in words.values() for t in set(w))
    idf = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    scores = {}
    for c, w in words.items():
        tf = Counter(w)
        scale = 1.5 * (0.25 + 0.75 * len(w) / mean_length)
        scores[c] = sum(idf.get(t, 0.0) * tf[t] * 2.5 / (tf[t] + scale) for t in query.lower().split())
    return scores


def top(scores: dict[str, float], k: int) -> list[str]:
    """Best k chunk ids; corpus order (doc id, then chunk number) breaks ties."""

    def place(chunk_id: str):
        doc, index = chunk_id.rsplit("_C", 1)
        return doc, int(index)

    return sorted(scores, key=lambda c: (-round(scores[c], 9), place(c)))[:k]


def chunk_rows(texts: dict[str, str]) -> list[dict]:
    rows = []
    for chunk_id, text in texts.items():
        doc, index = chunk_id.rsplit("_C", 1)
        rows.append(
            {
                "chunk_id": chunk_id,
                "doc_id": doc,
                "chunk_index": int(index),
                "title": f"Title of {doc}",
                "author": "Someone",
                "category": "AI",
                "text": text,
                "citation_label": f"[{chunk_id}]",
            }
        )
    return rows


CHUNK_SCHEMA = (
    "chunk_id string, doc_id string, chunk_index int, title string, author string, category string, "
    "text string, citation_label string"
)
