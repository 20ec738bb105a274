from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.functions.text import WHITESPACE_CHARACTERS, first_line, strip, tokens
from strata.operators.chunks import chunk_documents
from tests.helpers import windows


def texts(n: int = 150) -> list[str]:
    """Random texts: blanks of all kinds, accents, characters outside the BMP."""
    rng = random.Random(7)
    alphabet = list("abcdeé漢😀İΣ.,-'\"") + list(WHITESPACE_CHARACTERS) + [" "] * 6
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 400))) for _ in range(n)]


def test_tokens_and_strip_are_pythons(spark):
    rows = [(i, t) for i, t in enumerate(texts()) if "İ" not in t and "Σ" not in t]
    rows += [(10_000, ""), (10_001, "   "), (10_002, "　x Y ")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = df.select("id", tokens(F.col("text")).alias("w"), strip(F.col("text")).alias("s")).collect()
    by_id = dict(rows)
    for row in got:
        assert row["w"] == by_id[row["id"]].lower().split()
        assert row["s"] == by_id[row["id"]].strip()


def test_null_text_has_no_tokens(spark):
    assert spark.range(1).select(tokens(F.lit(None).cast("string"))).first()[0] == []


def test_first_line(spark):
    df = spark.createDataFrame([("one\ntwo",), ("alone",), ("",)], "t string")
    assert [r[0] for r in df.select(first_line(F.col("t"))).collect()] == ["one", "alone", ""]


def documents(spark, contents: list[str | None]):
    rows = [(f"D{i}", f"T{i}", "A", "AI", c) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "article_id string, title string, author string, category string, content string")


def chunk_lists(df) -> dict[str, list[str]]:
    found: dict[str, dict[int, str]] = {}
    for row in df.collect():
        assert row["chunk_id"] == f"{row['doc_id']}_C{row['chunk_index']}"
        found.setdefault(row["doc_id"], {})[row["chunk_index"]] = row["text"]
    return {doc: [chunks[i] for i in range(len(chunks))] for doc, chunks in found.items()}


@pytest.mark.parametrize("size, overlap", [(20, 5), (20, 15), (7, 6), (10, 0), (500, 50), (1, 0)])
def test_chunks_follow_the_window_rule(spark, size, overlap):
    contents = texts(60) + ["", None, "x" * size, "y" * (size + 1), "Word " * 200]
    got = chunk_lists(chunk_documents(documents(spark, contents), size, overlap))
    want = {f"D{i}": windows(c, size, overlap) for i, c in enumerate(contents) if c}
    assert got == want


def test_known_chunk_counts(spark):
    sentence = "A sentence of eighty-seven characters is repeated here, five times over and no more of "
    assert len(sentence) == 87
    docs = documents(spark, ["Word " * 200, sentence * 5])
    assert len(chunk_lists(chunk_documents(docs, 200, 30))["D0"]) == 6
    assert len(chunk_lists(chunk_documents(docs, 150, 20))["D1"]) > 1


def test_long_document_is_cut_in_linear_time(spark):
    text = "abcdefghi " * 300_000  # 3 million characters
    got = chunk_lists(chunk_documents(documents(spark, [text])))["D0"]
    assert got == windows(text, 500, 50)


def test_bad_windows_are_refused(spark):
    for size, overlap in ((10, 10), (10, 11), (0, 0), (5, -1)):
        with pytest.raises(ValueError):
            chunk_documents(documents(spark, ["abc"]), size, overlap)


def test_citation_labels_and_defaults(spark):
    rows = [(None, None, None, None, "text"), ("A1", "t" * 40, "me", "AI", "text")]
    docs = spark.createDataFrame(
        rows, "article_id string, title string, author string, category string, content string"
    )
    labels = {r["doc_id"]: r["citation_label"] for r in chunk_documents(docs).collect()}
    assert labels["DOC-UNKNOWN"] == "[Doc ID: DOC-UNKNOWN, Chunk: 0 | '...' by ]"
    assert labels["A1"] == f"[Doc ID: A1, Chunk: 0 | '{'t' * 35}...' by me]"
    plain = {r["citation_label"] for r in chunk_documents(docs, style="plain").collect()}
    assert "[Article ID: A1, Chunk: A1_C0]" in plain
