"""Embeddings: a user's model as a pandas UDF, and an offline default."""

from __future__ import annotations

import hashlib
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.text import tokens

Embedder = Callable[[Column], Column]


def model_embedder(load: Callable[[], Callable[[list[str]], np.ndarray]]) -> Embedder:
    """An embedder around a model; ``load`` runs once per Python worker."""
    key = uuid.uuid4().hex  # the worker keeps the model under it from task to task

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        models = sys.modules.setdefault("_strata_models", types.ModuleType("_strata_models")).__dict__
        encode = models[key] if key in models else models.setdefault(key, load())
        for texts in batches:
            vectors = np.asarray(encode(texts.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(vectors))

    return embed


def hashing_embedder(dim: int = 64) -> Embedder:
    """Term counts hashed into ``dim`` buckets, scaled to unit length.

    A token's bucket is the first 32 bits of its MD5 modulo ``dim``; a text
    without tokens gets the zero vector. Each distinct token of an Arrow batch is
    hashed once and the batch counted by one ``bincount``; no model and no fitted state.
    """

    @F.arrow_udf("array<float>")
    def unit(words: pa.Array) -> pa.Array:
        lists = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
        n = len(lists)
        rows = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        coded = lists.flatten().cast(pa.binary()).dictionary_encode()
        hashed = (int.from_bytes(hashlib.md5(t, usedforsecurity=False).digest()[:4], "big") for t in coded.dictionary.to_pylist())
        bucket = np.fromiter((h % dim for h in hashed), np.int64, len(coded.dictionary))
        cells = rows * dim + bucket[coded.indices.to_numpy(zero_copy_only=False)]
        counts = np.bincount(cells, minlength=n * dim).reshape(n, dim).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        values = np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), pa.array(values.ravel()))

    def embed(text: Column) -> Column:
        return unit(tokens(text))

    return embed


def embed_column(df: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
    return df.withColumn("embedding", embedder(F.col(text)))
