"""Text encoders and pair scorers that run in Arrow batches.

An encoder factory is called once per Python worker and returns a function from a list of texts to a
matrix with one row per text; a trained model plugs in that way. The default needs no weights: texts are cut into tokens by
native functions, the distinct tokens of a batch are numbered, and array arithmetic folds them into vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions import lexical

Encoder = Callable[[list[str]], np.ndarray]

# Batch size for encoding and the vector width of the collection.
ENCODE_BATCH = 32
COLLECTION_DIM = 1024

# Tokens and cells that are folded at a time.
_CELLS = 1 << 20


def _numbers(tokens: list[str]) -> np.ndarray:
    """The id of each token, as ``lexical.token_id`` makes it."""
    return np.array([int(hashlib.sha256(token.encode()).hexdigest()[:lexical.TOKEN_ID_DIGITS], 16) for token in tokens], np.int64)


def _folded(texts: pa.Array, dim: int) -> pa.Array:
    """Lists of tokens as vectors of ``dim`` signed counts, scaled to length 1; empty and null ones are zero."""
    parts, at = [], 0
    done = np.cumsum(pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + dim)
    while at < len(texts):
        last = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + _CELLS, side="right")))
        rows, at = texts.slice(at, last - at), last
        held = rows.flatten().dictionary_encode()
        known = held.dictionary.to_pylist()
        ids = _numbers(known)
        sign = np.where((ids // dim) % 2 == 1, -1.0, 1.0) * np.array([token != "" for token in known], bool)
        code = held.indices.to_numpy(zero_copy_only=False)
        owner = pc.list_parent_indices(rows).to_numpy()
        cells = np.bincount(owner * dim + (ids % dim)[code], sign[code], len(rows) * dim).reshape(len(rows), dim)
        length = np.linalg.norm(cells, axis=1, keepdims=True)
        parts.append(np.divide(cells, length, out=np.zeros_like(cells), where=length > 0).astype(np.float32))
    values = np.concatenate(parts).ravel() if parts else np.empty(0, np.float32)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * dim, pa.int32()), pa.array(values))


@dataclass(frozen=True)
class HashingEncoder:
    """Signed feature hashing: token counts folded into ``dim`` cells, length 1."""

    dim: int

    def vector(self, text: Column) -> Column:
        """Dense vector of a text."""
        dim = self.dim

        @F.arrow_udf("array<float>")
        def fold(tokens: pa.Array) -> pa.Array:
            return _folded(tokens, dim)

        return fold(F.split(F.lower(text), lexical.TOKEN_BREAK))


def hashing_encoder(dim: int) -> HashingEncoder:
    """The default encoder for vectors of ``dim`` values."""
    return HashingEncoder(dim)


def dense_vector(text: Column, factory: Callable[[], Encoder] | HashingEncoder, batch: int = ENCODE_BATCH) -> Column:
    """Dense vector of a text; a model is built once per worker and fed ``batch`` texts at a time."""
    if isinstance(factory, HashingEncoder):
        return factory.vector(text)

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for texts in batches:
            values = texts.fillna("").tolist()
            rows: list = []
            for at in range(0, len(values), batch):
                rows.extend(np.asarray(encoder(values[at:at + batch]), dtype=np.float32))
            yield pd.Series(rows, dtype=object)

    return encode(text)


def pair_score(query: Column, text: Column, factory: Callable[[], Callable]) -> Column:
    """Score of (query, text) pairs by a plugged-in model, in Arrow batches."""
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = factory()
        for queries, texts in batches:
            yield pd.Series(np.asarray(scorer(queries.tolist(), texts.tolist()), dtype=float))

    return score(query, text)
