"""Embedding models as injectable batch functions.

An embedder is a *factory*: called once per Python worker, it returns
``predict(texts: ndarray) -> ndarray (n, dim) float32``. Real models (a local
network, a client of a service) are plugged in the same way as the
deterministic token-hash model below, which needs no model files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.model_cache import ModelCache
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.settings import BATCH_SIZE, EMBEDDING_DIM, MEMO_CHARS, MEMO_TOKENS

_RETURNED_ROWS = 1024


def token_hash_embedder(dim: int = EMBEDDING_DIM):
    """Counts of space-separated tokens, each hashed to one of ``dim`` slots
    (first 32 bits of the token's MD5, modulo ``dim``)."""

    def make():
        import hashlib

        import numpy as np

        slots: dict[str, int] = {}

        def slot(token: str) -> int:
            found = slots.get(token)
            if found is None:
                digest = hashlib.md5(token.encode("utf-8")).digest()
                found = int.from_bytes(digest[:4], "big") % dim
                # Frequent tokens come early; what a worker keeps must not grow with the table.
                if len(slots) < MEMO_TOKENS and len(token) <= MEMO_CHARS:
                    slots[token] = found
            return found

        def predict(texts):
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                used = [slot(token) for token in (text or "").split(" ") if token]
                if used:
                    out[row] = np.bincount(used, minlength=dim)
            return out

        return predict

    return make


def embed(text: Column, embedder, batch_size: int = BATCH_SIZE) -> Column:
    """``array<float>`` per text; the embedder sees at most ``batch_size`` texts
    per call. It does what ``predict_batch_udf`` does, but the vectors of many calls
    go back together, as the one array of numbers they are."""
    key = uuid.uuid4()

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = ModelCache.get(key)
        if not predict:
            predict = embedder()
            ModelCache.add(key, predict)
        for column in columns:
            held, rows = [], 0
            for start in range(0, len(column), batch_size):
                texts = np.array(column.slice(start, batch_size).to_pylist(), dtype=object)
                held.append(_vectors(predict(texts), len(texts)))
                rows += len(texts)
                if rows >= _RETURNED_ROWS:
                    yield pa.concat_arrays(held)
                    held, rows = [], 0
            if held or not len(column):
                yield pa.concat_arrays(held) if held else pa.array([], pa.list_(pa.float32()))

    return F.arrow_udf(run, "array<float>")(text)


def _vectors(found, rows: int) -> pa.ListArray:
    """What a model gave for ``rows`` texts, as a list column. Entries that are not a number
    stay so in float32 and are NULL otherwise, as with ``predict_batch_udf``."""
    if not isinstance(found, np.ndarray) or found.ndim != 2:
        raise ValueError("an embedder returned no two-dimensional array")
    if len(found) != rows:
        raise ValueError(f"an embedder returned {len(found)} vectors for {rows} texts")
    flat = found.astype(np.float32, copy=False).reshape(-1)
    values = pa.array(flat, from_pandas=found.dtype != np.float32)
    offsets = np.arange(rows + 1, dtype=np.int32) * found.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
