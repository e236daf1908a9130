"""Embedding helpers: deterministic hash vectors and cosine similarity."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from casona import refdata
from casona.functions.text import as_col


def hash_embedding(c, dim: int = refdata.EMBEDDING_DIM) -> Column:
    """Unit vector expanded from SHA-256 of ``i::text``; identical text gives identical vectors.

    Stands in for a model when none is configured; it carries no meaning beyond equality.
    """
    heads = [f"{i}::".encode() for i in range(-(-dim // 16))]

    def vector(text: str) -> np.ndarray:
        tail, sha = text.encode(), hashlib.sha256
        raw = b"".join([sha(head + tail).digest() for head in heads])
        values = np.frombuffer(raw, dtype=">u2")[:dim].astype(np.float64) / 0xFFFF * 2 - 1
        return values / (np.sqrt((values * values).sum()) or 1.0)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else vector(t))

    return embed(as_col(c))


def rounded(x: Column) -> Column:
    """Whole number nearest to a double, halves away from zero; ``round`` makes a decimal of each value."""
    near = F.rint(x)
    return F.when(F.abs(x - near) == 0.5, F.signum(x) * (F.floor(F.abs(x)) + 1)).otherwise(near).cast("bigint")


def dot(a, b) -> Column:
    terms = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def cosine_similarity(a, b) -> Column:
    """1 - cosine distance; null when either vector is zero."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm != 0, dot(a, b) / norm)
