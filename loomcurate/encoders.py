"""Encoders of texts for the near-duplicate gate."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Length of an offline embedding.
DIMENSIONS = 256


def _counts(text: str | None) -> np.ndarray | None:
    if text is None:
        return None
    low = text.lower()
    grams = [low[i : i + 3] for i in range(len(low) - 2)] or [low]
    places = [int(hashlib.md5(g.encode("utf-8", "surrogatepass")).hexdigest()[:4], 16) % DIMENSIONS for g in grams]
    return np.bincount(places, minlength=DIMENSIONS).astype(np.float32)


def offline(text: Column) -> Column:
    """Counts of hashed character trigrams of the lower-cased text; a deterministic stand-in for a model."""

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(_counts)

    return encode(text)


def make(name: str):
    """The encoder of that name; None for an empty name."""
    if not name:
        return None
    if name == "offline":
        return offline
    raise ValueError(f"no encoder {name}; pass a function text -> array<float>")
