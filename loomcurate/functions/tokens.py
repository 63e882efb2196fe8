"""Token counts by a vocabulary file."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


def bpe_token_count(text: Column, path: str) -> Column:
    """Tokens of the whole text by the vocabulary at ``path`` (a ``tokenizers`` file); null for null."""

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        known = _tokenizer(path)
        return pa.array([None if t is None else len(known.encode(t, add_special_tokens=False).ids) for t in texts.to_pylist()], pa.int32())

    return count(text)
