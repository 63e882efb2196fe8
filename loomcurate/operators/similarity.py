"""Largest cosine similarity of each vector to any other, and the near-duplicate gate.

All pairs are compared, as the gate needs exact maxima: rows are dealt into blocks, each pair of blocks is one task and
one matrix product, and only a maximum per row and task leaves it. No pair is ever a row, and a task holds two blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import ready

BLOCK = 4096


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)
    size = np.sqrt((x**2).sum(axis=1, keepdims=True))
    return x / np.where(size == 0, 1, size)


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    if len(right):
        s = _unit(left["vector"]) @ _unit(right["vector"]).T
        found = [(left["id"], s.max(axis=1)), (right["id"], s.max(axis=0))]
    else:
        s = _unit(left["vector"]) @ _unit(left["vector"]).T
        np.fill_diagonal(s, -1.0)  # a row is not its own neighbour; by place, not by id
        found = [(left["id"], s.max(axis=1))]
    return pd.DataFrame({"id": np.concatenate([i.to_numpy() for i, _ in found]), "best": np.concatenate([b for _, b in found])})


def max_similarity(rows: DataFrame, key: str, vector: str, block: int = BLOCK) -> DataFrame:
    """(key, max_sim): largest cosine similarity to another row, at least 0; 0 for a single row.

    Null vectors get 0 and are nobody's neighbour. ``key`` should be unique; rows of one id share the largest value.
    """
    ready(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()
    some = rows.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    blocks = max(1, math.ceil(rows.select(key).count() / block))  # the vectors are not computed for the count
    own = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")
    # block b meets every block c: as the left side where b <= c, as the right one where b > c
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda c: F.struct(F.least(own, c).alias("a"), F.greatest(own, c).alias("b"))))
    dealt = some.withColumn("own", own).withColumn("tile", tile).withColumn("side", F.when(F.col("own") == F.col("tile.a"), 0).otherwise(1))
    best = dealt.groupBy("tile").applyInPandas(_tile, f"id {kind}, best double").groupBy(F.col("id").alias("_of")).agg(F.max("best").alias("best"))
    joined = rows.select(key).join(best, F.col(key) == F.col("_of"), "left")
    return joined.select(key, F.round(F.greatest(F.coalesce("best", F.lit(0.0)), F.lit(0.0)), 6).alias("max_sim"))


def not_near_duplicate(similarity: Column, threshold: float) -> Column:
    """Both members of a near-duplicate pair fail."""
    return similarity < threshold
