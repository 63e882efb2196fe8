"""Operators on keys: keep-first and last-wins deduplication, resume, lookups, samples.

First and last rows are picked by an aggregate (min_by, max_by), which combines before the shuffle, so one key with a
third of the rows is a row per task; a window would sort them all in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, key: Column, *order: str) -> DataFrame:
    """The row of each key that comes first by ``order`` (which must tell rows of a key apart)."""
    whole = F.struct(*rows.columns)
    place = F.struct(*[F.col(c) for c in order])
    return rows.groupBy(key.alias("_key")).agg(F.min_by(whole, place).alias("_row")).select("_row.*")


def last_wins(rows: DataFrame, key: Column, *order: str) -> DataFrame:
    """The row of each key that comes last by ``order``."""
    whole = F.struct(*rows.columns)
    place = F.struct(*[F.col(c) for c in order])
    return rows.groupBy(key.alias("_key")).agg(F.max_by(whole, place).alias("_row")).select("_row.*")


def duplicate_flags(rows: DataFrame, key: str, digest: Column, *order: str) -> DataFrame:
    """(key, is_duplicate): true for ids with any row that is not the first of its digest."""
    slim = rows.select(F.col(key), digest.alias("_digest"), F.struct(*order).alias("_place"))
    first = slim.groupBy("_digest").agg(F.min("_place").alias("_first"))
    return slim.join(first, "_digest").groupBy(key).agg(F.max(F.col("_place") != F.col("_first")).alias("is_duplicate"))


def processed_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids; rows without one are ignored."""
    return rows.where(F.col(key).isNotNull()).select(key).distinct()


def remaining(rows: DataFrame, key: str, done: DataFrame, done_key: str) -> DataFrame:
    """Resume: the rows whose key is not among those done."""
    ids = processed_ids(done, done_key).withColumnRenamed(done_key, "_done")
    return rows.join(ids, F.col(key) == F.col("_done"), "left_anti")


def since(rows: DataFrame, when: Column, start: Column) -> DataFrame:
    """Rows at or after ``start``; rows without a time pass."""
    return rows.where(when.isNull() | (when >= start))


def in_taxonomy(rows: DataFrame, column: str, names: list[str] | DataFrame) -> DataFrame:
    """Rows whose value is a known name: of a list (the taxonomy: fixed and short), or of a dimension's ``name``."""
    if isinstance(names, DataFrame):
        return rows.join(names.select(F.col("name").alias("_name")), F.col(column) == F.col("_name"), "left_semi")
    return rows.where(F.col(column).isin(names))


def with_description(rows: DataFrame, column: str, dimension: DataFrame, into: str) -> DataFrame:
    """The dimension's description of each name, or the name itself."""
    d = dimension.select(F.col("name").alias("_name"), F.col("description").alias("_description"))
    return rows.join(d, F.col(column) == F.col("_name"), "left").withColumn(into, F.coalesce("_description", column)).drop("_name", "_description")


def seeded_sample(rows: DataFrame, key: str, names: list[str], n: int, seed: int, into: str) -> DataFrame:
    """``n`` names for each row, an array in order of a seeded hash of row and name; inside the row, no join."""
    ranked = F.sort_array(
        F.array(*[F.struct(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.lit(x)), 256).alias("h"), F.lit(x).alias("name")) for x in names])
    )
    return rows.withColumn(into, F.transform(F.slice(ranked, 1, n), lambda x: x["name"]))


def previous_user_turn(rows: DataFrame, conversation: str, turn: str, text: str, into: str = "context") -> DataFrame:
    """The user turn before each user turn, ``none`` for the first. ``rows``: user turns."""
    w = Window.partitionBy(conversation).orderBy(turn)
    return rows.withColumn(into, F.coalesce(F.lag(text).over(w), F.lit("none")))


def first_rows(rows: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first ``n`` rows; all if ``n`` is 0 or None."""
    return rows.orderBy(*order).limit(n) if n else rows
