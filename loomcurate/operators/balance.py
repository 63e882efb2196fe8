"""Balancing a set of examples: a quota for each class, spread over primitives and domains.

The greedy choice (primitives in turn; of a primitive the least used domain, then the best quality) has a closed form:
rank by quality within (class, primitive, domain), rank by that within (class, primitive), and take by the second rank and
the primitive's place. Ties of quality go to the smaller id, and primitives are shuffled by a seeded hash.

No class needs more than its quota of any domain, so the first rank is cut at the largest quota: a literal, which lets
Spark limit each task before the shuffle, so a hot group does not travel whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def targets(spark, wanted: dict[str, int]) -> DataFrame:
    """(complexity, position, target): the classes in output order."""
    return spark.createDataFrame([(c, i, n) for i, (c, n) in enumerate(wanted.items())], "complexity string, position int, target int")


def shortfall(pool: DataFrame, wanted: DataFrame, complexity: str = "complexity") -> DataFrame:
    """complexity, target, available, taken: what the pool has for each class."""
    n = pool.groupBy(F.col(complexity).alias("complexity")).agg(F.count("*").alias("available"))
    rows = wanted.join(n, "complexity", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    return rows.select("complexity", "target", "available", F.least("available", "target").alias("taken"))


def primitive_order(seed: int, complexity: Column, primitive: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), complexity, F.coalesce(primitive, F.lit(""))), 256)


def balanced(pool: DataFrame, wanted: DataFrame, most: int, seed: int, key: str = "id", complexity: str = "complexity", primitive: str = "primitive", domain: str = "domain", quality: str = "quality_score") -> DataFrame:
    """Rows of ``pool`` chosen, with ``position`` of their class and ``place`` in it. ``most``: the largest target.

    Classes that are not wanted go; a class with fewer rows than its target is taken whole.
    """
    c, p, d = F.col(complexity), F.col(primitive), F.col(domain)
    w = wanted.select(F.col("complexity").alias("_class"), "position", "target")
    rows = pool.join(w, c == F.col("_class")).drop("_class")
    best = [F.col(quality).desc_nulls_last(), F.col(key)]
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(c, p, d).orderBy(*best))).where(F.col("_r") <= most)
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy(c, p).orderBy("_r", *best))).where(F.col("_k") <= most)
    place = F.row_number().over(Window.partitionBy(c).orderBy("_k", primitive_order(seed, c, p), *best))
    return rows.withColumn("place", place).where(F.col("place") <= F.col("target")).drop("_r", "_k", "target")
