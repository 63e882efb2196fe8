"""Quality gates over question and answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..settings import Settings
from ..taxonomy import ALLOWED_LEADS, BRANDS
from . import keyed


def drop_blank_pairs(rows: DataFrame, analysis: str, answer: str) -> DataFrame:
    """Rows go only where both texts are blank."""
    return rows.where(~(tx.is_blank(F.col(analysis)) & tx.is_blank(F.col(answer))))


def flags(pairs: DataFrame, key: str, question: str, answer: str, similarity: DataFrame | None, settings: Settings, brands=BRANDS, leads=ALLOWED_LEADS, tokens: Column | None = None) -> DataFrame:
    """``pairs`` with brand, token_count, is_duplicate, max_sim and pass flags.

    Both duplicate checks look at all pairs, before any gate: a row falls even if its twin fails for another reason.
    ``similarity``: (key, max_sim); none means no neighbours.
    """
    duplicates = keyed.duplicate_flags(pairs, key, tx.normalized_hash(F.col(question)), key).withColumnRenamed(key, "_id")
    out = pairs.join(duplicates, F.col(key).eqNullSafe(F.col("_id")), "left").drop("_id")
    if similarity is None:
        out = out.withColumn("max_sim", F.lit(0.0))
    else:
        near = similarity.select(F.col(similarity.columns[0]).alias("_id"), F.col("max_sim"))
        out = out.join(near, F.col(key) == F.col("_id"), "left").drop("_id").withColumn("max_sim", F.coalesce("max_sim", F.lit(0.0)))
    leak = tx.brand_leak(F.col(answer), brands, leads)
    count = tx.pre_token_count(F.col(answer)) if tokens is None else tokens
    return (
        out.withColumn("brand_reason", tx.brand_reason(leak))
        .withColumn("token_count", F.coalesce(count, F.lit(0)))
        .withColumn("passed_brand", F.col("brand_reason") == "OK")
        .withColumn("passed_length", F.col("token_count") >= settings.min_tokens)
        .withColumn("passed_duplicate", ~F.coalesce("is_duplicate", F.lit(False)))
        .withColumn("passed_near", F.col("max_sim") < settings.near_duplicate)
    )


GATES = ("passed_brand", "passed_length", "passed_duplicate", "passed_near")


def passes() -> Column:
    return F.col(GATES[0]) & F.col(GATES[1]) & F.col(GATES[2]) & F.col(GATES[3])


def reject_counters(flagged: DataFrame) -> DataFrame:
    """Rejects by reason; a row may count for several."""
    names = ("brand", "length", "duplicate", "near_duplicate")
    counts = [F.count_if(~F.col(g)).alias(f"rejected_{n}") for g, n in zip(GATES, names, strict=True)]
    return flagged.agg(F.count("*").alias("total"), F.count_if(passes()).alias("passed"), *counts)


def accepted(score: Column, settings: Settings) -> Column:
    """The judge's overall score alone decides."""
    return score >= settings.judge_threshold
