"""Statistics of the exported set and of the runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distribution(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def _as_text(rows: DataFrame, column: str, name: str) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.concat(F.coalesce("value", F.lit("")), F.lit("="), F.col("n").cast("string"))))
    return distribution(rows, column).agg(F.array_join(pairs, ";").alias(name))


def sidecar(examples: DataFrame) -> DataFrame:
    """One row: total, the three distributions as text, mean quality (0 for an empty set)."""
    out = examples.agg(F.count("*").alias("total_examples"), F.round(F.coalesce(F.avg("quality_score"), F.lit(0.0)), 6).alias("avg_quality_score"))
    for column in ("complexity", "primitive", "domain"):
        out = out.join(_as_text(examples, column, f"{column}_distribution"))
    return out


def sidecar_json(examples: DataFrame) -> DataFrame:
    """One row: the sidecar document, its distributions as objects."""
    total = examples.agg(F.count("*").alias("total_examples"), F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality_score"))
    for column in ("complexity", "primitive", "domain"):
        entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce("value", F.lit("")).alias("value"), "n"))))
        total = total.join(distribution(examples, column).agg(entries.alias(f"{column}_distribution")))
    return total.select(F.to_json(F.struct("total_examples", "complexity_distribution", "primitive_distribution", "domain_distribution", "avg_quality_score")).alias("value"))


def by_complexity(examples: DataFrame) -> DataFrame:
    """complexity, n, pct with one decimal, by name."""
    n = examples.groupBy("complexity").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(total).select("complexity", "n", F.round(100 * F.col("n") / F.col("total"), 1).alias("pct")).orderBy("complexity")


def top(examples: DataFrame, column: str, most: int = 15) -> DataFrame:
    """The most frequent values; ties by name."""
    return examples.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(most)


def by_domain(examples: DataFrame) -> DataFrame:
    """domain, short name for display, n: most frequent first."""
    return examples.groupBy("domain").agg(F.count("*").alias("n")).select("domain", F.substring("domain", 1, 8).alias("short"), "n").orderBy(F.desc("n"), "domain")


def usage(calls: DataFrame) -> DataFrame:
    """Token sums of all model calls."""
    names = ("prompt_tokens", "completion_tokens", "calls", "failed_calls")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
    return calls.agg(*sums).withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


def extraction_counters(rows: DataFrame, kept) -> DataFrame:
    return rows.agg(F.count_if(kept).alias("extracted"), F.count_if(~F.coalesce(kept, F.lit(False))).alias("skipped"))
