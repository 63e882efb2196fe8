"""Coverage of primitives by domains, and its rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import Settings


def matrix(pairs: DataFrame, primitive: str = "primitive", domain: str = "domain") -> DataFrame:
    """(primitive, domain, n)."""
    return pairs.groupBy(F.col(primitive).alias("primitive"), F.col(domain).alias("domain")).agg(F.count("*").alias("n"))


def pivot(pairs: DataFrame, domains: list[str], primitive: str = "primitive", domain: str = "domain", total: str | None = None) -> DataFrame:
    """A row per primitive, a column per domain, 0 where there is none, and if named the ``total`` over all domains."""
    counts = [F.count_if(F.col(domain) == d).alias(d) for d in domains]
    counts += [F.count("*").alias(total)] if total else []
    return pairs.groupBy(F.col(primitive).alias("primitive")).agg(*counts).orderBy("primitive")


def undercovered(counts: DataFrame, primitives: DataFrame, domains: DataFrame, least: int) -> DataFrame:
    """primitive, domains_covered, missing: known primitives seen in fewer than ``least`` known domains.

    ``primitives`` (name) and ``domains`` (position, name) are the taxonomy; missing ones are listed in its order.
    """
    known = counts.join(domains.select(F.col("name").alias("domain"), "position"), "domain")
    seen = known.groupBy("primitive").agg(F.collect_set("domain").alias("seen"))
    listed = domains.agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "name"))), lambda x: x["name"]).alias("listed"))
    rows = primitives.select(F.col("name").alias("primitive")).join(seen, "primitive", "left").join(listed)
    covered = F.coalesce("seen", F.array().cast("array<string>"))
    rows = rows.select("primitive", F.size(covered).alias("domains_covered"), F.filter("listed", lambda d: ~F.array_contains(covered, d)).alias("missing"))
    return rows.where(F.col("domains_covered") < least)


def priority_gaps(counts: DataFrame, names: DataFrame, least: int) -> DataFrame:
    """primitive, count, required, deficit: priority primitives with fewer than ``least`` examples, of any domain."""
    totals = counts.groupBy("primitive").agg(F.sum("n").alias("total"))
    n = F.coalesce("total", F.lit(0))
    rows = names.select(F.col("name").alias("primitive")).join(totals, "primitive", "left")
    return rows.select("primitive", n.alias("count"), F.lit(least).alias("required"), (F.lit(least) - n).alias("deficit")).where(F.col("count") < least)


def domain_imbalance(counts: DataFrame, most: float) -> DataFrame:
    """domain, count, pct: domains with more than ``most`` of all pairs."""
    total = counts.agg(F.sum("n").alias("total"))
    by = counts.groupBy("domain").agg(F.sum("n").alias("count")).join(total)
    share = F.col("count") / F.greatest("total", F.lit(1))
    return by.where(share > most).select("domain", "count", F.round(share, 3).alias("pct"))


def _listed(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.sort_array(F.collect_list(F.struct(*rows.columns))).alias(name))


def report(pairs: DataFrame, primitives: DataFrame, domains: DataFrame, priority: DataFrame, settings: Settings, primitive: str = "primitive", domain: str = "domain") -> DataFrame:
    """One row: totals, the three lists of findings, the whole matrix, passed.

    The lists have at most a row per known name or domain, the matrix one per primitive and domain found: sizes of the
    taxonomy, not of the data.
    """
    counts = matrix(pairs, primitive, domain)
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_examples"), F.count_distinct("primitive").alias("unique_primitives"))
    under = undercovered(counts, primitives, domains, settings.min_domains).select("primitive", "domains_covered", F.lit(settings.min_domains).alias("required"), F.col("missing").alias("missing_domains"))
    gaps = priority_gaps(counts, priority, settings.min_priority_examples)
    skew = domain_imbalance(counts, settings.max_domain_share)
    by = counts.where("primitive is not null").groupBy("primitive").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("domain", F.lit("")).alias("domain"), "n"))).alias("domains"))
    whole = by.agg(F.map_from_entries(F.collect_list(F.struct("primitive", F.map_from_entries("domains")))).alias("coverage_matrix"))
    joined = totals.join(_listed(under, "undercovered_primitives")).join(_listed(gaps, "top10_gaps")).join(_listed(skew, "domain_imbalances")).join(whole)
    found = F.size("undercovered_primitives") + F.size("top10_gaps") + F.size("domain_imbalances")
    return joined.withColumn("passed", found == 0)
