"""Removal of boilerplate lines by the number of distinct sites they occur on.

Each line (white space at its ends aside) is hashed to 64 bits; one HyperLogLog sketch of sites per hash is merged by
aggregation. Lines whose estimate is near the threshold get an exact distinct count, the rest are decided by the sketch.
A line on at least ``min_sites`` sites is boilerplate: it stays at its first place (smallest document id, then text hash,
then line number), so no wording is lost from the corpus, and goes everywhere else.

Only DataFrame operations are used. Sketches are merged before the shuffle, so a line that fills a third of the corpus
is a row per task; sites are counted per (line, site) pair. Only the places of candidate lines are shuffled, and texts
once, to be rewritten.

Defined cases: null text has no lines and stays null; a null site is a site of its own; blank lines are never boilerplate;
identical rows (same id and text) are one document and keep or lose the same lines; repeats inside one document are
places like any other; texts of any length are rewritten whole; an empty table gives no rows; further columns are carried
along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, bound, fresh, stored

MIN_SITES = 10
LG_K = 12


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def places(docs: DataFrame, key: str, site: str, text: str) -> DataFrame:
    """doc, digest, place, line, site: a row for each line that is not blank."""
    lines = F.posexplode(F.split(F.col(text), "\n")).alias("place", "words")
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("digest"), F.xxhash64(F.coalesce(F.col(site), F.lit("\0none"))).alias("site"), lines
    )
    bare = _bare(F.col("words"))
    return rows.where(bare != "").select("doc", "digest", "place", F.xxhash64(bare).alias("line"), "site")


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> tuple[DataFrame, DataFrame]:
    """(line) of boilerplate lines, and the stored places of all candidate lines."""
    margin = max(1.0, 3 * 1.04 / math.sqrt(2**lg_k) * min_sites)
    sketches = rows.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    candidates = stored(sketches.where(F.col("sites") >= min_sites - margin))
    found = stored(rows.join(candidates, "line"))
    certain = candidates.where(F.col("sites") > min_sites + margin).select("line")
    near = found.where(F.col("sites") <= min_sites + margin).select("line", "site").distinct()
    exact = near.groupBy("line").agg(F.count("*").alias("exact")).where(F.col("exact") >= min_sites).select("line")
    return stored(certain.unionByName(exact)), found  # of known size: if small, the places are not shuffled to meet it


def removals(rows: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(doc, digest, gone): line numbers that go, for documents that lose any."""
    lines, found = boilerplate(rows, min_sites, lg_k)
    place = F.struct("doc", "digest", "place")
    hits = stored(found.drop("sites").join(lines, "line"))
    first = stored(hits.groupBy("line").agg(F.min(place).alias("first")))
    later = hits.join(first, "line").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc", "digest").agg(F.collect_set("place").alias("gone"))


def clean(
    docs: DataFrame, key: str = "doc_id", site: str = "source", text: str = "text", min_sites: int = MIN_SITES, lg_k: int = LG_K,
    n_lines: str | None = None, n_removed: str | None = None,
) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``; optional columns count lines and removed lines."""
    digest, gone, of, of_digest = fresh(docs, "text_digest", "gone_lines", "gone_of", "gone_of_digest")
    gone_rows = removals(places(docs, key, site, text), min_sites, lg_k)
    gone_rows = gone_rows.select(F.col("doc").alias(of), F.col("digest").alias(of_digest), F.col("gone").alias(gone))
    keyed = docs.withColumn(digest, F.xxhash64(F.col(text)))
    joined = keyed.join(gone_rows, F.col(key).eqNullSafe(F.col(of)) & (F.col(digest) == F.col(of_digest)), "left")

    def rewrite(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
        return F.array_join(F.transform(stay, lambda i: lines[i]), "\n")

    new = F.when(F.col(gone).isNull(), F.col(text)).otherwise(bound(F.split(F.col(text), "\n"), rewrite))
    extra = []
    if n_lines:
        extra.append(F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0)).cast("long").alias(n_lines))
    if n_removed:
        extra.append(F.coalesce(F.size(F.col(gone)), F.lit(0)).cast("long").alias(n_removed))
    return joined.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns], *extra)


def report(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, n_lines, n_removed, and the cleaned text."""
    out = clean(docs.select("doc_id", "source", "text"), n_lines="n_lines", n_removed="n_removed", **options)
    return out.select("doc_id", "n_lines", "n_removed", "text")


def oracle(min_sites: int = MIN_SITES) -> str:
    """DuckDB SQL for ``report`` (with distinct document ids)."""
    bare = "trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return f"""
with d as (select doc_id, source, text, string_split(text, chr(10)) ls from documents),
l as (select doc_id, source, unnest(ls) line, unnest(range(len(ls))) place from d where text is not null),
b as (select doc_id, place, line, {bare} bare, coalesce(source, chr(0) || 'none') site from l),
x as (select bare, min((doc_id, place)) first_place from b where bare <> '' group by bare having count(distinct site) >= {min_sites}),
k as (select b.doc_id, b.place, line, x.bare is not null and (b.doc_id, b.place) <> first_place gone from b left join x using (bare)),
r as (select doc_id, count(*) n_lines, count(*) filter (gone) n_removed, coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') t from k group by doc_id)
select d.doc_id, coalesce(n_lines, 0)::bigint n_lines, coalesce(n_removed, 0)::bigint n_removed, case when text is null then null else t end as text
from d left join r using (doc_id)"""
