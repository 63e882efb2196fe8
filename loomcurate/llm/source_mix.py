"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources, in code point order with null last, get the weights 5, 2, 1, repeating, and share the words of all documents; a
target stops at ``most`` times its source's words and the excess is shared again by weight (a water level, found in
closed form). The total is then cut into blocks of ``block_words``, which go to sources by the highest quotients
target / (2 k + 1), and each source's blocks to its shards alike. A shard's words, documents in seeded order, form a
ring; the shard's quota is read off it from a seeded block on, so a document is taken whole, in part or repeatedly.

Highest quotients need no list of all blocks: bounds on the divisor leave a few open quotients for each source, and only
those are ranked. A source has a shard for every ``shard_words`` of its words, so a hot source is spread over many tasks.
Only DataFrame operations are used; the rows with global windows are one for each source.

Defined cases: null or empty text has size 0 and is never taken; null is a source; identical rows are separate
documents that lie next to each other on the ring; with no words at all every target is 0; texts of any length are counted whole; an empty table gives
no rows; further columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 18
SEED = 20


def source_key(source: Column) -> Column:
    """A non-null text for each source, ordered as sources are, null last."""
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source))


def seeded_hash(key: Column, text: Column, seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))), 256)


def _number(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 8), 16, 10).cast("long")


def targets(totals: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``totals`` (key, words: a row per source) with weight and target."""
    order = Window.partitionBy(F.lit(0)).orderBy("key")
    ranked = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("long"))
    ranked = ranked.withColumn("cap", most * F.col("words"))
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(0))
    level = (F.sum("words").over(whole) - (F.sum("cap").over(fill) - F.col("cap"))) / (F.sum("weight").over(whole) - (F.sum("weight").over(fill) - F.col("weight")))
    levels = ranked.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    water = F.coalesce(F.max(fits).over(whole), F.lit(0.0))
    return levels.select("key", "words", "weight", F.least(F.col("cap").cast("double"), water * F.col("weight")).alias("target"))


def apportion(rows: DataFrame, group: list[str], member: str, weight: str, seats: str) -> DataFrame:
    """(group, member, quota): ``seats`` of each group given to members by the highest quotients weight / (2 k + 1).

    The final divisor d has |seats - total / d| <= members / 2, which bounds each quota to within a few seats.
    """
    each = Window.partitionBy(*group)
    n, total = F.count("*").over(each), F.sum(weight).over(each)
    share = lambda s: F.when(total > 0, F.col(weight) * s / total).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0), F.ceil(share(F.col(seats) - n / 2) - 0.5) - 1).cast("long")
    high = F.floor(share(F.col(seats) + n / 2) + 0.5).cast("long") + 1
    bounds = rows.withColumn("low", low).withColumn("high", high).withColumn("rest", F.col(seats) - F.sum("low").over(each))
    trial = bounds.select(*group, member, weight, "low", "rest", F.explode(F.sequence("low", "high")).alias("k"))
    trial = trial.withColumn("quotient", F.col(weight) / (2 * F.col("k") + 1))
    best = Window.partitionBy(*group).orderBy(F.desc("quotient"), member)
    won = (F.row_number().over(best) <= F.col("rest")) & (F.col("quotient") > 0)
    return trial.withColumn("won", won).groupBy(*group, member).agg((F.max("low") + F.count_if("won")).alias("quota"))


def plan(measured: DataFrame, weights=WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED):
    """``measured`` (key, number, size; stored): the table of sources and the table of shards."""
    totals = measured.groupBy("key").agg(F.sum("size").alias("words"))
    sources = targets(totals, weights, most).withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("words") / shard_words)).cast("long"))
    blocks = F.floor(F.sum("words").over(Window.partitionBy(F.lit(0))) / block_words).cast("long")
    sources = stored(sources.withColumn("blocks", blocks).withColumn("all", F.lit(0)))
    quotas = apportion(sources, ["all"], "key", "target", "blocks").select("key", F.col("quota").alias("seats"))
    sharded = measured.join(sources.select("key", "shards"), "key").withColumn("shard", F.col("number") % F.col("shards"))
    shards = sharded.groupBy("key", "shard").agg(F.sum("size").alias("ring")).join(quotas, "key")
    parts = stored(apportion(shards, ["key"], "shard", "ring", "seats").join(shards.select("key", "shard", "ring"), ["key", "shard"]))
    start = _number(F.sha2(F.concat_ws(":", F.lit(str(seed)), "key", F.col("shard").cast("string")), 256), 1)
    ring_blocks = F.greatest(F.lit(1), F.floor(F.col("ring") / block_words)).cast("long")
    take = F.least(F.col("quota") * block_words, most * F.col("ring")).alias("take")
    return sources, parts.select("key", "shard", "ring", take, (start % ring_blocks * block_words).alias("start"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", size: Column | None = None, into: str = "mix", **options) -> DataFrame:
    """``docs`` with a struct ``into``: size, source_size, target, taken.

    ``size`` may name a measure already computed; its rows are then not split into words again.
    """
    seed = options.get("seed", SEED)
    k, digest, words, shard, at = fresh(docs, "source_key", "seeded", "size_in_words", "shard_number", "ring_start")
    rows = docs.withColumns({k: source_key(F.col(source)), digest: seeded_hash(F.col(key), F.col(text), seed), words: word_count(F.col(text)) if size is None else size})
    measured = stored(rows.select(F.col(k).alias("key"), _number(F.col(digest), 1).alias("number"), F.col(words).alias("size")))
    sources, shards = plan(measured, **options)
    s = sources.select(F.col("key").alias(k), F.struct("shards", F.col("words").alias("source_size"), "target").alias(into))
    p = shards.select(F.col("key").alias(k), F.col("shard").alias(shard), F.struct("ring", "take", "start").alias(at))
    rows = rows.join(s, k).withColumn(shard, _number(F.col(digest), 1) % F.col(f"{into}.shards")).join(p, [k, shard])
    order = Window.partitionBy(k, shard).orderBy(digest, F.col(key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(words).over(order)
    rows = rows.withColumn(shard, end)
    begin, end = F.col(shard) - F.col(words), F.col(shard)
    ring, take, start = (F.col(f"{at}.{c}") for c in ("ring", "take", "start"))
    rest = F.when(ring > 0, take % ring).otherwise(F.lit(0))
    overlap = lambda a, b: F.greatest(F.lit(0), F.least(end, b) - F.greatest(begin, a))
    taken = F.when(ring > 0, F.floor(take / ring) * F.col(words) + overlap(start, start + rest) + overlap(start - ring, start + rest - ring)).otherwise(F.lit(0))
    out = F.struct(F.col(words).cast("long").alias("size"), F.col(f"{into}.source_size").cast("long").alias("source_size"), F.col(f"{into}.target").alias("target"), taken.cast("long").alias("taken"))
    return rows.select(*docs.columns, out.alias(into))


def apply(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: each document round(taken / size) times, the same columns."""
    (into,) = fresh(docs, "mix")
    mixed = mix(docs, into=into, **options)
    times = F.when(F.col(f"{into}.size") > 0, F.round(F.col(f"{into}.taken") / F.col(f"{into}.size"))).otherwise(F.lit(0)).cast("int")
    return mixed.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), times)).alias(into)).select(*docs.columns)


def report(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken."""
    seed = options.get("seed", SEED)
    # the digest and the size are all that the mix needs of a text
    slim = docs.select("doc_id", "source", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text"), word_count(F.col("text")).alias("size"))
    mixed = mix(stored(slim), size=F.col("size"), **(options | {"seed": seed}))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def oracle(weights=WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED, docs: str = "documents", digest: str = "md5(md5(coalesce(text, '')))") -> str:
    """DuckDB SQL for ``report``: all quotients of all blocks are listed and ranked."""
    hexed = f"sha256('{seed}:' || coalesce(doc_id::varchar, 'null') || ':' || {digest})"
    return f"""
with d as (select doc_id, case when source is null then '2' else '1' || source end key, {hexed} h,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint size from {docs}),
t as (select key, sum(size)::bigint words, {most} * sum(size)::bigint cap, [{', '.join(map(str, weights))}][(row_number() over (order by key) - 1) % {len(weights)} + 1]::bigint weight from d group by key),
l as (select *, (sum(words) over () - sum(cap) over f + cap) / (sum(weight) over () - sum(weight) over f + weight) lev
  from t window f as (order by cap / weight, key rows unbounded preceding)),
s as (select key, words, least(cap::double, coalesce((select max(lev) from l where lev * weight <= cap), 0) * weight) target, greatest(1, ceil(words / {shard_words}))::bigint shards from l),
n as (select floor(sum(words) / {block_words})::bigint blocks from s),
q as (select key, target / (2 * k + 1) quotient from (select key, target, unnest(range(0, blocks)) k from s, n) where target > 0),
won as (select key, count(*) seats from (select key from q order by quotient desc, key limit (select blocks from n)) group by key),
x as (select d.*, s.words, target, (('0x' || h[1:8])::ubigint % shards)::bigint shard from d join s using (key)),
r as (select key, shard, sum(size)::bigint ring from x group by 1, 2),
rq as (select key, shard, ring / (2 * k + 1) quotient, seats from (select key, shard, ring, seats, unnest(range(0, seats)) k from r join won using (key)) where ring > 0),
rw as (select key, shard, count(*) quota from (select *, row_number() over (partition by key order by quotient desc, shard) i from rq) where i <= seats group by 1, 2),
p as (select key, shard, ring, least(coalesce(quota, 0) * {block_words}, {most} * ring) take,
  (('0x' || sha256('{seed}:' || key || ':' || shard::varchar)[1:8])::ubigint % greatest(1, ring // {block_words})::ubigint * {block_words})::bigint beg from r left join rw using (key, shard)),
y as (select x.*, ring, take, beg, case when ring > 0 then take % ring else 0 end rest, sum(size) over (partition by key, shard order by h, doc_id rows unbounded preceding)::bigint fin from x join p using (key, shard))
select doc_id, size, words source_size, target, (case when ring > 0 then (take // ring) * size
  + greatest(0, least(fin, beg + rest) - greatest(fin - size, beg)) + greatest(0, least(fin, beg + rest - ring) - greatest(fin - size, beg - ring)) else 0 end)::bigint taken from y"""
