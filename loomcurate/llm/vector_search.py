"""Approximate nearest neighbours by cross-polytope hashing, ranked by exact inner products.

Vectors are turned by fast pseudo-rotations (three rounds of random signs and a Hadamard transform, after padding to a
power of two) and hashed to the nearest signed axis. A table's code is several such hashes, the last over fewer axes, so that
the number of codes follows the number of rows: ``BUCKET_ROWS`` rows a code at every size. A query probes the codes of the
greatest summed margin in each table: a share of all codes, ``PROBED`` * rows ** -``DECAY`` (1 at most), which falls with the
table. ``exact=True`` probes everything. Candidates get their exact inner product in double precision.

Inner products of vectors of unequal length are reduced to angles: rows are grouped in bands of like length, and within a
band padded by the one component that makes lengths equal; queries probe every band.

Tables are searched in turns, as many at once as ``TURN_BYTES`` hold, one at least. In a turn a table's rows are dealt to blocks
of like codes (at least ``BLOCK_ROWS`` and at most ``MOST_BLOCK_ROWS`` rows, else a ``BLOCKS``-th of them), and a query goes only to
blocks whose codes it probes, with those codes. A task holds one block, looks its rows up by code and multiplies queries by their own
candidates alone, so no pair is ever a row. The best that a query has found so far bound what later turns give out for it;
where there are many turns, a short one (a ``LEAD``-th of the codes of one table) comes first. Queries are taken in as many parts as
keep their copies at ``COPIES`` times the rows' bytes, and shuffles go as each table is written: disk holds the index, one table's
rows and those copies, in proportion to the input. Equal vectors are collapsed to one with its smallest ids (one more than are
asked for suffice), so a vector that fills a third of the table is hashed and compared once. To the driver come only counts per
table and first axis. A query that finds fewer rows than asked for, while there are more, is compared with all rows in a last turn.

Work grows with queries times rows times the falling share, so more slowly than the square of the table where queries are
a fixed share of it; the README has measured recall and shares.

Defined cases: null, empty and zero vectors, vectors with null or non-finite components, of another dimension than most,
or with a null id take no part; equal rows of one id count once; ties go to the smaller id; an empty table, or one without a
query, gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ready, release, stored

TABLES, NEAREST = 10, 20
EVERY = 20
#: Rows a code, and the share of codes that a query probes in a table: PROBED * rows ** -DECAY.
BUCKET_ROWS, PROBED, DECAY = 4, 1.85, 0.45
#: Rows of a block, blocks of a table; bytes of tables searched in one turn, and of a task's rows; share of codes in a first turn, bytes of queries to bytes of rows.
BLOCK_ROWS, MOST_BLOCK_ROWS, BLOCKS = 1_024, 262_144, 12
TURN_BYTES, TASK_BYTES, LEAD, COPIES = 100_000_000, 4_000_000, 16, 1.0
#: Pairs whose scores are held, and multiplied, at once.
PAIRS, SLICE = 1_000_000, 16_384
SEED = 8


def hadamard(y: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, of length a power of two, scaled to keep lengths."""
    n, d = y.shape
    h = 1
    while h < d:
        pairs = y.reshape(n, -1, 2, h)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return y / math.sqrt(d)


def rotated(x: np.ndarray, axes: int, t: int, seed: int = SEED) -> np.ndarray:
    signs = np.random.default_rng([seed, t]).choice([-1.0, 1.0], size=(3, axes))
    y = np.zeros((len(x), axes))
    y[:, : x.shape[1]] = x
    for s in signs:
        y = hadamard(y * s)
    return y


def hash_axes(rows: int, axes: int, bucket_rows: int = BUCKET_ROWS) -> list[int]:
    """Axes of each hash of a table's code, so that there are about ``rows / bucket_rows`` codes (signed axes count twice)."""
    codes, out = max(1, rows // bucket_rows), []
    while codes >= 2 * axes:
        out.append(axes)
        codes //= 2 * axes
    last = codes.bit_length() - 1
    return [*out, 1 << (last - 1)] if last else out


@lru_cache(maxsize=64)
def rotation(width: int, axes: int, t: int) -> np.ndarray:
    """The rotation ``t`` of vectors of ``width`` components as a matrix."""
    return rotated(np.eye(width), axes, t)


def margins(x: np.ndarray, axes: int, t: int, hashes: list[int]) -> list[np.ndarray]:
    """For each hash of table ``t``, the component of each row along each signed axis (2 axis, and 2 axis + 1 for the negative)."""
    out = []
    for i, some in enumerate(hashes):
        y = x @ rotation(x.shape[1], axes, t * 64 + i)[:, :some]
        out.append(np.stack([y, -y], axis=2).reshape(len(y), -1))
    return out


def codes(x: np.ndarray, axes: int, hashes: list[int], tables: int) -> np.ndarray:
    """rows x tables: the code of each row in each table, the table's number in the highest bits."""
    out = np.empty((len(x), tables), dtype=np.int64)
    for t in range(tables):
        code = np.zeros(len(x), dtype=np.int64)
        for along in margins(x, axes, t, hashes):
            code = code * along.shape[1] + along.argmax(axis=1)
        out[:, t] = code | t << 56
    return out


@lru_cache(maxsize=64)
def _top_places(m: int, width: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in two falling lists of ``m`` and ``width`` whose sums may be among the ``count`` greatest: (i + 1) (j + 1) - 1 sums are no less."""
    ends = np.minimum(width, count // np.arange(1, m + 1))
    i = np.repeat(np.arange(m), ends)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(ends) - ends, ends)


def table_probes(x: np.ndarray, axes: int, hashes: list[int], t: int, count: int) -> np.ndarray:
    """rows x count: the codes of table ``t`` of the greatest summed margin."""
    total, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), dtype=np.int64)
    for along in margins(x, axes, t, hashes):  # the best sums go on with the best sums of their beginnings
        width = along.shape[1]
        axis = np.argsort(-along, axis=1)
        along = np.take_along_axis(along, axis, axis=1)
        i, j = _top_places(total.shape[1], width, count)
        total, code = total[:, i] + along[:, j], code[:, i] * width + axis[:, j]
        best = np.argpartition(-total, count - 1, axis=1)[:, :count] if total.shape[1] > count else np.tile(np.arange(total.shape[1]), (len(x), 1))
        total = np.take_along_axis(total, best, axis=1)
        falling = np.argsort(-total, axis=1)
        total, code = np.take_along_axis(total, falling, axis=1), np.take_along_axis(code, np.take_along_axis(best, falling, axis=1), axis=1)
    return code


def probes(x: np.ndarray, axes: int, hashes: list[int], tables: int, count: int) -> np.ndarray:
    """rows x (tables x count): in each table the ``count`` codes of the greatest summed margin."""
    return np.concatenate([table_probes(x, axes, hashes, t, count) | t << 56 for t in range(tables)], axis=1)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, v (array of float, if it is one already, or of double): the rows that take part."""
    w = F.col("v")
    finite = F.forall(w, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kind = "array<float>" if rows.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    found = rows.select(F.col(key).alias("vec_id"), F.col(vector).cast(kind).alias("v"))
    found = found.where(F.col("vec_id").isNotNull() & w.isNotNull()).where(finite & F.exists(w, lambda x: x != 0))
    common = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return found.where(F.size("v") == (common[0]["d"] if common else 0))


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column one after another, and the number of values of each row."""
    kind = np.dtype(kind)
    column = column.cast(pa.binary())
    if not len(column):
        return np.empty(0, kind), np.empty(0, dtype=np.int64)
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, dtype=np.uint8)
    return np.frombuffer(data.tobytes(), dtype=kind), np.diff(ends) // kind.itemsize


def _spread(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places from each start on, ``n`` of them, one after another."""
    return np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)


class Block:
    """The rows of a block, and which of them have which code."""

    def __init__(self, parts: list[pa.RecordBatch], kind: str):
        self.x = np.concatenate([_flat(p.column("vector"), kind)[0] for p in parts]).reshape(sum(p.num_rows for p in parts), -1)
        self.others = np.concatenate([p.column("other").to_numpy() for p in parts])
        ids = [_flat(p.column("ids"), "<i8") for p in parts]
        self.ids, self.n_ids = np.concatenate([i for i, _ in ids]), np.concatenate([n for _, n in ids])
        self.first_id = np.cumsum(self.n_ids) - self.n_ids
        code = np.concatenate([p.column("code").to_numpy() for p in parts])
        self.order, self.low = np.argsort(code, kind="stable"), int(code.min())
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(code - self.low))))
        longest = math.sqrt(max(float((y.astype(np.float64) ** 2).sum(axis=1).max()) for y in np.array_split(self.x, len(self.x) // SLICE + 1)))
        if not 1e-15 < longest < 1e15:  # sums of single precision might overflow or vanish
            self.x = self.x.astype(np.float64)
        self.error = 4 * self.x.shape[1] * float(np.finfo(self.x.dtype).eps) * longest

    def candidates(self, probed: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, start, number) of runs of ``order``: the rows of each probed code; all rows for queries that name no code."""
        asker, at = np.repeat(np.arange(len(n)), n), probed.astype(np.int64) - self.low
        there = (at >= 0) & (at < len(self.ends) - 1)
        asker, at = asker[there], at[there]
        every = np.flatnonzero(n == 0)
        start = np.concatenate((self.ends[at], np.zeros(len(every), dtype=np.int64)))
        many = np.concatenate((self.ends[at + 1] - self.ends[at], np.full(len(every), len(self.x))))
        asker = np.concatenate((asker, every))
        some = np.flatnonzero(many)
        some = some[np.argsort(asker[some], kind="stable")]
        return asker[some], start[some], many[some]

    def pairs(self, probed: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) of all candidates, those of a query together."""
        asker, start, many = self.candidates(probed, n)
        total = np.bincount(asker, weights=many, minlength=len(n)).astype(np.int64)
        turn = np.cumsum(total) // PAIRS
        for a, b in _runs(turn[asker]):
            yield np.repeat(asker[a:b], many[a:b]), self.order[_spread(start[a:b], many[a:b])]

    def best(self, q: np.ndarray, bounds: np.ndarray, asker: np.ndarray, row: np.ndarray, nearest: int) -> tuple[np.ndarray, ...]:
        """(query, away, id, other) of the best ids among the pairs, ``nearest`` for a query; none that is farther than its bound."""
        wide = q.astype(np.float64)
        length = np.sqrt((wide**2).sum(axis=1))
        unit = (wide / length[:, None]).astype(self.x.dtype)
        score = np.concatenate([np.einsum("ij,ij->i", self.x[row[a : a + SLICE]], unit[asker[a : a + SLICE]]) for a in range(0, len(row), SLICE)])
        near = np.flatnonzero(score >= (-bounds / length)[asker] - self.error)
        near = near[np.lexsort((-score[near], asker[near]))]
        last = _place(asker[near]) == nearest - 1
        least = np.full(len(q), -np.inf)
        least[asker[near[last]]] = score[near[last]]
        near = near[score[near] >= least[asker[near]] - 2 * self.error]
        asker, row = asker[near], row[near]
        away = np.empty(len(row))
        for a in range(0, len(row), SLICE):  # a function of the two vectors alone
            away[a : a + SLICE] = -(self.x[row[a : a + SLICE]].astype(np.float64) * wide[asker[a : a + SLICE]]).sum(axis=1)
        n = self.n_ids[row]
        asker, away, other, ids = np.repeat(asker, n), np.repeat(away, n), np.repeat(self.others[row], n), self.ids[_spread(self.first_id[row], n)]
        order = np.lexsort((other, ids, away, asker))
        order = order[(_place(asker[order]) < nearest) & (away[order] <= bounds[asker[order]])]
        return asker[order], away[order], ids[order], other[order]


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)] if len(keys) else [0]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _place(keys: np.ndarray) -> np.ndarray:
    """The place of each key in its run, from 0."""
    starts = np.concatenate((np.zeros(min(1, len(keys)), dtype=np.int64), np.flatnonzero(np.diff(keys)) + 1))
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))


def _scan(nearest: int, kind: str, pairs: bool):
    """Streams blocks, the rows of each (query null) before its queries, into (vid, away, vec_id, other); of all candidates for ``pairs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block = None, [], None
        for batch in batches:
            numbers, asks = batch.column("block").to_numpy(), batch.column("query").is_valid().to_numpy(zero_copy_only=False)
            for a, b in _runs(numbers * 2 + asks):
                part = batch.slice(a, b - a)
                if numbers[a] != current:
                    current, held, block = numbers[a], [], None
                if not asks[a]:
                    held.append(part)
                    continue
                block, held = block or Block(held, kind), []
                vid, q = part.column("query").to_numpy(), _flat(part.column("vector"), kind)[0].reshape(b - a, -1)
                bounds = part.column("bound").to_numpy(zero_copy_only=False)
                for asker, row in block.pairs(*_flat(part.column("probed"), "<i4")):
                    if pairs:
                        found = (asker, np.zeros(len(row)), np.zeros(len(row), dtype=np.int64), block.others[row])
                    else:
                        found = block.best(q, bounds, asker, row, nearest)
                    yield pa.RecordBatch.from_arrays([pa.array(vid[found[0]]), *map(pa.array, found[1:])], names=["vid", "away", "vec_id", "other"])

    return run


def _blocks(counts: dict[tuple[int, int], int], block_rows: int) -> list[tuple[int, int, int, int]]:
    """(table, cell, block, parts): rows of a table whose first axis is ``cell`` go to ``parts`` blocks from ``block`` on."""
    out, block, filled, table = [], -1, 0, None
    for (t, cell), n in sorted(counts.items()):
        parts = math.ceil(n / block_rows)
        if parts > 1 or t != table or filled + n > block_rows:
            block, filled, table = block + 1, 0, t
        out.append((t, cell, block, parts))
        filled += n
        if parts > 1:
            block, table = block + parts - 1, None
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def _binary(x: np.ndarray) -> pa.Array:
    """A binary column of the rows of ``x``."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


@contextmanager
def _short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a table's shuffle files go as soon as it is written, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Index:
    """The distinct vectors of a table with their codes, and which block of each table has which codes."""

    def __init__(self, all_rows: DataFrame, nearest: int, tables: int, every: int, made: list):
        self.nearest, self.tables, self.made = nearest, tables, made
        first = Window.partitionBy("vid").orderBy("vec_id")
        members = all_rows.select("vid", "vec_id").distinct().withColumn("i", F.row_number().over(first)).where(F.col("i") <= nearest + 1)
        ids = members.groupBy("vid").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        one = all_rows.groupBy("vid").agg(F.min("v").alias("v"), F.max(F.col("vec_id") % every == 0).alias("asks")).join(ids, "vid").withColumn("size", size)
        mine: list = []
        vectors = stored(one.withColumn("band", F.round(F.log2("size")).cast("int")), mine)
        about = vectors.agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids"), F.count_if("asks").alias("asked"), F.max(F.size("v")).alias("d")).first()
        self.n, self.ids, self.asked, self.d = about["n"], about["ids"] or 0, about["asked"], about["d"] or 1
        tops = {r["band"]: r["top"] for r in vectors.groupBy("band").agg(F.max("size").alias("top")).collect()}  # one for each power of two
        self.kind = kind = "<f4" if vectors.schema["v"].dataType.simpleString() == "array<float>" else "<f8"
        self.width = self.d * int(kind[-1]) + 90  # bytes of a row in a shuffle
        self.axes = axes = 1 << max(1, math.ceil(math.log2(self.d + 1)))
        self.hashes = hashes = hash_axes(self.n, axes)
        self.rest = rest = math.prod(2 * h for h in hashes[1:])

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(at, 2048) for at in range(0, batch.num_rows, 2048)):
                    x = _matrix(part.column("v"))
                    unit = x / np.array([tops[b] for b in part.column("band").to_pylist()])[:, None]
                    whole = np.concatenate([unit, np.sqrt(np.maximum(0.0, 1 - (unit**2).sum(axis=1)))[:, None]], axis=1)
                    found = (codes(whole, axes, hashes, tables) & (1 << 56) - 1).astype(np.int32)
                    found = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables), pa.array(found.reshape(-1)))
                    ids = pa.array([np.array(i, dtype="<i8").tobytes() for i in part.column("ids").to_pylist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column("vid"), part.column("asks"), _binary(x.astype(kind)), ids, found], names=["vid", "asks", "vector", "ids", "codes"])

        self.rows = stored(vectors.select("vid", "asks", "v", "band", "ids").mapInArrow(place, "vid long, asks boolean, vector binary, ids binary, codes array<int>"), made)
        release(mine)
        cells = self.rows.select(F.posexplode("codes").alias("t", "code")).groupBy("t", F.expr(f"code div {rest}").cast("int").alias("cell")).count()
        counts = {(r["t"], r["cell"]): r["count"] for r in cells.collect()}  # at most axes x 2 a table
        self.blocks = _blocks(counts, min(MOST_BLOCK_ROWS, max(BLOCK_ROWS, math.ceil(self.n / BLOCKS))))

    def turn(self, asked: DataFrame, turn_tables: list[int], count: int, pairs: bool = False) -> DataFrame:
        """(vid, away, vec_id, other): for each asked (vid, vector, bound) the best of each block, or all candidates for ``pairs``."""
        axes, hashes, rest, kind = self.axes, self.hashes, self.rest, self.kind
        spark, layout = asked.sparkSession, [b for b in self.blocks if b[0] in turn_tables]
        at = {t: np.full((2, 2 * hashes[0] if hashes else 1), -1, dtype=np.int64) for t in turn_tables}  # first block and parts of each cell
        for t, cell, block, parts in layout:
            at[t][:, cell] = block, parts
        every = count >= math.prod(2 * h for h in hashes)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(a, 64) for a in range(0, batch.num_rows, 64)):
                    x = _flat(part.column("vector"), kind)[0].reshape(part.num_rows, -1).astype(np.float64)
                    x /= np.sqrt((x**2).sum(axis=1))[:, None]
                    for t in turn_tables:
                        if every:
                            asker, cell = np.repeat(np.arange(len(x)), at[t].shape[1]), np.tile(np.arange(at[t].shape[1]), len(x))
                            probed = np.empty(len(cell), dtype="<i4")
                        else:
                            probed = np.sort(table_probes(x, axes, hashes, t, count), axis=1)
                            asker, probed = np.repeat(np.arange(len(x)), probed.shape[1]), probed.reshape(-1).astype("<i4")
                            cell = probed // rest
                        there = at[t][0][cell] >= 0
                        asker, cell, probed = asker[there], cell[there], probed[there]
                        runs = _runs(asker << 32 | at[t][0][cell])  # a query's codes of one block
                        if not runs:
                            continue
                        starts = np.array([a for a, _ in runs])
                        ends = np.zeros(len(runs) + 1, dtype=np.int32) if every else np.append(starts, len(cell)).astype(np.int32) * 4
                        named = pa.Array.from_buffers(pa.binary(), len(runs), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(probed))])
                        n = at[t][1][cell[starts]]
                        again, who = pa.array(np.repeat(np.arange(len(runs)), n)), pa.array(np.repeat(asker[starts], n))
                        blocks = pa.array(_spread(at[t][0][cell[starts]], n))
                        yield pa.RecordBatch.from_arrays([blocks, *(part.column(c).take(who) for c in ("vid", "vector", "bound")), named.take(again)], names=["block", "query", "vector", "bound", "probed"])

        queries = asked.select("vid", "vector", "bound").mapInArrow(probe, "block long, query long, vector binary, bound double, probed binary")
        placed = self.rows.select(F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.col("codes")[t].alias("code")) for t in turn_tables))).alias("at"), "vid", "vector", "ids")
        placed = placed.select("at.t", "at.code", F.expr(f"at.code div {rest}").cast("int").alias("cell"), F.col("vid").alias("other"), "vector", "ids")
        placed = placed.join(F.broadcast(spark.createDataFrame(layout, "t int, cell int, first long, parts long")), ["t", "cell"])
        placed = placed.select((F.col("first") + F.pmod("other", "parts")).alias("block"), F.lit(None).cast("long").alias("query"), "other", "code", "vector", "ids")
        met = placed.unionByName(queries, allowMissingColumns=True)
        least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), self.n * len(turn_tables) * self.width // TASK_BYTES)
        tasks = max(1, min(2 * sum(b[3] for b in layout), least))  # twice, as blocks may fall on one task by their hashes
        met = met.repartition(tasks, "block").sortWithinPartitions("block", "query")  # a block's rows first
        return met.mapInArrow(_scan(self.nearest + 1, kind, pairs), "vid long, away double, vec_id long, other long")

    def best(self, found: DataFrame) -> DataFrame:
        """The best of each vid, once each and one more than asked for, ``place`` from 1."""
        place = F.dense_rank().over(Window.partitionBy("vid").orderBy("away", "vec_id", "other"))
        return found.withColumn("place", place).where(F.col("place") <= self.nearest + 1).dropDuplicates(["vid", "place"])

    def turns(self, count: int, blocks: int) -> tuple[list[tuple[list[int], int]], int]:
        """(tables, codes) of each turn, and the number of parts in which queries are taken."""
        rows, queries = self.n * self.width, self.asked * (blocks * self.width + 4 * count)
        parts = max(1, math.ceil(queries / max(TURN_BYTES, COPIES * rows)))
        some = min(self.tables, max(1, int(TURN_BYTES // max(1, rows + queries / parts))))
        turns = [(list(range(t, min(self.tables, t + some))), count) for t in range(0, self.tables, some)]
        return ([([0], math.ceil(count / LEAD))] if len(turns) > 2 else []) + turns, parts

    def search(self, share: float) -> DataFrame:
        """(vid, away, vec_id, other, place): the best that each asking vector finds."""
        there = math.prod(2 * h for h in self.hashes)
        count = min(there, math.ceil(there * share))
        asking = stored(self.rows.where("asks").select("vid", "vector"), self.made)
        per_table = max((sum(p for t, _, _, p in {(b[0], 0, b[2], b[3]) for b in self.blocks} if t == table) for table in range(self.tables)), default=1)
        turns, parts = ([([0], there)], 1) if count == there else self.turns(count, per_table)
        out = []
        for part in range(parts):
            some, found, last = asking.where(F.pmod("vid", F.lit(parts)) == part), None, []
            for turn_tables, codes_each in turns:
                found, last = self._further(some, found, turn_tables, codes_each, last)
            self.made += last
            out.append(found)
        found = out[0]
        for more in out[1:]:
            found = found.unionByName(more)
        full = found.groupBy("vid").count().where(F.col("count") >= min(self.nearest + 1, self.ids))
        if count < there:
            short = stored(asking.join(full, "vid", "left_anti"), self.made)
            if not short.isEmpty():
                found = found.join(short, "vid", "left_anti").unionByName(self.best(self.turn(short.withColumn("bound", F.lit(float("inf"))), [0], there)))
        return found

    def _further(self, asking: DataFrame, found: DataFrame | None, turn_tables: list[int], count: int, last: list) -> tuple[DataFrame, list]:
        """``found`` after one more turn, and its table; the tables in ``last`` go."""
        if found is None:
            new = self.turn(asking.withColumn("bound", F.lit(float("inf"))), turn_tables, count)
        else:
            farthest = found.where(F.col("place") == self.nearest + 1).select("vid", F.col("away").alias("bound"))
            bounded = asking.join(farthest, "vid", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
            new = found.drop("place").unionByName(self.turn(bounded, turn_tables, count))
        mine: list = []
        after = stored(self.best(new), mine)
        release(last)
        return after, mine


def search(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, nearest: int = NEAREST, tables: int = TABLES,
    probed: float = PROBED, decay: float = DECAY, exact: bool = False,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each query (rows whose id is divisible by ``every``)."""
    ready(rows.sparkSession)
    made: list = []
    with _short_shuffles(rows.sparkSession):
        all_rows = usable(rows, key, vector).withColumn("vid", F.xxhash64("v"))
        index = Index(all_rows, nearest, tables, every, made)
        found = index.search(1.0 if exact else probed * max(1, index.n) ** -decay)
        found = stored(found.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("away", "vec_id"))).alias("found")), made)
        asking = all_rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vid").distinct()
        own = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
        ranked = asking.join(found, "vid").select("query_id", F.posexplode(own).alias("i", "hit"))
        out = stored(ranked.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.away")).alias("score")))
    release(made)
    return out


def share_scored(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, nearest: int = NEAREST, tables: int = TABLES, probed: float = PROBED, decay: float = DECAY) -> float:
    """The share of all (query, row) pairs that are candidates in some table; ``search`` scores a pair once a table that has it."""
    ready(rows.sparkSession)
    made: list = []
    index = Index(usable(rows, key, vector).withColumn("vid", F.xxhash64("v")), nearest, tables, every, made)
    there = math.prod(2 * h for h in index.hashes)
    count = min(there, math.ceil(there * probed * max(1, index.n) ** -decay))
    asked = index.rows.where("asks").select("vid", "vector", F.lit(0.0).alias("bound"))
    share = index.turn(asked, list(range(tables)), count, pairs=True).select("vid", "other").distinct().count() / max(1, index.asked * index.n)
    release(made)
    return share
