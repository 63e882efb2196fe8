"""N-gram Jaccard join: documents whose sets of five-word shingles have a similarity of 0.8 or more, exactly.

1. Texts become sorted arrays of 64-bit shingle hashes. Documents with equal arrays form a class; one of each class goes on.
2. Prefix filter. Under any fixed order of shingles, two linked sets share one of their first n // 5 + 1. The order used
   puts a part of the shingles (by hash bits) first, the rarer ones in front, so passages and lines that many documents
   share come late. Codes that a fixed share of all rows have are few: pools of documents report what is frequent in them,
   the sums are broadcast, and hot codes come last in the order, their rows dealt out one by one. All others are dealt out
   by code once, to be counted; a code nobody else has is not sent on.
3. Classes that share a prefix code meet at a star: the code's first class. A star holds a class once, however many codes
   they share, and stars are not chained into components.
4. Stars are searched in size-banded tiles of bounded weight: small stars share tiles, a large one is cut into cells by set
   size and, for one size, by a hash. In a tile, bits of hashed bitmap signatures bound the overlap from above (a differing
   bit needs a differing shingle), and pairs that pass get the exact intersection of their sorted arrays. Pairs already
   connected are skipped: links are needed only to find components.
5. Cells of a large star are searched alone first. Then only cells that hold classes not yet connected meet, and the members
   of the largest component need not meet each other.
6. Components of the verified links; each gets the least document id.

Copies and groups of near copies send rows in proportion to their size. What stays quadratic, in tiles of bounded size, are
pairs in one large star that share rare shingles, are of like size, and yet are connected with nothing. Only codes are
compared between documents; texts of classes in stars are read a second time.

Defined cases: null text and text without words have an empty set and are linked with nothing; one to four words are one
shingle; very long texts weigh more in a tile; repeated rows are linked; a null id is never the least id of a component unless
all its ids are null; an empty table gives no rows; other columns, whatever their names, are not read. Hashes of shingles and
classes have 64 bits: two different ones agree with probability 2^-64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, fresh, ready, release, stored
from .graphs import components

SHINGLE = 5
#: Similarity as a fraction; the prefix is then n - ceil(n * NUMERATOR / DENOMINATOR) + 1 shingles.
NUMERATOR, DENOMINATOR = 80, 100
#: Shingles whose hash is in the first so many sixteenths are counted; a prefix takes a fifth of all.
COUNTED_SIXTEENTHS = 8
#: Most codes that can be hot (each has more than this part of all rows), and the least rows of a hot code.
HOT_SHARE, HOT_LEAST = 1 << 17, 1_000
#: Codes of a pool of documents, and how often a code must occur in one to be reported as a likely hot code.
POOL, OFTEN = 1 << 19, 16
#: Most weight of a tile: a class weighs 1, and one more for each LONG_SET shingles.
TILE, LONG_SET = 1_500, 1_000
SIGNATURE_BITS = 4096
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]
_KNOWN_WORDS, _KNOWN_CLASSES = 1 << 16, 1 << 18
#: Most bits of the bitmap that a second scan is filtered by: 8 MB.
NAME_BITS = 1 << 26


class Shingler:
    """Text -> sorted array of distinct shingle hashes; remembers the hashes of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and white space of 0x20, 0x09 to 0x0D
        if not tokens:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        n = len(codes)
        if n < SHINGLE:
            return np.array([xxhash.xxh3_64_intdigest(codes.tobytes(), seed=n)], dtype=np.uint64)
        mixed = np.zeros(n - SHINGLE + 1, dtype=np.uint64)
        for i, factor in enumerate(_MIX):
            mixed += (codes[i : n - SHINGLE + 1 + i] ^ (codes[i : n - SHINGLE + 1 + i] >> np.uint64(31))) * factor
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def prefix_length(n):
    return n - -(-n * NUMERATOR // DENOMINATOR) + 1


def class_of(hashes: np.ndarray) -> int:
    """A signed 64-bit name for a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(hashes))).astype(np.int64))


def chosen(found: np.ndarray) -> np.ndarray:
    """The shingles of a set that may be in its prefix: those of the counted part, and more where they are too few."""
    counted = (found & np.uint64(15)) < np.uint64(COUNTED_SIXTEENTHS)
    first, least = found[counted], prefix_length(len(found))
    return first if len(first) >= least else np.concatenate([first, found[~counted][: least - len(first)]])


def _sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, digest, ref, cls, n, codes, often: a row per document, and rows without n that hold only ``often``.

    ``codes``: those of ``chosen``, for the first of a class in a task. ``often``: codes that occur ``OFTEN`` times or more
    in a pool of documents of the task, with their number there.
    """
    kind = docs.schema[key].dataType.simpleString()
    often_kind = pa.list_(pa.struct([("code", pa.int64()), ("rows", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen, ref = Shingler(), set(), TaskContext.get().partitionId() << 33
        names = ["doc_id", "digest", "ref", "cls", "n", "codes", "often"]
        pool: list[np.ndarray] = []
        id_type = None

        def rows_of(ids, digests, first: int, classes: list[int], sizes: list[int], codes: list) -> pa.RecordBatch:
            n, some = len(classes), [c for c in codes if c is not None]
            ends = iter(np.cumsum([0, *map(len, some)]).tolist())
            flat = pa.array(np.concatenate([np.zeros(0, np.uint64), *some]).view(np.int64))
            offsets = pa.array([*(None if c is None else next(ends) for c in codes), next(ends)], pa.int32())  # a null makes a null list
            numbers = (pa.array(x, pa.int64()) for x in (range(first, first + n), classes, sizes))
            return pa.RecordBatch.from_arrays([ids, digests, *numbers, pa.ListArray.from_arrays(offsets, flat), pa.nulls(n, often_kind)], names=names)

        def often() -> pa.RecordBatch:
            code, rows = np.unique(np.concatenate(pool), return_counts=True)
            pool.clear()
            code, rows = code[rows >= OFTEN].view(np.int64), rows[rows >= OFTEN]
            found = pa.array([[{"code": c, "rows": r} for c, r in zip(code.tolist(), rows.tolist(), strict=True)]], often_kind)
            return pa.RecordBatch.from_arrays([pa.nulls(1, id_type), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.list_(pa.int64())), found], names=names)

        for batch in batches:
            id_type, at, classes, sizes, codes, held = batch.schema.types[0], 0, [], [], [], 0
            for i, value in enumerate(batch.column(1)):
                found = shingles(value.as_py())
                name = class_of(found)
                new = len(found) > 0 and name not in seen
                if new:
                    if len(seen) >= _KNOWN_CLASSES:
                        seen.clear()
                    seen.add(name)
                    held += len(found)
                classes.append(name)
                sizes.append(len(found))
                codes.append(chosen(found) if new else None)
                if held > POOL or i + 1 == batch.num_rows:
                    n = len(classes)
                    yield rows_of(batch.column(0).slice(at, n), batch.column(2).slice(at, n), ref, classes, sizes, codes)
                    pool += [c for c in codes if c is not None]
                    if sum(map(len, pool)) > POOL:
                        yield often()
                    at, ref, classes, sizes, codes, held = at + n, ref + n, [], [], [], 0
        if pool:
            yield often()

    schema = f"doc_id {kind}, digest long, ref long, cls long, n long, codes array<long>, often array<struct<code:long,rows:long>>"
    return docs.select(F.col(key), F.col(text), F.xxhash64(F.col(text))).mapInArrow(run, schema)


def _dealt_by_code():
    """Rows of a code together; rows of a hot code each apart."""
    return Window.partitionBy("code", F.when(F.col("hot"), F.col("ref")))


def _prefixes(coded: DataFrame, often: DataFrame, made: list) -> DataFrame:
    """(code, ref, n, hot): the shared codes in the prefix of each class.

    ``coded``: ref, n, codes; a row per class, named by a number whose neighbours are alike and so shuffles small.
    ``often``: code, rows. Sums of ``often`` find the hot codes: of more than 1 / ``HOT_SHARE`` of all rows and ``HOT_LEAST``.
    By this there are at most ``HOT_SHARE`` of them, so they are broadcast; they come last in the order. All others are
    dealt out by code and counted there; such a key has at most a hot code's least rows and ``OFTEN`` of each pool.
    """
    total = coded.agg(F.sum(F.size("codes"))).first()[0] or 0
    hot = often.groupBy("code").agg(F.sum("rows").alias("df")).where(F.col("df") >= max(HOT_LEAST, total // HOT_SHARE))
    hot = stored(hot.select("code", F.lit(True).alias("hot")), made)
    pairs = coded.select("ref", (F.shiftleft("n", 32) + F.size("codes")).alias("sizes"), F.explode("codes").alias("code"))
    pairs = pairs.join(F.broadcast(hot), "code", "left")
    known = pairs.withColumn("hot", F.coalesce("hot", F.lit(False))).withColumn("df", F.count("*").over(_dealt_by_code())).where("hot or df > 1")
    own = Window.partitionBy("ref")
    ranked = known.withColumn("rank", F.row_number().over(own.orderBy("hot", "df", "code"))).withColumn("shared", F.count("*").over(own))
    n, sent = F.shiftright("sizes", 32), F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1))
    least = n - F.ceil(n * NUMERATOR / DENOMINATOR) + 1  # prefix_length; codes that are nobody else's come first
    return ranked.where(F.col("rank") <= least - (sent - F.col("shared"))).select("code", "ref", n.alias("n"), "hot")


def _stars(prefixes: DataFrame) -> DataFrame:
    """(hub, ref, n): the least class of each prefix code with all classes that have the code; rows differ.

    Any two classes that share a prefix code meet at its hub, and the many codes of a group of near copies have few hubs.
    """
    hubs = prefixes.where("hot").groupBy("code").agg(F.min("ref").alias("hot_hub"), F.count("*").alias("hot_members"))  # no more than hot codes
    by_code = _dealt_by_code()
    met = prefixes.withColumn("hub", F.min("ref").over(by_code)).withColumn("members", F.count("*").over(by_code)).join(F.broadcast(hubs), "code", "left")
    met = met.withColumn("hub", F.coalesce("hot_hub", "hub")).where(F.coalesce("hot_members", "members") > 1)
    return met.groupBy("hub", "ref").agg(F.first("n").alias("n"))


def signature(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIGNATURE_BITS, dtype=bool)
    bits[(hashes >> np.uint64(20)) % np.uint64(SIGNATURE_BITS)] = True
    return np.packbits(bits).view(np.uint64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on sorted arrays of distinct hashes."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def tile_links(sets: list[np.ndarray], side: np.ndarray, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components of a tile, each from a component's first set.

    ``side``: in a tile that has a side 1, only pairs across the sides count. ``group``: components known before.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    sizes = np.array([len(sets[i]) for i in order])
    signs = np.array([signature(sets[i]) for i in order])
    sides, two = side[order], bool(side.any())
    group = np.arange(len(order)) if group is None else np.unique(group[order], return_inverse=True)[1]
    found = []
    for i in range(len(order) - 1):
        end = int(np.searchsorted(sizes, sizes[i] * DENOMINATOR // NUMERATOR, side="right"))
        rest = np.flatnonzero(group[i + 1 : end] != group[i]) + i + 1
        if two:
            rest = rest[sides[rest] != sides[i]]
        if not len(rest):
            continue
        apart = np.bitwise_count(signs[rest] ^ signs[i]).sum(axis=1, dtype=np.int64)
        most = (sizes[rest] + sizes[i] - apart) // 2
        rest = rest[DENOMINATOR * most >= NUMERATOR * (sizes[rest] + sizes[i] - most)]
        for j in rest:
            if group[j] != group[i] and linked(sets[order[i]], sets[order[j]]):
                found.append((order[i], order[j]))
                group[group == group[j]] = group[i]
    return found


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    links = []
    for _, block in rows.sort_values(["hub", "cls"]).groupby("hub", sort=False):
        names = block["cls"].to_numpy()
        sets = [np.frombuffer(x, dtype="<u8") for x in block["hashes"]]
        links += [(names[i], names[j]) for i, j in tile_links(sets, block["side"].to_numpy(), block["known"].to_numpy())]
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(cls, hashes) of the documents named by ``wanted`` (wanted_id, wanted_digest), read and shingled again.

    A bitmap of hashed names, of at most ``NAME_BITS`` bits, picks the rows inside the scan, so texts are not shuffled;
    the few rows it takes by mistake find no class later. Where the names are too many for it, a semi join picks them.
    """
    name = lambda doc, digest, bits: F.pmod(F.xxhash64(doc, digest), F.lit(bits)) + 1
    n = wanted.count()
    bits = 1 << max(15, math.ceil(math.log2(16 * n + 1)))
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest"))
    if bits <= NAME_BITS:
        at = wanted.select(name("wanted_id", "wanted_digest", bits).alias("at"))
        pages = at.groupBy(F.bitmap_bucket_number("at").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")).collect()  # of 4 KB each
        whole = bytearray(bits // 8)
        for page in pages:  # name p is bit (p - 1) % 32768 of page (p - 1) // 32768 + 1
            start = (page["page"] - 1) * 4096
            whole[start : start + 4096] = page["map"]
        sent = docs.sparkSession.sparkContext.broadcast(bytes(whole))
        rows = rows.select("text", F.bitmap_bucket_number(name("doc", "digest", bits)).alias("page"), F.bitmap_bit_position(name("doc", "digest", bits)).alias("at"))
    else:
        sent = None
        same = F.col("doc").eqNullSafe(F.col("wanted_id")) & (F.col("digest") == F.col("wanted_digest"))
        rows = rows.join(wanted, same, "left_semi").select("text", F.lit(0).alias("page"), F.lit(0).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        marks = None if sent is None else np.frombuffer(sent.value, dtype=np.uint8)
        for batch in batches:
            if marks is None:
                chosen = range(batch.num_rows)
            else:
                page, at = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
                chosen = np.flatnonzero((marks[(page - 1) * 4096 + at // 8] >> (at % 8)) & 1).tolist()
            found = [shingles(batch.column(0)[i].as_py()) for i in chosen]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(f) for f in found], pa.int64()), pa.array([f.astype("<u8").tobytes() for f in found], pa.binary())], names=["cls", "hashes"])

    return rows.mapInArrow(run, "cls long, hashes binary")


def _verified(docs: DataFrame, key: str, text: str, firsts: DataFrame, dealt: DataFrame) -> DataFrame:
    """(a, b): links found in tiles. ``dealt``: tile, hub, cls, side, known."""
    wanted = firsts.join(dealt.select("cls").distinct(), "cls", "left_semi").select(F.col("first.doc_id").alias("wanted_id"), F.col("first.digest").alias("wanted_digest"))
    sets = _sets(docs, key, text, wanted).dropDuplicates(["cls"])
    return dealt.join(sets, "cls").groupBy("tile").applyInPandas(_tile, "a long, b long")


def _cells(members: DataFrame, tile: int) -> DataFrame:
    """``members`` (hub, part, cls, n) with ``cell``: of like sizes, and of a bounded weight.

    Weights are summed for each size before they are accumulated, so a hub with a third of all classes is a row per size;
    a size too heavy for a cell is cut by a hash.
    """
    sizes = members.groupBy("hub", "part", "n").agg(F.sum(_weight("n")).alias("w"))
    below = F.sum("w").over(Window.partitionBy("hub", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("w")
    placed = sizes.withColumn("band", F.floor(below / tile)).withColumn("cuts", F.ceil(F.col("w") / tile))
    cut = F.when(F.col("cuts") > 1, F.concat_ws("/", "n", F.pmod(F.xxhash64("cls"), F.col("cuts")))).otherwise(F.lit(""))
    rows = members.join(placed.select("hub", "part", "n", "band", "cuts"), ["hub", "part", "n"])
    return rows.withColumn("cell", F.concat_ws(":", "part", "band", cut)).drop("band", "cuts")


def _weight(n: str) -> Column:
    """What a class takes of a tile: 1, or more where its set is long."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.col(n) / LONG_SET))


def _links(docs: DataFrame, key: str, text: str, firsts: DataFrame, stars: DataFrame, tile: int, made: list) -> DataFrame:
    """(a, b): links between classes that span all components. ``firsts``: cls, n, first (a row per class)."""
    counted = stars.groupBy("hub").agg(F.sum(_weight("n")).alias("weight"))
    light = counted.where(F.col("weight") <= tile)
    bins = max(1, math.ceil((light.agg(F.sum("weight")).first()[0] or 0) / tile))
    small = stars.join(light.select("hub"), "hub").select(F.concat_ws(":", F.lit("bin"), F.pmod(F.xxhash64("hub"), F.lit(bins))).alias("tile"), "hub", "cls", F.lit(0).alias("side"), F.col("cls").alias("known"))
    heavy = counted.where(F.col("weight") > tile).select("hub")
    if heavy.isEmpty():
        return stored(_verified(docs, key, text, firsts, small), made)
    # a large star is cut into cells, which are first searched alone; then pairs across cells that are not connected yet
    cells = stored(_cells(stars.join(heavy, "hub").withColumn("part", F.lit(0)), tile), made)
    alone = cells.select(F.concat_ws(":", "hub", "cell").alias("tile"), "hub", "cls", F.lit(0).alias("side"), F.col("cls").alias("known"))
    found = stored(_verified(docs, key, text, firsts, small.unionByName(alone)), made)
    known = components(found, "a", "b", made)
    labelled = cells.drop("part", "cell").join(known, F.col("cls") == F.col("node"), "left").select("hub", "cls", "n", F.coalesce("component", "cls").alias("known"))
    most = labelled.groupBy("hub", "known").agg(F.count("*").alias("members")).groupBy("hub").agg(F.max_by("known", F.struct("members", "known")).alias("main"), F.count("*").alias("parts"))
    open_ = labelled.join(most.where("parts > 1"), "hub").withColumn("part", F.when(F.col("known") == F.col("main"), 0).otherwise(1)).drop("main", "parts")
    if open_.isEmpty():
        return found
    # part 0: the largest component, whose members need not meet each other
    cells = stored(_cells(open_, tile), made)
    spans = cells.groupBy("hub", "part", "cell").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one, two = (spans.select("hub", *[F.col(c).alias(f"{c}_{s}") for c in ("part", "cell", "low", "high")]) for s in "ab")
    meet = one.join(two, "hub").where("cell_a <= cell_b and part_a + part_b > 0")
    meet = meet.where((NUMERATOR * F.col("low_b") <= DENOMINATOR * F.col("high_a")) & (NUMERATOR * F.col("low_a") <= DENOMINATOR * F.col("high_b")))
    name = F.concat_ws(":", "hub", "cell_a", "cell_b").alias("tile")
    sides = meet.select("hub", F.col("cell_a").alias("cell"), name, F.lit(0).alias("side")).unionByName(meet.where("cell_a < cell_b").select("hub", F.col("cell_b").alias("cell"), name, F.lit(1).alias("side")))
    across = cells.join(sides, ["hub", "cell"]).select("tile", "hub", "cls", "side", "known")
    return found.unionByName(stored(_verified(docs, key, text, firsts, across), made))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, digest (xxhash64 of the text), n_shingles, cls (class of equal sets), component: a row per document.

    ``component`` is the struct (doc_id, digest) of the component's first document, null for empty sets.
    """
    ready(docs.sparkSession)
    made: list = []
    sketch = stored(_sketch(docs, key, text), made)
    rows = sketch.where("n > 0")
    coded = F.when(F.col("codes").isNotNull(), F.col("ref"))
    firsts = rows.groupBy("cls").agg(F.first("n").alias("n"), _first(), F.min(coded).alias("ref"), F.count(coded).alias("tasks"))  # copies are combined before the shuffle
    firsts = stored(firsts, made)
    coded = sketch.where("codes is not null")
    again = stored(coded.select("cls", "ref").join(firsts.where("tasks > 1").select("cls", F.col("ref").alias("kept")), "cls").where("ref <> kept").select("ref"), made)
    often = sketch.where("often is not null").select(F.explode("often").alias("o")).select("o.*")
    prefixes = stored(_prefixes(coded.join(again, "ref", "left_anti").select("ref", "n", "codes"), often, made), made)
    stars = stored(_stars(prefixes).join(firsts.select("ref", "cls"), "ref").drop("ref"), made)
    groups = components(_links(docs, key, text, firsts, stars, tile, made), "a", "b", made)
    named = stored(firsts.join(groups, F.col("cls") == F.col("node"), "left").select("cls", F.coalesce("component", "cls").alias("group"), "first"), made)
    least = named.groupBy("group").agg(F.min_by("first", F.struct(F.col("first.doc_id").isNull(), "first")).alias("component"))
    place = named.join(least, "group").select(F.col("cls").alias("of"), "component")
    whole = sketch.where("n is not null").select("doc_id", "digest", "cls", "n").join(place, (F.col("cls") == F.col("of")) & (F.col("n") > 0), "left")
    out = stored(whole.select("doc_id", "digest", F.col("n").alias("n_shingles"), "cls", "component"))
    release(made)
    return out


def _first():
    """The first document of a group: least id, nulls last, then digest."""
    one = F.struct("doc_id", "digest")
    return F.min_by(one, F.struct(F.col("doc_id").isNull(), one)).alias("first")


def apply(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the first; documents without words all stay."""
    firsts = join(docs, key, text, **options).where("component is not null").select("component.*").distinct()
    digest, of, of_digest = fresh(docs, "text_digest", "kept_of", "kept_of_digest")
    firsts = firsts.select(F.col("doc_id").alias(of), F.col("digest").alias(of_digest))
    keyed = docs.withColumn(digest, F.xxhash64(F.col(text)))
    empty = F.coalesce(F.btrim(F.col(text), F.lit(BLANKS)) == "", F.lit(True))
    kept = keyed.where(~empty).join(firsts, F.col(key).eqNullSafe(F.col(of)) & (F.col(digest) == F.col(of_digest)), "left_semi")
    return kept.dropDuplicates([key, digest]).select(*docs.columns).unionByName(docs.where(empty))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id: a row per document."""
    found = join(docs.select("doc_id", "text"), **options)
    return found.select("doc_id", "n_shingles", F.coalesce("component.doc_id", "doc_id").alias("component_id"))


def oracle() -> str:
    """DuckDB SQL for ``report``: counts of common shingles by a self join, then reachability."""
    return """
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [w] else list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) end) g from d),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
r as (select doc_id, doc_id via from d union select r.doc_id, l.b from r join l on l.a = r.via)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, c component_id from d left join n using (doc_id) join (select doc_id, min(via) c from r group by 1) using (doc_id)"""
