"""Best-fit packing with certified bin counts.

Documents become token ids and an end id; longer ones are cut into pieces of the full capacity, the first piece taking
what is over. Pieces (numbers only, not ids) are dealt to partitions of bounded size and packed there by best-fit
decreasing. Dual feasible functions bound each partition's bin count from below. Where the bound is met, the partition
is certified and only its emptiest bin is opened again; where there is a gap, all bins that are not full are. Opened
pieces are exchanged between partitions (dealt again, into fewer) and packed again, until they fit one partition. Where a
round closes hardly any bin, the next opens only each partition's emptiest bins, one more than its gap. After ``MOST_ROUNDS``
rounds what is open is packed as it lies: no piece is lost, and ``certificate`` tells what that cost.

Token ids are those of ``tokenizers`` for the vocabulary file; for a plain byte-level one ``tiktoken`` computes the same ids
faster, and tests compare them.

Defined cases: null text is empty and gives one piece, the end id alone; repeated rows are packed as separate documents;
an empty table gives no rows; null ids are carried along; texts of any length are cut, none is dropped; other columns,
whatever their names, are not read. Ties are broken by length, then id, piece and digest.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stored

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
PARTITION_PIECES = 20_000
#: A round that leaves more than this share of the pieces open is followed by one that opens only the emptiest bins.
STALLED = 0.9
MOST_ROUNDS = 12


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies spell bytes: printable ones stand for themselves, the rest follow 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function text -> ids that gives what ``tokenizers`` gives for the vocabulary file at ``path``.

    If the file is byte-level BPE whose ids are its merge order, the faster ``tiktoken`` runs it; texts that hold a
    special token's string go to ``tokenizers`` itself.
    """
    from tokenizers import Tokenizer

    own: list = []  # loaded when it is first needed: few workers meet such a text

    def plain(text: str) -> list[int]:
        if not own:
            own.append(Tokenizer.from_file(path))
        return own[0].encode(text, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec.get("added_tokens", [])]
    vocab, letters = spec["model"]["vocab"], _byte_letters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"].get("merges", [])]
    first = len(vocab) - len(merges) - len([s for s in special if s in vocab])
    if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
        return plain
    if any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(merges)):
        return plain
    import tiktoken

    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> list[int]:
        if any(s in text for s in special):
            return plain(text)
        try:
            return fast.encode_ordinary(text)
        except Exception:  # its regex engine gives up on some very long runs
            return plain(text)

    return ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids, if asked for): a row per piece."""
    ready(docs.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*ids_of(whole.as_py() or ""), end_id], dtype="<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    for column, value in zip(rows, (doc, i, start, length, zlib.crc32(part.tobytes()), part.astype("int32") if with_ids else None), strict=False):
                        column.append(value)
            kinds = [batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=False)][: len(names)], names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(run, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Least number of bins for ``counts[x]`` items of length x, by dual feasible functions.

    Two families: f_t(x) = capacity if x > capacity - t, x if x >= t, else 0; and u_k(x) = x if (k + 1) x / capacity is whole,
    else floor((k + 1) x / capacity) capacity / k.
    """
    x = np.arange(len(counts), dtype=np.int64)
    total = x * counts
    best = math.ceil(total.sum() / capacity)
    tail, large = np.cumsum(total[::-1])[::-1], np.cumsum(counts[::-1])[::-1]
    for t in range(1, capacity // 2 + 1):
        above = large[capacity - t + 1] if capacity - t + 1 < len(counts) else 0
        middle = tail[t] - (tail[capacity - t + 1] if capacity - t + 1 < len(counts) else 0)
        best = max(best, int(above) + math.ceil(middle / capacity))
    for k in range(1, 101):
        whole, over = (k + 1) * x // capacity, (k + 1) * x % capacity
        scaled = np.where(over == 0, k * x, whole * capacity)  # k times u_k
        best = max(best, -int(-(scaled * counts).sum() // (k * capacity)))
    return int(best)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item (given longest first), and the fill of each bin."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins, offsets, fill = 0, [], [], []
    for x in lengths.tolist():
        fits = open_rooms >> x
        if fits:
            left = x + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            b, left = len(fill), capacity
            fill.append(0)
        bins.append(b)
        offsets.append(fill[b])
        fill[b] += x
        if left > x:
            room[left - x].append(b)
            open_rooms |= 1 << (left - x)
    return np.array(bins, dtype=np.int64), np.array(offsets, dtype=np.int64), np.array(fill, dtype=np.int64)


def pack_partition(items: pd.DataFrame, capacity: int, few: bool = False) -> pd.DataFrame:
    """``items`` with bin, offset, and settled: False for pieces that should be exchanged (with ``few``, of the emptiest bins only)."""
    items = items.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
    lengths = items["length"].to_numpy()
    bins, offsets, fill = best_fit(lengths, capacity)
    bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    closed = fill == capacity
    if len(fill) == bound:  # certified: no packing of these pieces has fewer bins
        emptiest = int(fill.argmin())
        closed = np.arange(len(fill)) != emptiest if not closed[emptiest] else closed
    elif few:
        closed = np.ones(len(fill), dtype=bool)
        closed[np.argsort(fill, kind="stable")[: len(fill) - bound + 1]] = False
    return items.assign(bin=bins, offset=offsets, settled=closed[bins])


def pack(rows: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``rows`` (as of ``pieces``, stored, read once a round) with sequence_id and offset."""
    ready(rows.sparkSession)
    kept, left, before = [], rows, None
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    for r in range(MOST_ROUNDS):
        n = left.count()
        parts = max(1, math.ceil(n / partition_pieces))
        last = parts == 1 or r == MOST_ROUNDS - 1
        few = before is not None and n > STALLED * before
        before = n
        mixed = F.xxhash64("doc_id", "piece", "ids_crc32", "length", F.lit(r))
        dealt = left.withColumn("part", F.pmod(mixed, F.lit(parts)).cast("long"))
        run = (lambda few: lambda items: pack_partition(items, capacity, few))(few)
        packed = stored(dealt.groupBy("part").applyInPandas(run, ", ".join([*fields, "part long, bin long, offset long, settled boolean"])))
        number = F.lit(r << 56) + F.col("part") * (1 << 24) + F.col("bin")
        done = packed if last else packed.where("settled")
        kept.append(done.select(*rows.columns, number.alias("sequence_id"), "offset"))
        if last:
            break
        left = packed.where("not settled").select(*rows.columns)
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> dict[str, int]:
    """Sequences used and the lower bound for any packing; a count per length is all that is gathered."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in packed.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    return {"sequences": packed.select("sequence_id").distinct().count(), "lower_bound": lower_bound(counts, capacity)}


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids: the packed sequences themselves, from pieces that carry their ids."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))


def report(docs: DataFrame, **options) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    capacity = options.pop("capacity", CAPACITY)
    partition_pieces = options.pop("partition_pieces", PARTITION_PIECES)
    return pack(stored(pieces(docs, capacity=capacity, **options)), capacity, partition_pieces)
