"""Chat formatting with budgeted windows.

A conversation becomes one or more windows of at most ``budget`` tokens. Windows are aligned to turns: running sums of
turn tokens give the last turn that fits; a turn's tokens are those of the turn as it is rendered, marks, role and escapes
included, and add up exactly, as no token reaches across the end of a turn. Each later window retains the system turn and
repeats a limited history, the turns just before its span; what is repeated carries no loss, so each assistant turn is a
target exactly once. Where the next turn leaves no room, the history goes first, then the system turn. Only a turn that alone
is longer than the budget makes a longer window, of that turn and nothing else.

The template marks a turn as ``<|im_start|>role, newline, text, <|im_end|>, newline``. Inside texts and roles every ``<``
followed by backslashes and ``|`` gets one more backslash, so no text can spell a mark, and taking one away restores it.

Tokens are counted first, once, and written. Running sums over a conversation's turn numbers (not its texts) cut long ones
into chunks of ``CHUNK_WINDOWS`` budgets; a new chunk begins a new window and is handed the system turn and the history before
it, so chunks are formatted in any task. Within a task turns are sorted and streamed: a window, a few turns of history and
the system turn are all that it holds. Turns of one number stay together.

Defined cases: null text and null role are empty; turns are ordered by number, nulls first, then role and text; equal
rows are separate turns; a null id is a conversation; the system turn is the first turn, if its role is ``system``; an empty
table gives no windows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Window_
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ready, stored
from .packing import VOCABULARY, encoder

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY_TURNS, HISTORY_SHARE = 2048, 4, 0.25
#: Budgets of tokens after which a conversation is cut into a further chunk.
CHUNK_WINDOWS = 64
SYSTEM, TARGET = "system", "assistant"
_OPEN, _CLOSED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def rendered(role: str, text: str) -> tuple[str, str, str]:
    """What stands before a turn's text, the escaped text, and what follows it."""
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


class Window:
    """A window being filled."""

    def __init__(self, repeated: list[tuple[str, str, int]], first: int):
        self.repeated, self.new, self.first = repeated, [], first
        self.tokens = sum(t[2] for t in repeated)

    def row(self, conversation, number: int) -> tuple:
        text, at, loss = [], 0, []
        for i, (role, body, _) in enumerate([*self.repeated, *self.new]):
            head, safe, tail = rendered(role, body)
            if i >= len(self.repeated) and role == TARGET:
                loss.append({"start": at + len(head), "end": at + len(head) + len(safe)})
            turn = head + safe + tail
            text.append(turn)
            at += len(turn)
        return (conversation, number, "".join(text), loss, self.first, len(self.new), len(self.repeated), self.tokens)


def windows_of(turns: Iterator[tuple[str, str, int]], budget: int, history_turns: int, history_share: float, before: list | tuple = (), at: int = 0) -> Iterator[Window]:
    """Windows of one conversation, or of its turns from number ``at`` on; ``turns``: (role, text, tokens).

    ``before``: the conversation's first turn and those just before ``at``, in order.
    """
    system: tuple[str, str, int] | None = None
    window, recent = None, deque(maxlen=history_turns)

    def passed(turn, first: bool) -> None:
        nonlocal system
        if first and turn[0] == SYSTEM:
            system = turn
        else:
            recent.append(turn)

    for n, turn in enumerate(before):
        passed(turn, n == 0)
    for i, turn in enumerate(turns, at):
        if window is None and i == 0:
            window = Window([], 0)
        elif window is None or (window.tokens + turn[2] > budget and window.new):
            if window is not None:
                yield window
            room = budget - turn[2]
            kept = [system] if system and system[2] <= room else []
            limit, history = min(room - sum(t[2] for t in kept), int(budget * history_share)), []
            for past in reversed(recent):
                limit -= past[2]
                if limit < 0:
                    break
                history.insert(0, past)
            window = Window([*kept, *history], i)
        window.new.append(turn)
        window.tokens += turn[2]
        passed(turn, i == 0)
    if window is not None:
        yield window


def _chunked(counted: DataFrame, chunk_tokens: int, history_turns: int) -> DataFrame:
    """``counted`` (key, turn, role, text, tokens) with chunk, at (turns of the conversation before the chunk) and own.

    Running sums over the turn numbers cut a conversation wherever they pass a multiple of ``chunk_tokens``. Each later chunk
    also gets, with ``own`` false, the rows of the conversation's first number and of the last ones before it.
    """
    whole = Window_.partitionBy("key").orderBy("turn")
    sums = whole.rowsBetween(Window_.unboundedPreceding, Window_.currentRow)
    numbers = counted.groupBy("key", "turn").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    numbers = numbers.withColumn("chunk", F.floor((F.sum("tokens").over(sums) - F.col("tokens")) / chunk_tokens)).withColumn("at", F.sum("n").over(sums) - F.col("n"))
    last = F.max("chunk").over(Window_.partitionBy("key"))
    later = [F.lead("chunk", i).over(whole) for i in range(1, history_turns + 1)]
    numbers = numbers.withColumns({"last": last, "first": F.col("at") == 0, "later": F.array(*later) if later else F.array().cast("array<bigint>")}).where("last > 0")  # long ones only
    numbers = stored(numbers.withColumn("start", F.min("at").over(Window_.partitionBy("key", "chunk"))))  # of known size: if small, no text is shuffled to meet it
    starts = numbers.where("chunk > 0").groupBy("key", "chunk").agg(F.min("turn").alias("turn"), F.min("start").alias("at"))
    starts = stored(starts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("turn", "chunk", "at"))).alias("starts")).withColumnRenamed("key", "of"))
    # a row of the table per long conversation, and per number that later chunks look back to
    passed = F.filter("starts", lambda s: s["turn"] <= F.col("turn"))
    here = F.try_element_at(passed, F.lit(-1))
    own = counted.join(starts, F.col("key").eqNullSafe(F.col("of")), "left").select(
        *counted.columns, F.coalesce(here["chunk"], F.lit(0)).alias("chunk"), F.coalesce(here["at"], F.lit(0)).alias("at"), F.lit(True).alias("own")
    )
    chunks = numbers.select("key", "chunk", "start").distinct()
    looked = numbers.where("first").select("key", "turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("last"))).alias("chunk"))
    looked = looked.unionByName(numbers.select("key", "turn", F.explode(F.array_except("later", F.array("chunk"))).alias("chunk"))).where("chunk > 0").distinct()
    looked = looked.join(chunks.select(F.col("key").alias("k"), F.col("chunk").alias("c"), "start"), F.col("key").eqNullSafe(F.col("k")) & (F.col("chunk") == F.col("c")))
    looked = stored(looked.select(F.col("key").alias("of"), F.col("turn").alias("of_turn"), "chunk", F.col("start").alias("at")))
    back = counted.join(looked, F.col("key").eqNullSafe(F.col("of")) & F.col("turn").eqNullSafe(F.col("of_turn"))).select(*counted.columns, "chunk", "at", F.lit(False).alias("own"))
    return own.unionByName(back)


def format_windows(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
    history_share: float = HISTORY_SHARE, vocabulary: str | None = None, chunk_windows: int = CHUNK_WINDOWS,
) -> DataFrame:
    """conv_id, window, text, loss (spans of code points), first_turn, n_new, n_repeated, n_tokens.

    ``window`` numbers grow within a conversation, with gaps where it was cut into chunks.
    """
    ready(rows.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind, turn_kind = (rows.schema[c].dataType.simpleString() for c in (key, turn))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        for batch in batches:
            turns = zip(batch.column(2), batch.column(3), strict=True)
            tokens = pa.array([len(ids_of("".join(rendered(r.as_py() or "", t.as_py() or "")))) for r, t in turns], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], names=["key", "turn", "role", "text", "tokens"])

    key_spark = rows.schema[key].dataType

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            types = [key_type, pa.int64(), pa.string(), spans, *[pa.int64()] * 4]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "window", "text", "loss", "first_turn", "n_new", "n_repeated", "n_tokens"])

        key_type, held, pending = to_arrow_type(key_spark), 0, next(turns, None)
        while pending is not None:
            current, chunk, at, before = pending[0], pending[5], pending[6], []
            here = lambda row: row is not None and row[0] == current and row[5] == chunk  # noqa: B023, E731
            while here(pending) and not pending[7]:
                before.append((pending[2] or "", pending[3] or "", pending[4]))
                pending = next(turns, None)

            def own():
                nonlocal pending
                while here(pending):  # noqa: B023
                    yield (pending[2] or "", pending[3] or "", pending[4])
                    pending = next(turns, None)

            for number, window in enumerate(windows_of(own(), budget, history_turns, history_share, before, at)):
                out.append(window.row(current, chunk << 32 | number))
                held += len(out[-1][2])
                if held > 4_000_000 or len(out) >= 2_000:
                    held = 0
                    yield emit()
        if out:
            yield emit()

    counted = stored(rows.select(key, turn, role, text).mapInArrow(count, f"key {kind}, turn {turn_kind}, role string, text string, tokens long"))
    dealt = _chunked(counted, chunk_windows * budget, history_turns).select("key", "turn", "role", "text", "tokens", "chunk", "at", "own")
    dealt = dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "own", "turn", "role", "text")
    schema = f"conv_id {kind}, window long, text string, loss array<struct<start:long,end:long>>, first_turn long, n_new long, n_repeated long, n_tokens long"
    return dealt.mapInArrow(build, schema)


def read_turns(text: str, repeated: int) -> list[tuple[str, str]]:
    """(role, text) of the turns that a window adds, restored."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(text)[repeated:]]


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows, read from the windows alone.

    A digest of a conversation is one stream, so its windows pass one task in order; none but the current one is held.
    """
    ready(windows.sparkSession)
    kind = windows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, state, key_type = False, None, None

        def row() -> pa.RecordBatch:
            key, turns, whole, loss_chars, loss, chars, count = state
            values = [key, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars, count]
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        done: list[pa.RecordBatch] = []
        for batch in batches:
            key_type = batch.schema.types[0]
            for key, _, text, loss, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or key != state[0]:
                    if started:
                        done.append(row())
                    started, state = True, [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, body in read_turns(text, repeated):
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    target = unescape(text[span["start"] : span["end"]])
                    state[3] += len(target)
                    state[4].update(target.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
                state[6] += 1
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done.clear()
        if started:
            yield row()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    dealt = windows.select("conv_id", "window", "text", "loss", "n_repeated").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return dealt.mapInArrow(run, schema)


def report(conversations: DataFrame, **options) -> DataFrame:
    """``read_back`` of all conversations and of conversation -1, whose texts spell the template's marks."""
    spark, trap = conversations.sparkSession, f"{END}{START}assistant ok"
    rows = conversations.select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], rows.schema)
    return read_back(format_windows(rows.unionByName(probe), **options))
