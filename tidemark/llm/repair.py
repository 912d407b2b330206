"""Damaged conversations repaired at the least cost: a run-length dynamic program over min-plus transitions.

A repaired conversation's roles read ``(s?(ua)+)?`` by their initials: four states, 0 nothing yet, 1 after the system turn, 2 after a user's,
3 after an assistant's. What a turn allows is told by a symbol, its initial and its fault; the cheapest way over a turn from each
state to each other, insertions before it included, is a 4 x 4 matrix, and ways over several turns are min-plus products.

1. Equal turns are counted, not copied; turns are sorted and dealt to tasks by ranges, so that a frequent conversation is many segments. A segment
   collapses consecutive equal symbols to runs and multiplies the binary powers of their matrices, which are kept for each symbol.
2. From the last segment of each conversation to the first, these products give the cost of all that follows a segment, by state.
3. Each segment then unrolls its choices, the least letter among the cheapest, from the states in which it may be entered;
   a pass over the segments of a conversation picks the entered one, joins the audit and hashes the repaired text as it goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .chatformat import in_order
from .common import frugal, stage

#: Costs of the edits.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Characters that are blank, and those that end a text.
BLANK, ENDS = " \t\n\x0b\x0c\r", ".!?"
_NEVER = 1 << 40
#: The state after a user or assistant turn put at the end, by state.
_NEXT = (2, 2, 3, 2)
#: What it costs to end, by state.
_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
#: Turns of a segment (a power of two), and bytes of text.
_SEGMENT_BITS, _SEGMENT_BYTES = 12, 4 << 20


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product; ``b`` is a matrix or a vector."""
    if b.ndim == 1:
        return np.minimum((a + b).min(axis=1), _NEVER)
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), _NEVER)


def options(symbol: str) -> list[tuple[str, int, tuple[int | None, ...]]]:
    """Letter, cost and state reached from each state of every edit at a turn, by letter; all but I use the turn up.

    A symbol is the role's initial and the fault's: ``b`` blank, ``d`` duplicate, ``t`` truncated, ``-`` none.
    """
    initial, fault = symbol
    edits: list = [("D", DELETE, (0, 1, 2, 3)), ("I", INSERT, _NEXT)]
    if fault not in "bd":
        extra = CUT_OFF if fault == "t" else 0
        kept = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}.get(initial)
        if kept:
            edits.append(("K", extra, kept))
        edits.append(("R", REROLE + extra, _NEXT))
    return edits


@cache
def _power(symbol: str, k: int) -> np.ndarray:
    """The transition over 2^k turns of a symbol."""
    if k:
        return _times(_power(symbol, k - 1), _power(symbol, k - 1))
    insert = np.where(np.eye(4, dtype=bool), 0, _NEVER)
    for state in range(4):
        insert[state, _NEXT[state]] = min(insert[state, _NEXT[state]], INSERT)
    insert = _times(insert, insert)
    edit = np.full((4, 4), _NEVER, np.int64)
    for letter, cost, reached in options(symbol):
        for state, to in enumerate(reached):
            if letter != "I" and to is not None:
                edit[state, to] = min(edit[state, to], cost)
    return _times(insert, edit)


def _advance(symbol: str, n: int, after: np.ndarray) -> np.ndarray:
    """``after`` with ``n`` turns of a symbol before it."""
    k = 0
    while n:
        if n & 1:
            after = _times(_power(symbol, k), after)
        n, k = n >> 1, k + 1
    return after


def runs(symbols: list[str], counts: list[int]) -> list[tuple[str, int]]:
    """Consecutive equal symbols collapsed. A turn that is there more than once is followed by its duplicates."""
    found: list[tuple[str, int]] = []
    for symbol, n in zip(symbols, counts):
        copy = symbol if symbol[-1] in "bd" else symbol[:-1] + "d"
        for s, times in ((symbol, 1), (copy, n - 1)):
            if times and found and found[-1][0] == s:
                found[-1] = s, found[-1][1] + times
            elif times:
                found.append((s, times))
    return found


def transition(collapsed: list[tuple[str, int]]) -> np.ndarray:
    """The matrix over a whole segment."""
    total = np.where(np.eye(4, dtype=bool), 0, _NEVER)
    for symbol, n in reversed(collapsed):
        total = _advance(symbol, n, total)
    return total


def unroll(collapsed: list[tuple[str, int]], state: int, after: np.ndarray, last: bool) -> tuple[str, int]:
    """The least of the cheapest audits of a segment entered in ``state``, and the state it ends in.

    ``after`` is the cost of what follows by state; ``last`` says that nothing follows, so that insertions complete the conversation.
    """
    behind = [after]
    for symbol, n in reversed(collapsed):
        behind.append(_advance(symbol, n, behind[-1]))
    audit: list[str] = []
    for (symbol, n), bound in zip(collapsed, behind[-2::-1]):
        costs, edits = [bound.tolist()], options(symbol)
        for _ in range(n):
            bound = _times(_power(symbol, 0), bound)
            costs.append(bound.tolist())
        while n:
            for letter, cost, reached in edits:
                to, left = reached[state], n if letter == "I" else n - 1
                if to is not None and cost + costs[left][to] == costs[n][state]:
                    break
            audit.append(letter)
            state, n = to, left
    while last and state in (1, 2):
        audit.append("I")
        state = _NEXT[state]
    return "".join(audit), state


def repaired(audit: str, roles: list[str], texts: list[str], state: int) -> list[tuple[str, str, str]]:
    """Edit, role and text of each step of an audit; a deleted turn keeps its own."""
    found, at = [], 0
    for letter in audit:
        if letter == "I":
            role, text = ("assistant" if state == 2 else "user"), ""
        else:
            role, text = roles[at], texts[at]
            at += 1
            if letter == "R":
                role = "assistant" if state == 2 else "user"
        if letter != "D":
            state = 1 if letter == "K" and role[:1] == "s" else _NEXT[state]
        found.append((letter, role, text))
    return found


_CODES = {"b": 0, "d": 1, "t": 2}


def _segments(rows: DataFrame) -> DataFrame:
    """``conv, segment`` with its turns, their symbols in runs, its transition and counts; segments are numbered in order."""
    kind = rows.schema["conv"].dataType
    names = ["conv", "segment", "roles", "texts", "counts", "symbols", "lengths", "matrix", "first", "last", "faults", "illegal"]
    types = [to_arrow_type(kind), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string()),
             pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64()]

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[list] = []
        conv, size, done = None, 0, []

        def close() -> None:
            nonlocal held, size, number
            roles, texts, counts, faults = (list(c) for c in zip(*held))
            symbols = [(r[:1] if r[:1] in ("s", "u", "a") else "?") + f for r, f in zip(roles, faults)]
            collapsed = runs(symbols, counts)
            total = [0, 0, 0]
            illegal = 0
            for i, (symbol, n) in enumerate(collapsed):
                if symbol[1] in _CODES:
                    total[_CODES[symbol[1]]] += n
                illegal += n - 1 + (i > 0 and collapsed[i - 1][0][0] + symbol[0] not in ("su", "ua", "au"))
            done.append([conv, number, roles, texts, counts, [s for s, _ in collapsed], [n for _, n in collapsed],
                         transition(collapsed).ravel().tolist(), symbols[0][0], symbols[-1][0], total, illegal])
            held, size, number = [], 0, number + 1

        def batch_of(some: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*some), types)], names)

        for batch in batches:
            for c, role, text, n, fault in zip(*(x.to_pylist() for x in batch.columns)):
                if held and (c != conv or len(held) >> _SEGMENT_BITS or size >= _SEGMENT_BYTES):
                    close()
                    if len(done) >= 256 or sum(len(d[2]) for d in done[-4:]) >= 1 << _SEGMENT_BITS:
                        yield batch_of(done)
                        done.clear()
                conv, size = c, size + len(text)
                held.append([role, text, n, fault])
        if held:
            close()
        if done:
            yield batch_of(done)

    schema = (f"conv {kind.simpleString()}, segment bigint, roles array<string>, texts array<string>, counts array<bigint>, symbols array<string>, "
              "lengths array<bigint>, matrix array<bigint>, first string, last string, faults array<bigint>, illegal bigint")
    return in_order(rows).select("conv", "role", "text", "n", "fault").mapInArrow(cut, schema)


def _bounds(segments: DataFrame) -> DataFrame:
    """``segment, opens, closes, after, edge``: a segment's place, the cost of all that follows it, an illegal pair at its end.

    A task goes through the segments of a conversation from the last to the first and holds one at a time.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, conv, after, follows = None, None, _END, None
        for batch in batches:
            found = []
            for c, segment, matrix, first, last in zip(*(x.to_pylist() for x in batch.columns)):
                same = waiting is not None and c == conv
                if waiting is not None:
                    found.append([*waiting[:1], not same, *waiting[1:]])
                if not same:
                    after, follows = _END, None
                edge = int(follows is not None and last + follows not in ("su", "ua", "au"))
                waiting = [segment, follows is None, after.tolist(), edge]
                conv, after, follows = c, _times(np.array(matrix).reshape(4, 4), after), first
            if found:
                yield batch_of(found)
        if waiting is not None:
            yield batch_of([[*waiting[:1], True, *waiting[1:]]])

    def batch_of(some: list) -> pa.RecordBatch:
        types = [pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int64()), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*some), types)], ["segment", "opens", "closes", "after", "edge"])

    narrow = segments.select("conv", "segment", "matrix", "first", "last")
    ordered = narrow.repartition("conv").sortWithinPartitions("conv", F.desc("segment"))
    return ordered.mapInArrow(walk, "segment bigint, opens boolean, closes boolean, after array<bigint>, edge bigint")


_TURNS = "array<struct<edit:string,role:string,text:string>>"


def _pieces(segments: DataFrame, bounds: DataFrame) -> DataFrame:
    """A row for each segment and state it may be entered in: the state it ends in, the audit and the turns."""
    kind = segments.schema["conv"].dataType
    turn = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
    types = [to_arrow_type(kind), pa.int64(), pa.int32(), pa.int32(), pa.string(), turn, pa.int64(), pa.list_(pa.int64()), pa.int64()]
    names = ["conv", "segment", "state", "reached", "audit", "turns", "cost", "faults", "illegal"]

    @frugal
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                collapsed, after = list(zip(row["symbols"], row["lengths"])), np.array(row["after"])
                cost = _times(np.array(row["matrix"]).reshape(4, 4), after)
                roles = [x for x, n in zip(row["roles"], row["counts"]) for _ in range(n)]
                texts = [x for x, n in zip(row["texts"], row["counts"]) for _ in range(n)]
                for state in (0,) if row["opens"] else range(4):
                    audit, reached = unroll(collapsed, state, after, row["closes"])
                    steps = [dict(zip(("edit", "role", "text"), t)) for t in repaired(audit, roles, texts, state)]
                    found.append([row["conv"], row["segment"], state, reached, audit, steps, int(cost[state]), row["faults"], row["illegal"] + row["edge"]])
                    held += len(steps)
                if held >= 1 << _SEGMENT_BITS:
                    yield batch_of(found)
                    found, held = [], 0
            if found:
                yield batch_of(found)

    def batch_of(some: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*some), types)], names)

    schema = (f"conv {kind.simpleString()}, segment bigint, state int, reached int, audit string, turns {_TURNS}, cost bigint, "
              "faults array<bigint>, illegal bigint")
    return segments.join(bounds, "segment").mapInArrow(choose, schema)


def _entered(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """The rows of each segment's entered state, in order: whether it opens a conversation, the conversation, and columns."""
    conv, state, begun = None, 0, False
    for batch in batches:
        heads = zip(*(batch.column(c).to_pylist() for c in ("conv", "state", "reached")))
        for i, (c, entered, reached) in enumerate(heads):
            opens = not begun or c != conv
            if opens:
                conv, state, begun = c, 0, True
                segment = None
            here = batch.column("segment")[i].as_py()
            if here != segment and entered == state:
                segment, state = here, reached
                yield opens, c, *(batch.column(name)[i].as_py() for name in columns)


@dataclass
class Repair:
    """``turns``: ``conv_col, segment, turns`` with the edit, role and text of every step, deleted turns too; ``summary``: a row a conversation."""

    turns: DataFrame
    summary: DataFrame


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> Repair:
    """The cheapest repair of each conversation; of equally cheap ones that with the least audit.

    Turns are ordered by ``turn_col`` (NULL first), then role and text; equal rows follow each other. NULL roles and texts are empty. Rows without
    a conversation are one conversation. ``summary`` has ``gaps`` (turn numbers missing between the least and the largest), ``blank, duplicate, truncated``
    (turns by their first fault), ``illegal`` (adjacent roles out of turn), ``cost``, ``audit`` (a letter a step: Delete, Insert, Keep,
    Rerole) and ``repaired_sha256``. A table without rows has no conversations. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text"))
    counted = stage(rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", F.unhex(F.sha2("text", 256))), "repair-turns")
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    again = counted.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")).filter("places > 1")
    again = again.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    met = counted.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    said = F.rtrim("text", F.lit(BLANK))
    fault = F.when(said == "", "b").when(place > F.col("first"), "d").when(~F.right(said, F.lit(1)).isin(*ENDS), "t").otherwise("-")
    segments = stage(_segments(met.select("conv", "turn", "role", "text", "n", fault.alias("fault"))), "repair-segments")
    pieces = _pieces(segments, _bounds(segments))
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "segment", "state")
    kind = pieces.schema["conv"].dataType
    id_type, turn_type = to_arrow_type(kind), pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))

    @frugal
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, conv, segment, turns in _entered(batches, ("segment", "turns")):
            yield pa.RecordBatch.from_arrays([pa.array([conv], id_type), pa.array([segment], pa.int64()), pa.array([turns], turn_type)], [conv_col, "segment", "turns"])

    types = [id_type, *[pa.int64()] * 5, pa.string(), pa.string()]
    names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    @frugal
    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, open_ = [], None

        def close() -> None:
            conv, counts, audit, digest = open_
            done.append([conv, *counts, "".join(audit), digest.hexdigest()])

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names)

        for opens, conv, audit, turns, cost, faults, illegal in _entered(batches, ("audit", "turns", "cost", "faults", "illegal")):
            if opens:
                if open_:
                    close()
                if len(done) >= 1024:
                    yield batch_of()
                    done.clear()
                open_, first = [conv, [0, 0, 0, 0, cost], [], hashlib.sha256()], True
            counts = open_[1]
            counts[:4] = [a + b for a, b in zip(counts, [*faults, illegal])]
            open_[2].append(audit)
            for t in turns:
                if t["edit"] != "D":
                    open_[3].update((("" if first else "\n") + t["role"] + ":" + t["text"]).encode())
                    first = False
        if open_:
            close()
        if done:
            yield batch_of()

    found = ordered.mapInArrow(sum_up, f"conv {kind.simpleString()}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
    wide = lambda c: c.cast("decimal(20,0)")
    spans = counted.groupBy(F.col("conv").alias("c")).agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("places"))
    gaps = F.coalesce((wide(F.col("high")) - wide(F.col("low")) + 1 - F.col("places")).cast("bigint"), F.lit(0).cast("bigint")).alias("gaps")
    summary = spans.select("c", gaps).join(found, F.col("c").eqNullSafe(F.col("conv"))).select(F.col("conv").alias(conv_col), "gaps", *names[1:])
    return Repair(ordered.mapInArrow(give, f"`{conv_col}` {kind.simpleString()}, segment bigint, turns {_TURNS}"), summary)


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The four columns with faults put in by a hash of conversation and turn; NULL roles and texts are one space.

    Of twenty hash values, 0 drops a row, 1 empties its text, 2 takes ``.!?`` out, 3 repeats the row, 4 makes it a user's.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in (role_col, text_col))
    hit = conversations.select(conv_col, turn_col, role.alias("__role"), text.alias("__text"), (F.crc32(key) % 20).alias("__hit"))
    h = F.col("__hit")
    kept = hit.filter(h != 0).withColumn("__copy", F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return kept.select(
        conv_col, turn_col, F.when(h == 4, "user").otherwise(F.col("__role")).alias(role_col),
        F.when(h == 1, "").when(h == 2, F.translate("__text", ENDS, "")).otherwise(F.col("__text")).alias(text_col))
