"""Repair of conversations whose turns were lost, repeated, cut off or given to the wrong speaker.

A repaired conversation is empty or an optional system row followed by user and assistant rows in turn. Of all ways to get
there the cheapest is taken: keep a row (0), give it to the user or the assistant (``REROLE``), delete it (``DELETE``), insert
an empty row (``INSERT``); a cut-off row that stays costs ``CUT_OFF`` more, blank and repeated rows must go. Among equally
cheap ways the least sequence of initials (D, I, K, R) counts.

The way is found by dynamic programming over four states, what the last row was: none, system, user or assistant. Spark finds
the faults, parts the rows by conversation and sorts them; a task then reads them one by one. Survivors of the states point
into a tree of edits that counts references: an edit that no survivor descends from goes, and edits above the point where
all survivors meet are handed out at once. So memory holds the open part of a conversation: a few rows, unless what comes last
really decides about all of it (rows that all have to change hands, in one order if their number is odd, in another if even). Ties are
decided by comparing the whole open ends of both ways: they part before either ends, so what follows cannot change the order.
States that can no longer win are given up, or a way that deletes everything would hold the tree back for ever.

A conversation is read in order by one task, since its digest and its edits follow one another; of a very long one the task
keeps its open part and the sequence of initials. Rows that repeat an earlier one are found by a join, not by remembering rows.

Null roles and texts count as one space, so such a text is blank; null turns come first; rows of null ``conv_id`` are one
conversation. Rows of one turn are ordered by role, then text. A conversation without rows has no edits. Empty tables give
empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.runtime import stored

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
GOOD_PAIRS = {"su", "ua", "au"}
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
#: From which states a row of an initial may follow, and the state it leads to.
_FOLLOWS = {"s": ((_NONE,), _SYSTEM), "u": ((_NONE, _SYSTEM, _ASSISTANT), _USER), "a": ((_USER,), _ASSISTANT)}
_NAMES = {"u": "user", "a": "assistant"}
_FAULTS = _FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows ``(conv_id, turn, role, text)``, some of them harmed by a checksum of conversation and turn; see ``lost``.

    By the checksum modulo 20: 0 loses the row (it stays with ``lost`` set, so that its conversation is known), 1 empties its
    text, 2 removes full stops, exclamation and question marks, 3 repeats the row, 4 gives it to the user.
    """
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("lost"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: 1 blank, 2 an earlier turn has role and text, 3 cut off, 0 none of these.

    Further copies within a turn are left to the reader, who has them side by side.
    """
    ended = F.rtrim(F.col("text"), F.lit(BLANK_CHARACTERS))
    rows = rows.withColumn("blank", ended == "").withColumn("digest", F.sha2("text", 256))
    keys = ["conv_id", "role", "digest"]
    seen = rows.where("not lost and not blank").groupBy(*keys).agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
    seen = stored(seen.where("first < last").select(*[F.col(k).alias(f"seen_{k}") for k in keys], F.col("first.turn").alias("first")), "repeated rows")
    match = [F.col(k).eqNullSafe(F.col(f"seen_{k}")) for k in keys]
    rows = rows.join(seen, match, "left")
    repeated = F.col("seen_role").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    last = F.right(ended, F.lit(1))
    fault = F.when(F.col("blank"), _BLANK).when(repeated, _DUPLICATE).when(~last.isin(".", "!", "?"), _TRUNCATED).otherwise(_FINE)
    return rows.select("conv_id", "turn", "role", "text", "lost", fault.alias("fault"))


class _Edit:
    """A node of the tree: an edit and the row that comes of it. Survivors and children hold it."""

    __slots__ = ("parent", "initial", "role", "text", "depth", "children", "survivors")

    def __init__(self, parent: _Edit | None, initial: str, role: str | None, text: str):
        self.parent, self.initial, self.role, self.text = parent, initial, role, text
        self.depth = parent.depth + 1 if parent else 0
        self.children, self.survivors = set(), 0


def _before(x: _Edit, y: _Edit) -> bool:
    """Whether the edits that lead to ``x`` are the lesser ones, compared from where the two ways part."""
    a, b = [], []
    while x is not y:
        if x.depth >= y.depth:
            a.append(x.initial)
            x = x.parent
        else:
            b.append(y.initial)
            y = y.parent
    return a[::-1] < b[::-1]


class Repair:
    """The cheapest edits of one conversation, handed to ``emit(initial, role, text)`` as soon as they are certain.

    ``role`` is None for a deleted row.
    """

    def __init__(self, emit: Callable[[str, str | None, str], None]):
        self.emit, self.root = emit, _Edit(None, "", None, "")
        self.ways: dict[int, tuple[int, _Edit]] = {}
        self._set({_NONE: (0, self.root)})

    @property
    def open_edits(self) -> int:
        return max(node.depth for _, node in self.ways.values()) - self.root.depth

    @staticmethod
    def _offer(ways: dict, state: int, cost: int, parent: _Edit, initial: str, role: str | None, text: str) -> None:
        rival = ways.get(state)
        if rival and rival[0] < cost:
            return
        node = _Edit(parent, initial, role, text)
        if not rival or cost < rival[0] or _before(node, rival[1]):
            ways[state] = cost, node

    def _set(self, ways: dict[int, tuple[int, _Edit]]) -> None:
        """Add insertions to new survivors, give up states that cannot win, and drop the edits nobody descends from."""
        for initial in "ua":
            froms, to = _FOLLOWS[initial]
            for state in froms:
                if state in ways:
                    cost, node = ways[state]
                    self._offer(ways, to, cost + INSERT, node, "I", _NAMES[initial], "")
        # What may follow no row or a system row may also follow an assistant's, but for a system row, which would be deleted.
        best = ways[_ASSISTANT][0]
        ways = {s: w for s, w in ways.items() if not (s == _SYSTEM and w[0] > best or s == _NONE and w[0] > best + DELETE)}
        for _, node in ways.values():
            node.survivors += 1
            while node.parent and node not in node.parent.children:
                node.parent.children.add(node)
                node = node.parent
        gone, self.ways = [node for _, node in self.ways.values()], ways
        for node in gone:
            node.survivors -= 1
            while node.parent and not node.survivors and not node.children:
                node.parent.children.discard(node)
                node = node.parent
        while not self.root.survivors and len(self.root.children) == 1:
            self._emit(next(iter(self.root.children)))

    def _emit(self, node: _Edit) -> None:
        node.parent, self.root = None, node
        self.emit(node.initial, node.role, node.text)

    def row(self, role: str, text: str, fault: int) -> None:
        ways: dict[int, tuple[int, _Edit]] = {}
        for state, (cost, node) in self.ways.items():
            self._offer(ways, state, cost + DELETE, node, "D", None, "")
        if fault in (_FINE, _TRUNCATED):
            cut_off = CUT_OFF if fault == _TRUNCATED else 0
            for initial in "sua":
                froms, to = _FOLLOWS[initial]
                keep = role[:1] == initial
                if not keep and initial == "s":
                    continue
                for state in froms:
                    if state in self.ways:
                        cost, node = self.ways[state]
                        name = role if keep else _NAMES[initial]
                        self._offer(ways, to, cost + cut_off + (0 if keep else REROLE), node, "K" if keep else "R", name, text)
        self._set(ways)

    def end(self) -> int:
        """Hand out what is still open; returns the cost of all edits."""
        cost, node = self.ways[_ASSISTANT]
        if _NONE in self.ways:
            other = self.ways[_NONE]
            if other[0] < cost or other[0] == cost and _before(other[1], node):
                cost, node = other
        tail = []
        while node is not self.root:
            tail.append(node)
            node = node.parent
        for node in reversed(tail):
            self._emit(node)
        return cost


class _Report:
    """What is counted while the rows of a conversation go by, and with ``keep`` the repaired rows not yet taken."""

    def __init__(self, keep: bool = False):
        self.keep, self.rows, self.position = keep, [], 0
        self.initials, self.digest = [], hashlib.sha256()
        self.repair = Repair(self._emit)
        self.counts, self.illegal, self.turns = [0, 0, 0, 0], 0, 0
        self.first = self.last = self.previous = None

    def _emit(self, initial: str, role: str | None, text: str) -> None:
        self.initials.append(initial)
        if len(self.initials) > 4096:
            self.initials = ["".join(self.initials)]
        if role is None:
            return
        self.digest.update((("\n" if self.position else "") + f"{role}:{text}").encode())
        if self.keep:
            self.rows.append((self.position, role, text, initial))
        self.position += 1

    def row(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if self.previous == (turn, role, text) and fault != _BLANK:
            fault = _DUPLICATE
        if self.previous and self.previous[1][:1] + role[:1] not in GOOD_PAIRS:
            self.illegal += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn
        self.previous = turn, role, text
        self.counts[fault] += 1
        self.repair.row(role, text, fault)

    def end(self) -> tuple:
        cost = self.repair.end()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, *self.counts[1:], self.illegal, cost, "".join(self.initials), self.digest.hexdigest()

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _read(rows: DataFrame, keep: bool, columns: str) -> DataFrame:
    """Read the conversations in order: one row of ``columns`` for each report or, with ``keep``, for each repaired row."""
    found = with_faults(rows)
    found = found.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = T.StructType([found.schema["conv_id"], *T.StructType.fromDDL(columns)])

    def ended(conv_id, report: _Report) -> list[tuple]:
        result = report.end()
        return [(conv_id, *r) for r in report.taken()] if keep else [(conv_id, *result)]

    def arrow(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        first, *others = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(first, id_type), *map(pa.array, others)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id = report = id_type = None
        for batch in batches:
            out, id_type = [], batch.column(0).type
            for conv_id, turn, role, text, lost, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if report is None or conv_id != open_id:
                    out += ended(open_id, report) if report else []
                    open_id, report = conv_id, _Report(keep)
                if not lost:
                    report.row(turn, role, text, fault)
            out += [(open_id, *r) for r in report.taken()] if report else []
            if out:
                yield arrow(out, id_type)
        out = ended(open_id, report) if report else []
        if out:
            yield arrow(out, id_type)

    return found.mapInArrow(run, schema)


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damaged`` or like rows: its faults, the cost of its repair, the edits, a digest."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return _read(rows, False, ", ".join(f"{c} bigint" for c in counts) + ", audit string, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id``, ``position`` (from 0), ``role``, ``text`` and ``edit`` (K, R or I)."""
    return _read(rows, True, "position bigint, role string, text string, edit string")


def query(conversations: DataFrame) -> DataFrame:
    return reports(damaged(conversations))
