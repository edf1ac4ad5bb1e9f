"""Conversation structure repair: generalised LR parsing with weighted edits.

A legal conversation's role initials match ``(s?(ua)+)?``.  The grammar's LR automaton is built from its
rules; a conversation is read row by row, and all ways to edit it run side by side on a graph-structured
stack.  Edits: Keep (0), Rerole to user or assistant (1), Delete (2; the only edit of blank and duplicate
rows), Insert an empty user or assistant row anywhere (5); a truncated row that is not deleted adds 5.
After every row, stacks whose top is the same automaton state are merged: the least (cost, audit) stays,
since what can follow is the same.  The audit is the initials of the edits in order.

Faults of a row, the first that holds: blank (no character but white space ``[\\x20\\x09-\\x0D]``), duplicate
(role and text seen earlier in the conversation), truncated (last such character not one of ``.!?``).

Rows come by turn (nulls first), then role and text, so ties have one order.  A null role, text, id or turn
stands for one space in texts and in the damage's key; an empty or unknown role has no legal initial.  The
rows without an id are one conversation.  Rows repeated are duplicates.  A conversation without rows left
has zeros, an empty audit and the hash of the empty text.  An empty table has an empty result.

Spread: one shuffle by conversation, sorted inside the partition; duplicates are marked by a window over
the same partitions.  A task streams its rows: it holds a few stack tops, each with its own running hash, so
memory does not grow with a conversation, but for its audit (a character a row).  A conversation is read in
order by one task, as its hash requires.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: From any stack top, what follows another one can be had by two inserted rows and a deletion at most, so a top
#: that costs more than that above the cheapest is never on the best way.
HOPELESS = 2 * INSERT + DELETE
#: Left side and right side of the rules; terminals are the role initials.
GRAMMAR = [("C'", "C"), ("C", ""), ("C", "T"), ("C", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua")]
TERMINALS = {"s", "u", "a"}
ROLES = {"u": "user", "a": "assistant"}
SPACE = "[\\x20\\x09-\\x0D]"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


class Automaton:
    """LR(0) states of the grammar: shifts, the rule a state reduces by, and the states that accept."""

    def __init__(self, grammar=GRAMMAR):
        symbols = {s for _, right in grammar for s in right}
        heads = {left for left, _ in grammar}
        self.grammar = grammar

        def closure(items: frozenset) -> frozenset:
            items = set(items)
            while True:
                after = {grammar[r][1][d] for r, d in items if d < len(grammar[r][1])} & heads
                more = {(r, 0) for r, (left, _) in enumerate(grammar) if left in after} - items
                if not more:
                    return frozenset(items)
                items |= more

        self.states, self.goto = [closure(frozenset({(0, 0)}))], {}
        for state in self.states:
            for symbol in sorted(symbols):
                moved = frozenset((r, d + 1) for r, d in state if d < len(grammar[r][1]) and grammar[r][1][d] == symbol)
                if moved:
                    to = closure(moved)
                    if to not in self.states:
                        self.states.append(to)
                    self.goto[self.states.index(state), symbol] = self.states.index(to)
        # "C" ends only with the input, so its rules are no reductions on the way but make a state accept
        self.reduce = {n: r for n, state in enumerate(self.states) for r, d in state
                       if d == len(grammar[r][1]) and grammar[r][0] not in ("C", "C'")}
        self.accept = {n for n, state in enumerate(self.states) for r, d in state if grammar[r][0] == "C" and d == len(grammar[r][1])}


class Node:
    """A place of the graph-structured stack: its state and the node below (merged tops keep one)."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below


class Way:
    """The best edits that lead to a stack top: cost, audit since the last common part, and the running hash."""

    __slots__ = ("node", "cost", "audit", "hash", "rows")

    def __init__(self, node: Node, cost: int, audit: str, hash_, rows: int):
        self.node, self.cost, self.audit, self.hash, self.rows = node, cost, audit, hash_, rows


class Repair:
    """One conversation."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.done = automaton, []
        self.tops = {0: Way(Node(0, None), 0, "", hashlib.sha256(), 0)}
        self._inserts(self.tops)

    def _shift(self, node: Node, initial: str) -> Node | None:
        """The stack after a terminal and all reductions that are due."""
        machine = self.automaton
        to = machine.goto.get((node.state, initial)) if initial in TERMINALS else None
        if to is None:
            return None
        node = Node(to, node)
        while node.state in machine.reduce:
            left, right = machine.grammar[machine.reduce[node.state]]
            for _ in right:
                node = node.below
            node = Node(machine.goto[node.state, left], node)
        return node

    @staticmethod
    def _better(tops: dict, state: int, cost: int, audit: str) -> bool:
        old = tops.get(state)
        return old is None or (cost, audit) < (old.cost, old.audit)

    def _edited(self, tops: dict, way: Way, initial: str, role: str, text: str, cost: int, mark: str) -> Way | None:
        """The way after an edit that leaves a row, where it is the best to its stack top."""
        node = self._shift(way.node, initial)
        if node is None or not self._better(tops, node.state, way.cost + cost, way.audit + mark):
            return None
        after = way.hash.copy()
        after.update(("\n" * (way.rows > 0) + f"{role}:{text}").encode())
        tops[node.state] = Way(node, way.cost + cost, way.audit + mark, after, way.rows + 1)
        return tops[node.state]

    def _inserts(self, tops: dict) -> None:
        """All ways that inserted rows add, until none is better."""
        todo = list(tops.values())
        while todo:
            way = todo.pop()
            for initial, role in ROLES.items():
                new = self._edited(tops, way, initial, role, "", INSERT, "I")
                if new is not None:
                    todo.append(new)

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        tops: dict = {}
        late = CUT_OFF * truncated
        for way in self.tops.values():
            if self._better(tops, way.node.state, way.cost + DELETE, way.audit + "D"):
                tops[way.node.state] = Way(way.node, way.cost + DELETE, way.audit + "D", way.hash, way.rows)
            if not must_go:
                self._edited(tops, way, role[:1], role, text, KEEP + late, "K")
                for initial, name in ROLES.items():
                    self._edited(tops, way, initial, name, text, REROLE + late, "R")
        self._inserts(tops)
        most = min(w.cost for w in tops.values()) + HOPELESS
        self.tops = {state: w for state, w in tops.items() if w.cost <= most}
        if min(len(w.audit) for w in self.tops.values()) >= 4096:
            self._shorten()

    def _shorten(self) -> None:
        """Put the part that all audits begin with aside, so that they stay short."""
        first, last = min(w.audit for w in self.tops.values()), max(w.audit for w in self.tops.values())
        same = next((k for k, (x, y) in enumerate(zip(first, last)) if x != y), min(len(first), len(last)))
        self.done.append(first[:same])
        for way in self.tops.values():
            way.audit = way.audit[same:]

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the best legal conversation."""
        way = min((w for s, w in self.tops.items() if s in self.automaton.accept), key=lambda w: (w.cost, w.audit))
        return way.cost, "".join(self.done) + way.audit, way.hash.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """The test damage, by crc32(``conv_id:turn``) % 20: 0 drops the row (kept here, marked ``gone``), 1 empties the
    text, 2 removes its ``[.!?]``, 3 repeats the row, 4 sets role user."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("kind")
    base = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = base.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                      text.alias("text"), (F.col("kind") == 0).alias("gone"),
                      F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")


def faults(text: Column, repeated: Column) -> Column:
    """First fault of a row: 1 blank, 2 duplicate, 3 truncated, 0 none."""
    blank = F.regexp_replace(text, f"{SPACE}+", "") == ""
    return F.when(blank, 1).when(repeated, 2).when(~text.rlike(f"[.!?]{SPACE}*\\z"), 3).otherwise(0)


def repair(rows: DataFrame) -> DataFrame:
    """Row per conversation of (conv_id, turn, role, text, gone): ``RESULT``.  Rows that are gone only name it."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "gone")
    rows = rows.repartition("conv_id")
    before = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    marked = rows.withColumn("fault", faults(F.col("text"), before))
    sorted_ = marked.sortWithinPartitions(F.asc_nulls_first("conv_id"), "gone", F.asc_nulls_first("turn"), "role", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, own = Automaton(), None
        out: list[tuple] = []
        for batch in batches:
            for conv, turn, role, text, gone, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.conv != conv:
                    if own is not None:
                        out.append(own.finish())
                    own = Conversation(machine, conv)
                if not gone:
                    own.add(turn, role, text, fault)
            if len(out) >= 1000:
                yield made(out)
                out = []
        if own is not None:
            out.append(own.finish())
        if out:
            yield made(out)

    return sorted_.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(each, RESULT)


def made(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                      names=[x.split()[0] for x in RESULT.split(", ")])


class Conversation:
    """Counts and repair of one conversation's rows, in order."""

    def __init__(self, machine: Automaton, conv: int | None):
        self.conv, self.repair, self.count, self.illegal = conv, Repair(machine), [0, 0, 0, 0], 0
        self.initial = self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.count[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.repair.row(role, text, fault in (1, 2), fault == 3)

    def finish(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        cost, audit, digest = self.repair.result()
        return (self.conv, gaps, *self.count[1:], self.illegal, cost, audit, digest)


def op11(rows: DataFrame) -> DataFrame:
    """Row per conversation of the damaged ``conversations``: ``RESULT``."""
    return repair(damaged(rows))
