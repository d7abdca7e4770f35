"""Repair of the structure of conversations by a Viterbi search with survivor coalescence.

A conversation in order is an optional system turn and then pairs of user and assistant,
or nothing.  Its turns, in order, are kept (0), given the other role (``REROLE``) or
deleted (``DELETE``), and empty turns may be put in anywhere (``INSERT``); a turn that is
blank or repeats an earlier one must go, and a truncated one that stays costs ``CUT``
more.  The edits of least cost are chosen, and of those the list whose initials (K, R, D, I)
come first in ASCII.

The search has four states: nothing yet, after the system's, the user's, the assistant's turn.
A survivor that can no longer win is dropped; each state's survivor is a leaf of a tree of back pointers whose nodes count their
references; a branch that no survivor needs is freed, and once the root has a single
child, all survivors share its edits, which are written and forgotten.  So a task holds
the turns on which the survivors still differ, and those beyond ``HELD`` in a
temporary file.  On equal cost the complete unresolved suffixes are compared: every
survivor has as many letters other than I, the last one among them, so none begins another,
and their order follows from the order of the survivors they grow from.  It is
carried along as a rank, and a tie takes constant time however long the suffixes are.

Turns are dealt out by conversation and sorted, then streamed, so a conversation of any
length passes through bounded memory.  It does so in one task: the digest of a
repaired conversation is a chain over its turns.  Whether a turn repeats an earlier one is
found before, by grouped minima over hashes, and joins the stream as a marker before
the turn.

Order is by turn, nulls first; rows of one turn stand by role, then by the SHA-256 of their
text.  Null roles and texts read as one space.  A role counts by its first letter, and one
that begins with none of s, u, a is not kept.  Null ids are one conversation.  Further
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: Unresolved turns that a task keeps in memory, per side of its queue.
HELD = 2000

_WHITE = " \t\n\v\f\r"
#: State after a role's initial; 0 is the start, 1 to 3 follow s, u and a.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_DUE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_ENDS = {0: 0, 3: 0, 2: 1, 1: 2}  # turns put in to end from a state


#: What a way from one state to the end costs more, at most, than the same way from another: turns put in,
#: and the deletion of a later system turn that only the start could keep.
_MORE = {
    (0, 1): 0, (0, 2): INSERT, (0, 3): 0, (1, 0): 2 * INSERT, (1, 2): INSERT, (1, 3): 2 * INSERT,
    (2, 0): INSERT + DELETE, (2, 1): INSERT, (2, 3): INSERT, (3, 0): DELETE, (3, 1): 0, (3, 2): INSERT,
}


def _steps(initial: str, fault: str) -> list[list[tuple[int, int, str]]]:
    """Per state reached: (state before, cost, initials of the edits), one per state before."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        state, put = before, ""
        for _ in range(3):
            stays = CUT if fault == "truncated" else 0
            ways = [(state, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                if (state, initial) in _NEXT:
                    ways.append((_NEXT[state, initial], stays, "K"))
                due = _NEXT[state, _DUE[state][0]]
                ways.append((due, stays + REROLE, "R"))
            for after, cost, letter in ways:
                made = (INSERT * len(put) + cost, put + letter)
                best[before, after] = min(best.get((before, after), made), made)
            state, put = _NEXT[state, _DUE[state][0]], put + "I"
    return [[(b, *best[b, a]) for b in range(4) if (b, a) in best] for a in range(4)]


_TABLE = {(i, f): _steps(i, f) for i in ("s", "u", "a", "") for f in ("", "blank", "duplicate", "truncated")}


class Tree:
    """Back pointers with reference counts, in flat arrays whose places are used again."""

    def __init__(self) -> None:
        self.parent, self.refs, self.kids, self.word, self.free = array("q"), array("q"), array("q"), [], []
        self.root = self.add(-1, "")

    def __len__(self) -> int:
        return len(self.parent) - len(self.free)

    def add(self, parent: int, word: str) -> int:
        """A node with one reference, its survivor's."""
        if self.free:
            node = self.free.pop()
            self.parent[node], self.refs[node], self.kids[node], self.word[node] = parent, 1, 0, word
        else:
            node = len(self.parent)
            for a, v in ((self.parent, parent), (self.refs, 1), (self.kids, 0), (self.word, word)):
                a.append(v)
        if parent >= 0:
            self.refs[parent] += 1
            self.kids[parent] ^= node
        return node

    def drop(self, node: int) -> None:
        """One reference less; what nobody refers to is freed."""
        while node >= 0:
            self.refs[node] -= 1
            if self.refs[node]:
                return
            parent = self.parent[node]
            self.free.append(node)
            if parent >= 0:
                self.kids[parent] ^= node
            node = parent

    def shared(self, leaves: set[int]) -> Iterator[str]:
        """Edits that all survivors share, from the first on; the root moves down."""
        while self.refs[self.root] == 1 and self.root not in leaves:
            child = self.kids[self.root]  # the only one left
            self.free.append(self.root)
            self.root = child
            self.parent[child] = -1
            yield self.word[child]

    def path(self, node: int) -> list[str]:
        """Edits from the root to a node."""
        words = []
        while node != self.root:
            words.append(self.word[node])
            node = self.parent[node]
        return words[::-1]


class Queue:
    """First in, first out; what lies between its two ends goes to a temporary file in blocks."""

    def __init__(self, held: int = HELD) -> None:
        self.held, self.front, self.back, self.blocks, self.file = held, deque(), [], deque(), None

    def put(self, item: tuple) -> None:
        if not self.blocks and not self.back and len(self.front) < self.held:
            self.front.append(item)
            return
        self.back.append(item)
        if len(self.back) >= self.held:
            self.file = self.file or tempfile.TemporaryFile()
            self.blocks.append(self.file.seek(0, 2))
            pickle.dump(self.back, self.file)
            self.back = []

    def get(self) -> tuple:
        if not self.front:
            if self.blocks:
                self.file.seek(self.blocks.popleft())
                self.front.extend(pickle.load(self.file))
                if not self.blocks:
                    self.file.truncate(0)
            else:
                self.front.extend(self.back)
                self.back = []
        return self.front.popleft()

    def close(self) -> None:
        if self.file:
            self.file.close()


class Search:
    """The search over one conversation, turn by turn.

    Yields the decided edits as (edit, turn, role, text, fault).
    """

    def __init__(self, held: int = HELD) -> None:
        self.tree, self.queue = Tree(), Queue(held)
        self.leaf = {0: self.tree.root}
        self.cost, self.rank = {0: 0}, {0: 0}
        self.state, self.total = 0, 0

    def step(self, turn: object, role: str, text: str, fault: str) -> Iterator[tuple]:
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        cost, rank = self.cost, self.rank
        chosen = {}
        for after, ways in enumerate(_TABLE[initial, fault]):
            best = min(((cost[b] + c, rank[b], b, w) for b, c, w in ways if b in cost), default=None)
            if best:
                chosen[after] = best
        # A survivor that another one undercuts whatever follows can no longer win or tie.
        for (a, b), more in _MORE.items():
            if a in chosen and b in chosen and chosen[a][0] + more < chosen[b][0]:
                del chosen[b]
        old = self.leaf
        self.leaf = {after: self.tree.add(old[b], w) for after, (_, _, b, w) in chosen.items()}
        for node in old.values():
            self.tree.drop(node)
        self.cost = {after: x[0] for after, x in chosen.items()}
        order = sorted(chosen, key=lambda after: (chosen[after][1], chosen[after][3]))
        self.rank = {after: i for i, after in enumerate(order)}
        self.queue.put((turn, role, text, fault))
        for word in self.tree.shared(set(self.leaf.values())):
            yield from self._written(word)

    def _written(self, word: str) -> Iterator[tuple]:
        for edit in word:
            due = _DUE[self.state]
            if edit == "I":
                self.state = _NEXT[self.state, due[0]]
                yield "I", None, due, "", ""
                continue
            turn, role, text, fault = self.queue.get()
            if edit != "D":
                self.state = _NEXT[self.state, role[:1] if edit == "K" else due[0]]
            yield edit, turn, due if edit == "R" else role, text, fault

    def end(self) -> Iterator[tuple]:
        """The remaining edits; ``total`` is the whole cost then."""
        try:
            self.total, _, state = min((c + INSERT * _ENDS[s], self.rank[s], s) for s, c in self.cost.items())
            for word in [*self.tree.path(self.leaf[state]), "I" * _ENDS[state]]:
                yield from self._written(word)
        finally:
            self.queue.close()


def _stream(turns: DataFrame) -> DataFrame:
    """Rows of each conversation together and in order, with a marker (kind 0) before a turn that repeats an earlier one."""
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    text = F.coalesce(turns["text"].cast("string"), F.lit(" "))
    rows = turns.select(
        turns["conv_id"].alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit(" ")).alias("role"),
        F.sha2(text, 256).alias("key"),
        F.lit(1).alias("kind"),
        text.alias("text"),
        gone.alias("gone"),
    )
    own = rows.where("not gone").select("conv_id", "turn", "role", "key")
    least = F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")))
    firsts = (
        own.groupBy("conv_id", "role", "key")
        .agg(least.alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(
            F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), F.col("first.turn").alias("t")
        )
    )
    again = (
        own.join(firsts, own["conv_id"].eqNullSafe(firsts["c"]) & (own["role"] == firsts["r"]) & (own["key"] == firsts["k"]))
        .where(~F.col("turn").eqNullSafe(F.col("t")))
        .select("conv_id", "turn", "role", "key", F.lit(0).alias("kind"), F.lit("").alias("text"), F.lit(False).alias("gone"))
        .distinct()
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "key", "kind"]
    return rows.unionByName(again).repartition("conv_id").sortWithinPartitions(*order)


def _faults(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(conversation, turn, role, text, fault) in order; fault is None for a row that only names its conversation."""
    mark = last = None
    for batch in batches:
        columns = (batch[c].array for c in ("conv_id", "turn", "role", "key", "kind", "text", "gone"))
        for conv, turn, role, key, kind, text, gone in zip(*columns, strict=True):
            conv, turn = None if pd.isna(conv) else conv, None if pd.isna(turn) else int(turn)
            if gone:
                yield conv, turn, role, text, None
                continue
            here = (conv, turn, role, key)
            if not kind:
                mark = here
                continue
            bare = text.rstrip(_WHITE)
            fault = ""
            if not bare:
                fault = "blank"
            elif here == last or here == mark:
                fault = "duplicate"
            elif bare[-1] not in ".!?":
                fault = "truncated"
            last = here
            yield conv, turn, role, text, fault


def _id_type(turns: DataFrame) -> str:
    return turns.schema["conv_id"].dataType.simpleString()


_NOTHING = object()


def repair(turns: DataFrame) -> DataFrame:
    """Every edit of ``turns`` (conv_id, turn, role, text), in order.

    place counts the turns of the repaired conversation from 0 and is null for a deleted
    one; turn is the original one's, null for one put in; role is the repaired one; fault
    is blank, duplicate, truncated or empty.
    """
    names = ["conv_id", "place", "edit", "turn", "role", "text", "fault"]
    schema = f"conv_id {_id_type(turns)}, place long, edit string, turn long, role string, text string, fault string"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def edits() -> Iterator[tuple]:
            at, search, place = _NOTHING, Search(), 0

            def numbered(found: Iterator[tuple]) -> Iterator[tuple]:
                nonlocal place
                for edit, *rest in found:
                    yield at, None if edit == "D" else place, edit, *rest
                    place += edit != "D"

            for conv, turn, role, text, fault in _faults(batches):
                if conv != at:
                    if at is not _NOTHING:
                        yield from numbered(search.end())
                    at, search, place = conv, Search(), 0
                if fault is not None:
                    yield from numbered(search.step(turn, role, text, fault))
            if at is not _NOTHING:
                yield from numbered(search.end())

        for rows in _blocks(edits()):
            yield _frame(rows, names, turns_type)

    turns_type = _id_type(turns)
    return _stream(turns).mapInPandas(work, schema)


def _blocks(rows: Iterator[tuple], size: int = 2000) -> Iterator[list[tuple]]:
    block = []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield block
            block = []
    if block:
        yield block


def _frame(rows: list[tuple], names: list[str], id_type: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    whole = [c for c in ("place", "turn") if c in names]
    if id_type in ("bigint", "int", "smallint", "tinyint"):
        whole.append("conv_id")
    for c in whole:
        out[c] = pd.array(out[c], dtype="Int64")
    return out


class Digest:
    """What the query reports of one conversation, summed up turn by turn."""

    def __init__(self, conv: object) -> None:
        self.conv, self.search = conv, Search()
        self.turns, self.least, self.most, self.distinct = _NOTHING, None, None, 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.before = 0, None
        self.letters, self.hash, self.begun = bytearray(), hashlib.sha256(), False

    def row(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.turns:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.distinct += 1
        self.turns = turn
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.edits(self.search.step(turn, role, text, fault))

    def edits(self, found: Iterator[tuple]) -> None:
        for edit, _, role, text, _ in found:
            self.letters += edit.encode()
            if edit != "D":
                self.hash.update(f"{chr(10) * self.begun}{role}:{text}".encode())
                self.begun = True

    def done(self) -> tuple:
        self.edits(self.search.end())
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return (
            self.conv, gaps, *self.faults.values(), self.illegal, self.search.total,
            self.letters.decode(), self.hash.hexdigest(),
        )


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation: its gaps and faults, and cost, edits and digest of its repair."""
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    id_type = _id_type(turns)
    counts = ", ".join(f"{c} long" for c in names[1:7])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def summed() -> Iterator[tuple]:
            own = None
            for conv, *row in _faults(batches):
                if own is None or own.conv != conv:
                    if own:
                        yield own.done()
                    own = Digest(conv)
                if row[-1] is not None:
                    own.row(*row)
            if own:
                yield own.done()

        for rows in _blocks(summed()):
            yield _frame(rows, names, id_type)

    return _stream(turns).mapInPandas(work, f"conv_id {id_type}, {counts}, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with known damage, by the checksum of conversation and turn; dropped rows stay, marked ``gone``."""

    def plain(name: str) -> Column:
        return F.coalesce(turns[name].cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    return turns.select(
        turns["conv_id"].alias("conv_id"),
        turns["turn"].alias("turn"),
        F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
        F.when(kind == 0, "").otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
