"""Conversation structure repair by a Viterbi search that emits edits as its survivors agree.

Method
    A repaired conversation is empty, or user and assistant in turns, after a system row or
    none. Rows are kept (K), given the other role (R), deleted (D), or an empty row is
    inserted (I); rows that are blank or repeat an earlier one must go. Four states (nothing
    yet, after system, after user, after assistant) each keep one survivor, the cheapest
    edits so far, of equal ones the ASCII-least. Survivors share a tree of backpointers whose
    nodes count the paths through them: a node without paths is freed, and once all survivors
    descend from one node, the edits up to it are final and are emitted. Tied survivors are
    told apart by their complete unresolved suffixes. No suffix is the beginning of another
    (both end in the edit of the same row), so their order never changes by what is appended:
    it is kept as a rank and need not be read again at each row. A survivor that costs more
    than another and the way between their states can never win and is freed.

Scale
    Two streams over rows sorted by conversation. The first sees no texts, only a digest and
    the faults; equal rows of a turn are one row with a count. It holds the edits not yet
    final, a byte each, in a tree of at most seven nodes. The second replays the edits over
    the texts, a row at a time, so a conversation of any length needs no more memory than its
    list of edits. A conversation is never collected; its rows pass through one task of each
    stream, since the search and a digest of the whole go from row to row.

Edge cases
    A null role or text is one space; a null conversation id is a conversation. Null turns
    come first; rows that tie are ordered by role, then by a digest of role and text. Roles
    count by their first character; an empty or other one must be rerole'd or deleted. Turns
    are longs. Equal rows of one turn are repeats of the first. An empty table gives an empty
    result. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import arrow_map, handed_over

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a rerole'd or inserted row leads to.
ONWARD = (USER, USER, ASSISTANT, USER)
#: Kept rows by their initial: state before, state after.
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Inserted rows that end a conversation in each state.
CLOSING = (0, 2, 1, 0)
#: BRIDGE[y][x]: from state y any rest of a conversation costs at most so much more than from x.
BRIDGE = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))

BLANKS = " \t\n\x0b\f\r"


class Step(NamedTuple):
    """One way from a state over a row: its target, cost and edits."""

    to: int
    cost: int
    edits: bytes


def _steps(initial: str, must_go: bool, truncated: bool) -> list[list[Step]]:
    """For every state the best way to every other over a row of this kind."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, bytes]] = {}
        at = state
        for inserted in range(3):
            ways = [(at, DELETE, b"D")]
            if not must_go:
                ways.append((ONWARD[at], REROLE + TRUNCATED * truncated, b"R"))
                if at in KEEPS.get(initial, ()):
                    ways.append((KEEPS[initial][at], TRUNCATED * truncated, b"K"))
            for to, cost, edit in ways:
                way = (INSERT * inserted + cost, b"I" * inserted + edit)
                best[to] = min(best.get(to, way), way)
            at = ONWARD[at]
        out.append([Step(to, *way) for to, way in best.items()])
    return out


STEPS = {
    (i, gone, cut): _steps(i, gone, cut) for i in ("s", "u", "a", "") for gone in (False, True) for cut in (False, True)
}


class Node:
    """A stretch of edits on the way of every survivor below it."""

    __slots__ = ("edits", "parent", "below")

    def __init__(self, parent: Node | None, edits: bytes = b"") -> None:
        self.parent = parent
        self.edits = bytearray(edits)
        self.below: list[Node] = []
        if parent is not None:
            parent.below.append(self)


class Search:
    """The survivors of one conversation. `final` holds the edits on which all agree."""

    def __init__(self) -> None:
        self.root = Node(None)
        self.final = self.root.edits
        self.tips = {START: Node(self.root)}
        self.cost = {START: 0}
        self.rank = {START: 0}

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        steps = STEPS[initial, must_go, truncated]
        best: dict[int, tuple[int, int, bytes, int]] = {}
        for state, cost in self.cost.items():
            for to, more, edits in steps[state]:
                way = (cost + more, self.rank[state], edits, state)
                if to not in best or way < best[to]:
                    best[to] = way
        worth = {x: w for x, w in best.items() if all(v[0] + BRIDGE[y][x] >= w[0] for y, v in best.items())}
        order = sorted(worth, key=lambda x: worth[x][1:3])
        self.cost = {x: w[0] for x, w in worth.items()}
        self.rank = {x: place for place, x in enumerate(order)}
        self._grow({x: (w[3], w[2]) for x, w in worth.items()})

    def _grow(self, ways: dict[int, tuple[int, bytes]]) -> None:
        """Survivors go on from the tips of `ways`; tips without a successor are freed."""
        uses: dict[int, int] = {}
        for state, _ in ways.values():
            uses[state] = uses.get(state, 0) + 1
        tips = {}
        for to, (state, edits) in ways.items():
            if uses[state] == 1:
                tips[to] = self.tips[state]
                tips[to].edits += edits
            else:
                tips[to] = Node(self.tips[state], edits)
        lost = any(state not in uses for state in self.tips)
        self.tips = tips
        if lost:
            live = set(tips.values())
            self.root.below = [child for child in self.root.below if self._still_used(child, live)]
        self._emit()

    def _still_used(self, node: Node, live: set[Node]) -> bool:
        """Free what no survivor descends from; a stretch with one continuation becomes one with it."""
        if node in live:
            return True
        node.below = [child for child in node.below if self._still_used(child, live)]
        if len(node.below) == 1:
            (only,) = node.below
            node.edits += only.edits
            node.below = only.below
            for child in node.below:
                child.parent = node
            for state, tip in self.tips.items():
                if tip is only:
                    self.tips[state] = node
                    live.add(node)
        return bool(node.below) or node in live

    def _emit(self) -> None:
        while len(self.root.below) == 1:
            (only,) = self.root.below
            self.final += only.edits
            if not only.below:
                only.edits.clear()
                return
            self.root.below = only.below
            for child in only.below:
                child.parent = self.root

    def unresolved(self, state: int) -> bytes:
        """The edits of a survivor after the final ones."""
        parts, node = [], self.tips[state]
        while node is not self.root:
            parts.append(bytes(node.edits))
            node = node.parent
        return b"".join(reversed(parts))

    def end(self) -> tuple[int, str]:
        """Cost and edits of the cheapest whole; of equal ones the ASCII-least."""
        state = min(self.cost, key=lambda x: (self.cost[x] + INSERT * CLOSING[x], self.rank[x]))
        edits = bytes(self.final) + self.unresolved(state) + b"I" * CLOSING[state]
        return self.cost[state] + INSERT * CLOSING[state], edits.decode()


def _stated(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text), without nulls in the last two."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), given(role).alias("role"), given(text).alias("text")
    )


def _digest() -> Column:
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Whole conversations to a task, rows by turn."""
    return rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", *first, F.col("turn").asc_nulls_first(), "role", "digest"
    )


def faults(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, digest, copies, blank, truncated, repeated), a row for equal rows of a turn.

    `repeated` says that role and text come in an earlier row; of `copies` all but the first
    repeat it in any case.
    """
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    stated = _stated(rows, conv_id, turn, role, text).select(
        "conv_id", "turn", "role", _digest().alias("digest"), (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("truncated")
    )
    once = stated.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")
    )
    # Nulls first, as turns are ordered.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    least = once.groupBy("conv_id", "digest").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    least = least.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("first.turn").alias("first_turn"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    repeated = F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return once.join(least, same, "left").withColumn("repeated", repeated).drop("c", "d", "first_turn")


class _Tally:
    """What is counted of one conversation while its rows pass."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.search = Search()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last = None

    def add(self, turn, role: str, copies: int, blank: bool, truncated: bool, repeated: bool) -> None:
        initial = role[:1]
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += 1
        kind = initial if initial in ("s", "u", "a") else ""
        for _ in range(copies):
            if self.last is not None:
                self.illegal += self.last + initial not in ("su", "ua", "au")
            self.last = initial
            self.rows += 1
            again = repeated and not blank
            self.blank += blank
            self.duplicate += again
            self.truncated += truncated and not blank and not again
            self.search.row(kind, blank or again, truncated and not blank and not again)
            repeated = True

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, self.rows, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.search.end())


COUNTS = ("n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def edits(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, COUNTS, audit), a row per conversation: its faults, the least cost and the edits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Tally | None = None

        def out(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", *COUNTS, "audit"]
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            done = []
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Tally(conv)
                now.add(*row)
            if done:
                yield out(done, kind)
        if now is not None:
            yield out([now.result()], kind)

    kind = rows.schema[conv_id].dataType.simpleString()
    slim = _in_order(faults(rows, conv_id, turn, role, text))
    longs = ", ".join(f"{c} long" for c in COUNTS)
    slim = slim.select("conv_id", "turn", "role", "copies", "blank", "truncated", "repeated")
    return arrow_map(slim, work, f"conv_id {kind}, {longs}, audit string")


def repaired(
    rows: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the repaired rows, in order within a task.

    `found` is the result of `edits` over the same rows. Inserted rows have no turn.
    """
    names = {USER: "user", ASSISTANT: "assistant"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, state, conv = "", 0, 0, START, None

        def inserted() -> Iterator[tuple]:
            nonlocal at, place, state
            while at < len(audit) and audit[at] == "I":
                state = ONWARD[state]
                at, place = at + 1, place + 1
                yield conv, place, "I", None, names[state], ""

        def out(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                names=["conv_id", "place", "edit", "turn", "role", "text"],
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            done: list[tuple] = []
            for owner, plan, number, by, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if plan is not None:
                    done.extend(inserted())  # what ends the conversation before
                    audit, at, place, state, conv = plan, 0, 0, START, owner
                    continue
                done.extend(inserted())
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                state = KEEPS[by[:1]][state] if edit == "K" else ONWARD[state]
                place += 1
                done.append((conv, place, edit, number, by if edit == "K" else names[state], body))
            if done:
                yield out(done, kind)
        done = list(inserted())
        if done:
            yield out(done, kind)

    kind = rows.schema[conv_id].dataType.simpleString()
    texts = _stated(rows, conv_id, turn, role, text).withColumn("digest", _digest()).withColumn("audit", F.lit(None).cast("string"))
    plans = found.select("conv_id", "audit")
    both = _in_order(texts.unionByName(plans, allowMissingColumns=True), F.col("audit").isNull())
    return arrow_map(
        both.select("conv_id", "audit", "turn", "role", "text"), work,
        f"conv_id {kind}, place long, edit string, turn long, role string, text string",
    )


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the rows of `repaired`, as they come: `role:text`, joined by newlines."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, conv, kind = None, None, None

        def out(done: list[tuple]) -> pa.RecordBatch:
            owners, sums = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(owners, kind), pa.array(sums)], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            kind = batch.column(0).type
            done = []
            for owner, place, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place == 1:
                    if hashed is not None:
                        done.append((conv, hashed.hexdigest()))
                    hashed, conv = hashlib.sha256(), owner
                else:
                    hashed.update(b"\n")
                hashed.update(f"{role}:{text}".encode())
            if done:
                yield out(done)
        if hashed is not None:
            yield out([(conv, hashed.hexdigest())])

    kind = fixed.schema["conv_id"].dataType.simpleString()
    return arrow_map(fixed.select("conv_id", "place", "role", "text"), work, f"conv_id {kind}, repaired_sha256 string")


def damaged(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the remainder of a checksum: 0 drops a
    row, 1 empties its text, 2 takes its full stops and marks, 3 repeats it, 4 makes it a user's."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    chance = (F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20).cast("int")
    rows = _stated(conversations, conv_id, turn, role, text).withColumn("chance", chance).where("chance <> 0")
    body = F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("chance") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("chance") == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def audit(
    rows: DataFrame, ids: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, COUNTS, audit, repaired_sha256) for every id of `ids`, zeros for those without rows."""
    found = handed_over(edits(rows, conv_id, turn, role, text), "edits")
    sums = digests(repaired(rows, found, conv_id, turn, role, text)).withColumnRenamed("conv_id", "s")
    every = ids.select(F.col(conv_id).alias("conv_id")).distinct()
    joined = every.join(found.withColumnRenamed("conv_id", "f"), F.col("conv_id").eqNullSafe(F.col("f")), "left")
    joined = joined.join(sums, F.col("conv_id").eqNullSafe(F.col("s")), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
