"""Repair of the structure of conversations: cheapest edits by a Viterbi search whose survivors coalesce.

A repaired conversation has the roles ``(s?(ua)+)?`` (s, u, a: first letters of system, user, assistant). Every row is kept,
given another role or deleted, and empty turns may be inserted. One state stands for each way a conversation can go on; the best
edits into each state hang in a tree of backpointers that counts its references. A branch that no survivor refers to is freed,
and as soon as all survivors share an ancestor, the edits up to it are given out and forgotten: a conversation is a stream, and
only its undecided end is held. Of edits that cost the same, the ASCII-least wins: where two undecided branches part is found
over skipping pointers, in steps that grow with the logarithm of their length, and whole branches are compared however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.llm.common import pick
from adyield.operators.joins import join_spreading_hot_keys
from adyield.session import checkpointed

RELABEL = 3
DELETE = 4
INSERT = 3
TRUNCATED = 3
#: Rows and bytes of text of one batch of output.
BATCH_ROWS = 5_000
BATCH_BYTES = 8 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
_ROLE = {USER: b"user", ASSISTANT: b"assistant"}
_BLANKS = b" \t\n\x0b\x0c\r"
_LEGAL = {b"su", b"ua", b"au"}
#: State that a kept row's initial leads to, and the states it may follow.
_KEPT = {b"s": (SYSTEM, (START,)), b"u": (USER, (START, SYSTEM, ASSISTANT)), b"a": (ASSISTANT, (USER,))}


class _Node:
    """One edit on a branch. ``refs`` counts branches below and survivors that end here."""

    __slots__ = ("up", "jump", "depth", "edit", "state", "row", "refs", "below")

    def __init__(self, up: _Node | None, edit: str, state: int, row: tuple | None):
        self.up, self.edit, self.state, self.row, self.refs, self.below = up, edit, state, row, 0, []
        if up is None:
            self.depth, self.jump = 0, self
            return
        self.depth = up.depth + 1
        far = up.jump
        self.jump = far.jump if up.depth - far.depth == far.depth - far.jump.depth else up
        up.refs += 1
        up.below.append(self)


def _at_depth(node: _Node, depth: int) -> _Node:
    while node.depth > depth:
        node = node.jump if node.jump.depth >= depth else node.up
    return node


def _before(p: _Node, e: str, q: _Node, f: str) -> bool:
    """Whether the edits up to ``p`` and then ``e`` come before those up to ``q`` and then ``f``."""
    if p is q:
        return e < f
    depth = min(p.depth, q.depth)
    a, b = _at_depth(p, depth), _at_depth(q, depth)
    if a is b:
        return _at_depth(p, depth + 1).edit < f if p.depth > depth else e < _at_depth(q, depth + 1).edit
    while a.up is not b.up:
        a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.up, b.up)
    return a.edit < b.edit


class Survivors:
    """The search over one conversation. ``add`` and ``close`` give out edits (edit, state, row) once they are certain."""

    def __init__(self):
        self.root = _Node(None, "", START, None)
        self.held = 0
        self.best: dict[int, tuple[int, _Node]] = {START: (0, self.root)}
        self._insert(self.best)
        for _, node in self.best.values():
            node.refs += 1

    @staticmethod
    def _offer(found: dict[int, tuple[int, _Node, str]], state: int, cost: int, up: _Node, edit: str) -> None:
        have = found.get(state)
        if have is None or cost < have[0] or (cost == have[0] and _before(up, edit, have[1], have[2])):
            found[state] = (cost, up, edit)

    @staticmethod
    def _insert(layer: dict[int, tuple[int, _Node]]) -> None:
        """Empty turns that lead from the layer's states to others; more than two in a row never pay."""
        for state, froms in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            chosen = None
            for other in froms:
                if other in layer:
                    cost, up = layer[other]
                    if chosen is None or cost < chosen[0] or (cost == chosen[0] and _before(up, "I", chosen[1], "I")):
                        chosen = (cost, up)
            if chosen is None:
                continue
            cost = chosen[0] + INSERT
            have = layer.get(state)
            if have is not None and (have[0] < cost or have[0] == cost and _before(have[1].up, have[1].edit, chosen[1], "I")):
                continue
            layer[state] = (cost, _Node(chosen[1], "I", state, None))
            if have is not None:
                Survivors._free(have[1])

    @staticmethod
    def _free(node: _Node) -> None:
        """Drop a branch upwards, as far as nothing refers to it."""
        while node.refs == 0 and node.up is not None:
            up = node.up
            up.below.remove(node)
            up.refs -= 1
            node = up

    def add(self, initial: bytes, unwanted: bool, truncated: bool, row: tuple) -> Iterator[tuple[str, int, tuple | None]]:
        extra = TRUNCATED if truncated else 0
        found: dict[int, tuple[int, _Node, str]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, node, "D")
            if unwanted:
                continue
            kept, after = _KEPT.get(initial, (None, ()))
            if state in after:
                self._offer(found, kept, cost + extra, node, "K")
            changed = ASSISTANT if state == USER else USER
            self._offer(found, changed, cost + RELABEL + extra, node, "R")
        layer = {state: (cost, _Node(up, edit, state, row)) for state, (cost, up, edit) in found.items()}
        self._insert(layer)
        # a survivor that another can follow more cheaply, whatever comes, is dropped
        least = layer[ASSISTANT][0]
        gone = [s for s, more in ((START, DELETE), (SYSTEM, 0)) if s in layer and layer[s][0] > least + more]
        dropped = [layer.pop(s)[1] for s in gone]
        for _, node in layer.values():
            node.refs += 1
        for _, node in self.best.values():
            node.refs -= 1
            self._free(node)
        for node in dropped:
            self._free(node)
        self.best = layer
        yield from self._certain()

    def _certain(self) -> Iterator[tuple[str, int, tuple | None]]:
        while self.root.refs == 1 and self.root.below:
            self.root = self.root.below[0]
            self.root.up.below, self.root.up = [], None
            yield self.root.edit, self.root.state, self.root.row
            self.root.row = None

    def close(self) -> Iterator[tuple[str, int, tuple | None]]:
        """The edits not yet given out, of the cheapest way to end."""
        end = self.best[ASSISTANT]
        if START in self.best:
            cost, node = self.best[START]
            if cost < end[0] or (cost == end[0] and _before(node.up or node, node.edit, end[1].up, end[1].edit)):
                end = (cost, node)
        self.cost = end[0]
        rest, node = [], end[1]
        while node is not self.root:
            rest.append(node)
            node = node.up
        for node in reversed(rest):
            yield node.edit, node.state, node.row

    def undecided(self) -> int:
        """Edits on the longest branch that is still held."""
        return max(node.depth for _, node in self.best.values()) - self.root.depth


EDITS = ("conv_id long, step long, edit string, fault string, illegal boolean, cost int, turn long, was_role binary, "
         "role binary, text binary")
_NAMES = [part.strip().split(" ")[0] for part in EDITS.split(",")]
_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}
_ARROW = [_TYPES[part.strip().split(" ")[1]] for part in EDITS.split(",")]


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and turn, those that say what was said at an earlier turn announced by a mark, to edits."""
    out: list[tuple] = []
    size = 0

    def full() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW)], names=_NAMES)

    search, place, key, marks, last, initial, step = None, None, None, set(), None, b"", 0

    def put(edits: Iterator[tuple[str, int, tuple | None]]) -> None:
        nonlocal step, size
        for edit, state, row in edits:
            if row is None:
                out.append((place, step, edit, None, None, INSERT, None, None, _ROLE[state], b""))
            else:
                turn, was, text, fault, illegal = row
                cost = DELETE if edit == "D" else (RELABEL if edit == "R" else 0) + (TRUNCATED if fault == "truncated" else 0)
                role = None if edit == "D" else _ROLE[state] if edit == "R" else was
                out.append((place, step, edit, fault, illegal, cost, turn, was, role, text))
                size += len(text)
            step += 1

    for batch in batches:
        for conv, turn, mark, said, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "mark", "said", "role", "text"))):
            if search is None or conv != place:
                if search is not None:
                    put(search.close())
                search, place, key, last, initial, step = Survivors(), conv, None, None, None, 0
            if key is None or key[0] != turn:
                key, marks = (turn,), set()
            if mark:
                marks.add(said)
                continue
            # rows that say the same at the same turn stand next to each other
            again = said in marks or last == (turn, said)
            last = (turn, said)
            seen = text.rstrip(_BLANKS)
            fault = "blank" if not seen else "duplicate" if again else "truncated" if seen[-1:] not in b".!?" else None
            illegal = initial is not None and initial + role[:1] not in _LEGAL
            initial = role[:1]
            put(search.add(initial, fault in ("blank", "duplicate"), fault == "truncated", (turn, role, text, fault, illegal)))
            if len(out) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield full()
                out.clear()
                size = 0
    if search is not None:
        put(search.close())
    if out:
        yield full()


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The cheapest edits that give every conversation the roles ``(s?(ua)+)?``, one row per edit, in order within a partition.

    Columns: conv_id, step (from 0), edit, fault, illegal, cost, turn, was_role, role and text. Keep (K) costs nothing, Rerole
    to user or assistant (R) 3, Delete (D) 4, Insert of an empty turn (I) 3; a truncated row that stays costs 3 more. Of equally
    cheap edits those come that are ASCII-least. role is the role after the edit, null where the row goes; a row's fault is the
    first of blank (no character but blanks), duplicate (role and text stood earlier in the conversation) and truncated (does not
    end in one of ``.!?``); blank and duplicate rows must go. illegal tells that the initials of the row before and of this row are
    none of su, ua, au.

    Rows go by turn, those without one first; rows of the same turn by role and text. A null role or text counts as one blank.
    Rows without a conversation are one conversation of their own. Repeated rows are duplicates but for the first. An empty table
    gives an empty result. Other columns may have any name. Ids and turns are whole numbers. A conversation is read as a stream by
    one task, whatever its length; that an earlier row says the same is found before, by a grouping and a join.
    """
    said = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    plain = pick(rows, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text")).withColumn("said", said)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    where = F.unhex(F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).cast("binary"), F.lit(":").cast("binary"), "said")))
    skinny = checkpointed(plain.select("conv_id", "turn", "said", where.alias("key")))
    first = skinny.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("many")).filter("many > 1")
    later = join_spreading_hot_keys(skinny, first, "key", "many").filter(place > F.col("first"))
    none = F.lit(b"")
    marks = later.select("conv_id", "turn", F.lit(True).alias("mark"), "said", none.alias("role"), none.alias("text")).distinct()
    stream = plain.select("conv_id", "turn", F.lit(False).alias("mark"), "said", F.col("role").cast("binary"), F.col("text").cast("binary")) \
        .union(marks).repartition("conv_id").sortWithinPartitions("conv_id", "turn", F.desc("mark"), "role", "text")
    return stream.mapInArrow(_edits, EDITS)


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.strip().split(" ")[0] for part in REPORT.split(",")]
    out: list[tuple] = []
    open_, place = False, None

    def closed() -> tuple:
        gaps = high - low + 1 - turns if turns else 0
        return place, gaps, faults["blank"], faults["duplicate"], faults["truncated"], wrong, spent, "".join(audit), digest.hexdigest()

    def full() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    for batch in batches:
        for conv, edit, fault, illegal, cost, turn, role, text in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "edit", "fault", "illegal", "cost", "turn", "role", "text"))):
            if not open_ or conv != place:
                if open_:
                    out.append(closed())
                open_, place, audit, digest, empty = True, conv, [], hashlib.sha256(), True
                faults, wrong, spent = {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0
                turns, low, high = 0, 0, None
            audit.append(edit)
            spent += cost
            if fault:
                faults[fault] += 1
            wrong += bool(illegal)
            if turn is not None and turn != high:
                turns, low, high = turns + 1, turn if high is None else low, turn
            if role is not None:
                digest.update((b"" if empty else b"\n") + role + b":")
                digest.update(text)
                empty = False
            if len(out) >= BATCH_ROWS:
                yield full()
                out.clear()
    if open_:
        out.append(closed())
    if out:
        yield full()


def report(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``, read off its edits where they lie.

    gaps counts the whole numbers between the conversation's smallest and largest turn that are no turn; blank, duplicate and
    truncated count faults, illegal pairs of neighbours; cost and audit are the edits' cost and initials; repaired_sha256 is the
    hex digest of the repaired ``role:text``, newline-joined.
    """
    return edits.mapInArrow(_reported, REPORT)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with known damage, by the checksum of ``conv_id:turn`` (nulls are one blank) modulo 20.

    0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    plain = pick(rows, conv_id="conv_id", turn="turn", role="role", text="text").select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return plain.withColumn("kind", kind).filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("copy")).drop("copy")


def audit_damaged(rows: DataFrame) -> DataFrame:
    """Damage conversations and report their repair; a conversation of which no row is left has zeros and no edits."""
    found = report(repair(damaged(rows)))
    everyone = pick(rows, whole="conv_id").distinct().join(found, F.col("whole").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return everyone.select(F.col("whole").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                           F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
