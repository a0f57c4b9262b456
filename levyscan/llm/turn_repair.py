"""Conversation structure repair by a Viterbi decoder that emits what its survivors agree on.

A repaired conversation has the roles ``(s?(ua)+)?`` by their first letters. Rows are read in
order; four states (nothing yet, after system, after user, after assistant) each keep their
cheapest edits so far, the survivor. Survivors are leaves of a backpointer tree in which every
node counts those that refer to it: a node that nothing refers to any more is taken out, and
its parent too if that was the last reference. Once the root has one child left, all survivors
share it, and its edits are emitted. So memory holds only what is still undecided, and not a
conversation. A survivor that another state undercuts by more than any ending can win back is
dropped, else the deletion of every row would hold the tree open to the end.

Ties go to the ASCII-least edits as a whole. All survivors have read the same rows, so two
different leaves differ before either ends, and their order in the tree settles every later
comparison; that order is carried along with the leaves, which compares complete unresolved
suffixes without walking them again.

Rows of a conversation go to one task in order, as its text is one running hash, and stream
through it: sorts spill to disk, repeated rows are told by a window that spills, and no
conversation is held whole. A conversation's length so bounds the longest task, not memory.

Defined results: null role or text is one space, a null turn comes first, a null id is a
conversation of its own; rows of one turn are in order of role and text; equal rows are
duplicates from the second on; a row with an empty role cannot be kept as it is; an empty
table gives an empty table; other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levyscan.llm.common import only

INK = "[^\\x20\\x09-\\x0D]"
RETOLD, DELETED, ADDED, CUT_SHORT = 3, 4, 3, 3  # costs of a new role, a deletion, an insertion, a truncated row

START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_MADE = (USER, USER, ASSISTANT, USER)  # where a made role (user, or assistant after a user) leads
#: What it costs at most to end from one state (row) as another one (column) would.
_IN_PLACE_OF = ((0, 0, 3, 0), (6, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))
#: States reached by adding 0, 1 or 2 rows: (from, rows added).
_REACHED = {
    START: ((START, 0),),
    SYSTEM: ((SYSTEM, 0),),
    USER: ((USER, 0), (START, 1), (SYSTEM, 1), (ASSISTANT, 1)),
    ASSISTANT: ((ASSISTANT, 0), (USER, 1), (START, 2), (SYSTEM, 2)),
}


class _Node:
    """The edits for one row: insertions in front of it, then its own letter."""

    __slots__ = ("parent", "letters", "row", "kids")

    def __init__(self, parent: "_Node | None", letters: str, row):
        self.parent, self.letters, self.row, self.kids = parent, letters, row, set()


class Decoder:
    """Edits of one conversation. A row is any object with `initial`, `lost` (must go) and
    `short` (truncated); `read` and `finish` yield (letter, row or None, made role or None)."""

    def __init__(self):
        self.root = _Node(None, "", None)
        self._state = START  # of what is emitted
        self.survivors = self._closed({START: (0, 0, self.root)})

    @staticmethod
    def _closed(leaves: dict) -> dict:
        """state -> (cost, order of the leaf, insertions behind it, leaf)"""
        out = {}
        for state, ways in _REACHED.items():
            found = [(leaves[a][0] + ADDED * k, leaves[a][1], k, leaves[a][2]) for a, k in ways if a in leaves]
            if found:
                out[state] = min(found, key=lambda f: f[:3])
        costs = [(a, f[0]) for a, f in out.items()]
        return {b: f for b, f in out.items() if not any(cost + _IN_PLACE_OF[a][b] < f[0] for a, cost in costs)}

    def read(self, row) -> Iterator[tuple]:
        best: dict = {}

        def offer(state: int, cost: int, order: int, letters: str, leaf: _Node):
            if state not in best or (cost, order, letters) < best[state][:3]:
                best[state] = (cost, order, letters, leaf)

        for state, (cost, order, added, leaf) in self.survivors.items():
            before = "I" * added
            offer(state, cost + DELETED, order, before + "D", leaf)
            if not row.lost:
                more = CUT_SHORT if row.short else 0
                kept = _KEPT.get((state, row.initial))
                if kept is not None:
                    offer(kept, cost + more, order, before + "K", leaf)
                offer(_MADE[state], cost + RETOLD + more, order, before + "R", leaf)
        ranked = sorted(best, key=lambda s: best[s][1:3])
        leaves = {s: (best[s][0], i, _Node(best[s][3], best[s][2], row)) for i, s in enumerate(ranked)}
        old = [f[3] for f in self.survivors.values()]
        self.survivors = self._closed(leaves)
        for _, _, _, leaf in self.survivors.values():
            leaf.parent.kids.add(leaf)
        for node in old:
            while not node.kids and node.parent is not None:
                node.parent.kids.discard(node)
                node = node.parent
        while len(self.root.kids) == 1:
            (child,) = self.root.kids
            child.parent = None
            self.root = child
            yield from self._said(child)

    def finish(self) -> Iterator[tuple]:
        ends = [self.survivors[s] for s in (START, ASSISTANT) if s in self.survivors]
        _, _, added, node = min(ends, key=lambda f: f[:3])
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            yield from self._said(node)
        yield from self._said(_Node(None, "I" * added, None))

    def _said(self, node: _Node) -> Iterator[tuple]:
        for letter in node.letters:
            made = None
            if letter in "RI":
                made = "assistant" if self._state == USER else "user"
                self._state = _MADE[self._state]
            elif letter == "K":
                self._state = _KEPT[self._state, node.row.initial]
            yield letter, None if letter == "I" else node.row, made


class _Row:
    __slots__ = ("turn", "role", "text", "fault", "initial", "lost", "short")

    def __init__(self, turn, role: str, text: str, fault: str):
        self.turn, self.role, self.text, self.fault = turn, role, text, fault
        self.initial, self.lost, self.short = role[:1], fault in ("blank", "duplicate"), fault == "truncated"


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault) with each conversation in one partition, in order.
    `fault` is a row's first one: blank, duplicate, truncated, or none (empty)."""
    spaced = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    together = spaced.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    told = together.withColumn("nth", F.row_number().over(same))
    fault = (
        F.when(~F.col("text").rlike(INK), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z"), "truncated")
        .otherwise("")
    )
    ordered = told.withColumn("fault", fault).sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
    return ordered.select("conv_id", "turn", "role", "text", "fault")


def edits(rows: DataFrame) -> DataFrame:
    """The edits that repair each conversation, in order: (conv_id, turn, edit, role, text,
    cost, old_role, fault). `edit` is K (kept), R (new role), D (deleted) or I (inserted; its
    turn, old_role and fault are null). A deleted row keeps its role and text here."""
    found = with_faults(rows)
    id_type = dict(found.dtypes)["conv_id"]
    turn_type = dict(found.dtypes)["turn"]
    schema = f"conv_id {id_type}, turn {turn_type}, edit string, role string, text string, cost int, old_role string, fault string"

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        types = None
        now, decoder = None, None

        def put(said: Iterator[tuple]):
            nonlocal size
            for letter, row, made in said:
                if letter == "I":
                    out.append((now[0], None, letter, made, "", ADDED, None, None))
                    continue
                cost = DELETED if letter == "D" else (RETOLD if letter == "R" else 0) + (CUT_SHORT if row.short else 0)
                out.append((now[0], row.turn, letter, made or row.role, row.text, cost, row.role, row.fault))
                size += len(row.text)

        def flush() -> pa.RecordBatch:
            nonlocal size
            names = ["conv_id", "turn", "edit", "role", "text", "cost", "old_role", "fault"]
            kinds = [types[0], types[1], pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
            batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
            size = 0
            return batch

        for batch in batches:
            types = [batch.column(0).type, batch.column(1).type]
            for conv, turn, role, text, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if now != (conv,):
                    if decoder is not None:
                        put(decoder.finish())
                    now, decoder = (conv,), Decoder()
                put(decoder.read(_Row(turn, role, text, fault)))
                if len(out) > 4096 or size > 1 << 20:
                    yield flush()
        if decoder is not None:
            put(decoder.finish())
        if out:
            yield flush()

    return found.mapInArrow(decoded, schema)


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: (conv_id, place, turn, role, text), `place` from 0; an
    inserted row has a null turn and an empty text."""
    said = edits(only(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col))
    kept = said.filter("edit <> 'D'").select("conv_id", "turn", "role", "text")
    schema = "conv_id {conv_id}, place long, turn {turn}, role string, text string".format(**dict(kept.dtypes))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = None, 0
        for batch in batches:
            places = []
            for conv in batch.column(0).to_pylist():
                now, place = (conv,), place + 1 if now == (conv,) else 0
                places.append(place)
            yield pa.record_batch([batch.column(0), pa.array(places, pa.int64()), *batch.columns[1:]], names=["conv_id", "place", "turn", "role", "text"])

    return kept.mapInArrow(placed, schema)


_LEGAL = {"su", "ua", "au"}


class _Digest:
    """Running figures of one conversation."""

    def __init__(self, conv):
        self.conv, self.counts = conv, {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.first = self.last = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.hash, self.any = hashlib.sha256(), False

    def add(self, turn, edit, role, text, cost, old_role, fault):
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            self.counts[fault] += 1
            if turn is not None:
                self.first = turn if self.first is None else self.first
                self.turns += turn != self.last
                self.last = turn
            initial = old_role[:1]
            self.illegal += self.before is not None and self.before + initial not in _LEGAL
            self.before = initial
        if edit != "D":
            self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.last is None else int(self.last) - int(self.first) + 1 - self.turns
        c = self.counts
        return (self.conv, gaps, c["blank"], c["duplicate"], c["truncated"], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def digest(said: DataFrame) -> DataFrame:
    """One row per conversation of `edits`: gaps in its turns, rows by fault, neighbours whose
    roles do not follow, cost, the edits' letters, and the hash of the repaired conversation."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kind = dict(said.dtypes)["conv_id"]
    schema = f"conv_id {kind}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", audit string, repaired_sha256 string"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:
            types = [batch.column(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            done = []
            for conv, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(*rest)
            if done:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if now is not None:
            yield pa.record_batch([pa.array([c], t) for c, t in zip(now.row(), types)], names=names)

    return said.mapInArrow(summed, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in, by a checksum of conversation and turn: of 20 rows one
    is dropped, one emptied, one loses its sentence ends, one is repeated, one becomes the
    user's. Nulls are one space, also in the checksum's text."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    marked = only(conversations, conv_id="conv_id", turn="turn", role="role", text="text").withColumn("kind", kind).filter("kind <> 0")
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace(shown("text"), "[.!?]", ""))
        .otherwise(shown("text"))
    )
    changed = marked.select("conv_id", "turn", "kind", F.when(F.col("kind") == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return changed.withColumn("time", F.explode(times)).select("conv_id", "turn", "role", "text")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """`digest` of the repaired rows after `damage`, for every conversation of the input; one
    that lost all its rows has zeros, no edits and the hash of an empty text."""
    found = digest(edits(damage(conversations))).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
