"""Conversation structure repair: the cheapest edits that make roles alternate, by a Viterbi search with coalescence.

The rows of a conversation, by turn, are judged once: blank (no character but white space), duplicate (role and
text seen in an earlier row), truncated (its last such character is not one of `.!?`), else sound. Edits: keep a row (0),
give it the role user or assistant (1), delete it (2; blank and duplicate rows must go), insert an empty user or
assistant row (5). A truncated row that stays costs 5 more. What stays must read `(s?(ua)+)?` in initials of roles.

A search has four states: nothing kept yet, and system, user or assistant kept last. Each state's survivor is
a leaf of a tree of back-pointers. Leaves that lose free their branch, by reference counts; as soon as all survivors
share an ancestor the edits up to it are certain, and they are emitted and forgotten. Survivors that another state can
imitate for less are dropped. Memory thus holds the unresolved ends only, whatever the length of a conversation. Ends
are long only where rows to come decide: of user rows alone the first is deleted if their number turns out odd.
Of equally cheap ways the one whose edit initials (D, I,
K, R) are ASCII-least wins: the survivors' ends are compared whole, back to their common ancestor. No end can be the
beginning of another, because both have judged the same rows and an insertion costs something, so the choice
stands whatever follows.

Rows reach a task by conversation, sorted by turn in Spark, and are read as a stream. Duplicates are found before, by a
window over (conversation, role, text) that needs no further shuffle. A conversation with very many rows
is one sorted stream in one task, with bounded memory: its digest has to read its rows in order in any case.

Rows: nulls in role or text count as one space. Turns that are null come first; rows of one turn are ordered by role,
then text, a repeated row follows its original. A null conv_id is a conversation like others. An empty role has the
initial of a space, which no pattern holds. Repeated rows are duplicates. Texts of any length are handled whole. A
conversation without rows, and an empty table, give empty results. Other columns are ignored.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from cutline.llm.common import BLANKS, ship

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# The states that may follow each state, and the initials that lead to them.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
FINAL = (START, ASSISTANT)
SOUND, TRUNCATED, DUPLICATE, BLANK = 0, 1, 2, 3
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5, "truncated": 5}
LEGAL = ("su", "ua", "au")
EDITS = "conv_id long, at long, edit string, role string, text string"

class Node:
    """An edit in the tree of back-pointers; `held` counts the survivors and edits that follow from it."""

    __slots__ = ("before", "edit", "role", "text", "held")

    def __init__(self, before, edit, role, text):
        self.before, self.edit, self.role, self.text, self.held = before, edit, role, text, 0
        if before is not None:
            before.held += 1


class Repair:
    """The search over one conversation. `add` and `end` return the edits (edit, role, text) that became certain.

    `held` is the number of nodes in memory.
    """

    def __init__(self, costs=COSTS):
        if costs["I"] <= 0:
            raise ValueError("an insertion has to cost something")
        self.costs = costs
        self.root = Node(None, "", None, None)
        self.best = {START: (0, self.root)}
        self.root.held, self.held = 1, 1
        self._insert()

    def _node(self, before, edit, role, text):
        self.held += 1
        return Node(before, edit, role, text)

    def _release(self, node):
        """Frees a leaf and the part of its branch that nothing else needs."""
        while node is not None and not node.held:
            self.held -= 1
            before, node.before = node.before, None
            if before is not None:
                before.held -= 1
            node = before

    def _path(self, node):
        """The edits of a survivor behind the root, as their initials."""
        out = []
        while node is not self.root:
            out.append(node.edit)
            node = node.before
        return "".join(reversed(out))

    def _take(self, table, state, cost, node):
        """Keeps the better of two ways to a state; the loser's branch is freed."""
        old = table.get(state)
        if old is not None and (old[0] < cost or old[0] == cost and self._path(old[1]) <= self._path(node)):
            self._release(node)
            return False
        table[state] = cost, node
        node.held += 1
        if old is not None:
            old[1].held -= 1
            self._release(old[1])
        return True

    def _insert(self):
        """Empty rows inserted at this place: at most one way round the states."""
        changed = list(self.best)
        while changed:
            state = changed.pop(0)
            cost, node = self.best[state]
            for initial, to in NEXT[state].items():
                if to in ROLES:
                    old = self.best.get(to)
                    if old is None or cost + self.costs["I"] <= old[0]:
                        if self._take(self.best, to, cost + self.costs["I"], self._node(node, "I", ROLES[to], "")):
                            changed.append(to)

    def add(self, role, text, fault):
        table, costs = {}, self.costs
        late = costs["truncated"] if fault == TRUNCATED else 0
        for state, (cost, node) in self.best.items():
            ways = [(state, costs["D"], "D", role)]
            if fault not in (BLANK, DUPLICATE):
                for initial, to in NEXT[state].items():
                    if role[:1] == initial:
                        ways.append((to, costs["K"] + late, "K", role))
                    if to in ROLES:
                        ways.append((to, costs["R"] + late, "R", ROLES[to]))
            for to, more, edit, new_role in ways:
                old = table.get(to)
                if old is None or cost + more <= old[0]:
                    self._take(table, to, cost + more, self._node(node, edit, new_role, text))
        before, self.best = self.best, table
        for _, node in before.values():
            node.held -= 1
            self._release(node)
        self._insert()
        self._prune()
        return self._certain()

    def _prune(self):
        """Drops survivors that cannot win: assistant can end, or go on, like system, and like the start but for a system row."""
        if ASSISTANT not in self.best:
            return
        cost = self.best[ASSISTANT][0]
        for state, margin in ((SYSTEM, 0), (START, max(0, self.costs["D"] - self.costs["K"]))):
            if state in self.best and self.best[state][0] > cost + margin:
                _, node = self.best.pop(state)
                node.held -= 1
                self._release(node)

    def _certain(self):
        """The edits between the root and the last ancestor that all survivors share; it becomes the root."""
        out = []
        while self.root.held == 1 and not any(node is self.root for _, node in self.best.values()):
            child = self._only_child()
            out.append((child.edit, child.role, child.text))
            self.held -= 1
            child.before, self.root = None, child
        return out

    def _only_child(self):
        """The one node behind the root: the first of any survivor's branch."""
        if not getattr(self, "trunk", None) or self.trunk[-1].before is not self.root:
            node, self.trunk = next(iter(self.best.values()))[1], []
            while node is not self.root:
                self.trunk.append(node)
                node = node.before
        return self.trunk.pop()

    def end(self):
        """The remaining edits and the cost of the cheapest way that ends in a legal state."""
        ends = [(cost, self._path(node), state) for state, (cost, node) in self.best.items() if state in FINAL]
        cost, _, state = min(ends)
        node, out = self.best[state][1], []
        while node is not self.root:
            out.append((node.edit, node.role, node.text))
            node = node.before
        return out[::-1], cost


def judged(rows):
    """conv_id, turn, role, text, copy and fault of each row, one partition per group of conversations, in order."""
    own = rows.select("conv_id", "turn", "copy", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = (
        F.when(last == "", BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )
    return own.repartition("conv_id").withColumn("fault", fault.cast("int")).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy")


def _conversations(batches):
    """(conv_id, iterator of rows) over sorted batches; rows are (turn, role, text, fault)."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    for conv_id, group in groupby(rows(), key=lambda row: row[0]):
        yield conv_id, (row[1:] for row in group)


COLUMNS = ["conv_id", "turn", "role", "text", "fault"]


def repaired(rows):
    """The edits in order, one row each: conv_id, at, edit, role and text. Rows with another edit than D form the repaired conversation."""
    ship(rows.sparkSession)

    def run(batches):
        out = []
        for conv_id, group in _conversations(batches):
            search, at = Repair(), 0
            for edits in _edits(search, group):
                for edit, role, text in edits:
                    out.append((conv_id, at, edit, role, text))
                    at += 1
                if len(out) >= 1000:
                    yield _batch(out, EDITS)
                    out = []
        yield _batch(out, EDITS)

    return judged(rows).select(*COLUMNS).mapInArrow(run, EDITS)


def _edits(search, group):
    for _, role, text, fault in group:
        yield search.add(role, text, fault)
    yield search.end()[0]


KINDS = {"long": pa.int64(), "string": pa.string()}


def _batch(rows, schema):
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def summaries(rows):
    """A row per conversation that has rows: faults, cost, edit initials and the digest of the repaired conversation."""
    ship(rows.sparkSession)

    def run(batches):
        out = []
        for conv_id, group in _conversations(batches):
            out.append((conv_id, *_summary(group)))
            if len(out) >= 1000:
                yield _batch(out, SUMMARY)
                out = []
        yield _batch(out, SUMMARY)

    return judged(rows).select(*COLUMNS).mapInArrow(run, SUMMARY)


def _summary(group):
    search, digest, audit, kept = Repair(), hashlib.sha256(), [], 0
    faults, illegal, before = [0, 0, 0, 0], 0, None
    low = high = last = None
    turns = 0

    def emit(edits):
        nonlocal kept
        audit.append("".join(e for e, _, _ in edits))
        for edit, role, text in edits:
            if edit != "D":
                digest.update((("\n" if kept else "") + f"{role}:{text}").encode())
                kept += 1

    for turn, role, text, fault in group:
        faults[fault] += 1
        initial = role[:1] or " "
        illegal += before is not None and before + initial not in LEGAL
        before = initial
        if turn is not None:
            turns += last is None or turn != last
            low, high, last = turn if low is None else low, turn, turn
        emit(search.add(role, text, fault))
    edits, cost = search.end()
    emit(edits)
    gaps = high - low + 1 - turns if turns else 0
    return gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, cost, "".join(audit), digest.hexdigest()


def damaged(conversations):
    """Rows after damage by the checksum of `conv_id:turn` modulo 20, with `copy` 0, or 1 for a repeated row.

    0 drops the row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 sets the role user. Nulls count as one space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = summaries(damaged(conversations))
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].eqNullSafe(found["conv_id"]), "left").drop(found["conv_id"])
    zeros = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.withColumns({
        **zeros, "audit": F.coalesce("audit", F.lit("")),
        "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)),
    }).select("conv_id", *zeros, "audit", "repaired_sha256")
