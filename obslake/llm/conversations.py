"""Conversation structure repair by survivor-coalescence Viterbi.

A repaired conversation is empty, or one system turn at most and then pairs of
user and assistant turns.  Every row is kept, given another role or deleted, and
empty turns may be inserted; the cheapest edits win, and of equally cheap ones
those whose initials (D, I, K, R) are least in ASCII order.

1. Equal rows of a conversation and turn are counted map-side and carried as one
   row with its copies.  One shuffle by conversation follows; a window marks rows
   whose role and text were seen earlier.
2. Each task streams its sorted conversations through a Viterbi search with four
   states (nothing yet, after system, after user, after assistant).  The survivor
   of a state is a node of a backpointer tree with reference counts.  Once all
   survivors descend from one child of the root, that child's edit is emitted and
   the root moves on; survivors that cannot win any more are dropped.  So a task
   holds the undecided end of one conversation, whatever its length.  Survivors
   of equal cost are compared by all their edits from where they parted (the
   comparison is carried along, so it costs no walk); runs of deletions are one
   node with a count.

A conversation is one task's work, since the hash of its repaired text is one
sequential pass; sort and window spill, and the task's Python holds the undecided
nodes, not the rows.  Nodes and their texts pile up only where no row tells two
readings apart (such as thousands of rows that all need another role).

Edge cases: a null role or text is one space, as is a null id or turn in the
damage key; null turns sort first and do not count as gaps; null ids are one
conversation.  Rows of equal turn are ordered by role, then text.  Repeated rows
are duplicates of the first.  An empty role has no initial and is illegal.  Texts
of any length pass whole, one Arrow record at a time.  A conversation without rows
(all dropped) has zeros, no edits and the hash of the empty text.  An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Costs of the edits, and what a truncated row adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
KEPT = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
# Inserts in the order in which one may follow another.
INSERTED = ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT))
LEGAL = frozenset(("su", "ua", "au"))
NOT_BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def damage(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the CRC-32 of
    ``conv_id:turn`` mod 20.  A dropped row stays with no copies, so that its
    conversation does."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"),
                   F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(key) % 20
    body = F.coalesce(F.col(text), space)
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body).alias("text"),
    ).select(
        "conv_id", F.when(F.col("kind") != 0, F.col("turn")).alias("turn"),
        F.when(F.col("kind") != 0, F.col("role")).otherwise("").alias("role"),
        F.when(F.col("kind") != 0, F.col("text")).otherwise("").alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def undamaged(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies) of rows as they are."""
    return rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with their faults, whole
    conversations together and in order in each partition."""
    counted = rows.groupBy("conv_id", "turn", "role", "text", (F.col("copies") > 0).alias("there")).agg(
        F.sum("copies").alias("copies"))
    earlier = Window.partitionBy("conv_id", "role", "text", "there").orderBy(F.col("turn").asc_nulls_first())
    blank = ~F.col("text").rlike(NOT_BLANK)
    return (counted.repartition("conv_id")
            .withColumn("seen", F.row_number().over(earlier) > 1)
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
            .select("conv_id", F.col("turn").cast("long").alias("turn"), "role",
                    # The text of a row that must go is not needed any more.
                    F.when(blank | F.col("seen"), "").otherwise(F.col("text")).alias("text"), "copies",
                    "there", blank.alias("blank"), "seen", (~F.col("text").rlike(ENDED)).alias("truncated")))


# --- the search ------------------------------------------------------------

class Node:
    """``count`` times the edit ``edit``; what a kept or new turn says."""

    __slots__ = ("parent", "edit", "count", "role", "text", "kids", "held")

    def __init__(self, parent: Node | None, edit: str, count: int, role: str | None, text: str | None) -> None:
        self.parent, self.edit, self.count, self.role, self.text = parent, edit, count, role, text
        self.kids: set[Node] = set()
        self.held = 0                  # survivors that end here
        if parent is not None:
            parent.kids.add(self)


class Repair:
    """The search over one conversation; ``emitted`` gets (edit, count, role,
    text) in order as soon as they are certain.

    ``order[p, q]`` compares the whole edits of two survivors from where they
    parted: -inf or inf if they differ there (p or q is smaller, whatever
    follows), else m if q's are p's and then m inserts (m < 0: the reverse).
    Two survivors have consumed the same rows, so nothing but inserts can make
    one longer."""

    def __init__(self, emitted) -> None:
        self.emit = emitted
        self.root = Node(None, "", 0, None, None)
        self.root.held = 1
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.order: dict[tuple[int, int], float] = {(START, START): 0}
        self._settle({START: (0, START, "", None)}, None, 0)

    def row(self, role: str, text: str, copies: int, must_go: bool, truncated: bool) -> None:
        if must_go:
            self._delete(copies)
            return
        extra = TRUNCATED * truncated
        # Of each state after the row: (cost, state before, edits, role).
        fresh: dict[int, tuple] = {}
        for state, (cost, _) in self.best.items():
            self._offer(fresh, state, (cost + DELETE, state, "D", None))
        for state, after in KEPT.get(role[:1], ()):
            if state in self.best:
                self._offer(fresh, after, (self.best[state][0] + extra, state, "K", role))
        for state, after in INSERTED:
            if state in self.best:
                self._offer(fresh, after, (self.best[state][0] + REROLE + extra, state, "R", ROLE_OF[after]))
        self._settle(fresh, text, 1)
        if copies > 1:                 # the copies repeat a row seen already
            self._delete(copies - 1)

    def _delete(self, count: int) -> None:
        self._settle({state: (cost + DELETE * count, state, "D", None) for state, (cost, _) in self.best.items()},
                     None, count)

    def _parted(self, one: tuple, other: tuple) -> float:
        """``order`` of two offers."""
        ahead = self.order[one[1], other[1]]
        if math.isinf(ahead):
            return ahead
        a, b = "I" * int(-ahead) + one[2], "I" * int(ahead) + other[2]
        for x, y in zip(a, b):
            if x != y:
                return -math.inf if x < y else math.inf
        return len(b) - len(a)

    def _offer(self, fresh: dict, state: int, offer: tuple) -> None:
        held = fresh.get(state)
        if held is None or offer[0] < held[0] or offer[0] == held[0] and self._before(offer, held):
            fresh[state] = offer

    def _before(self, one: tuple, other: tuple) -> bool:
        parted = self._parted(one, other)
        return parted == -math.inf or 0 < parted < math.inf

    def _settle(self, fresh: dict, text: str | None, count: int) -> None:
        """Inserts, then the offers become the survivors; emits what they agree on."""
        for state, after in INSERTED:
            if state in fresh:
                cost, parent, edits, role = fresh[state]
                self._offer(fresh, after, (cost + INSERT, parent, edits + "I", role))
        if ASSISTANT in fresh:
            # From after the assistant all is possible that is from the others,
            # at no more than a deleted system turn: what costs more cannot win.
            limit = fresh[ASSISTANT][0]
            for state, slack in ((START, DELETE), (SYSTEM, 0)):
                if state in fresh and fresh[state][0] > limit + slack:
                    del fresh[state]
        self.order = {(p, q): self._parted(x, y) for p, x in fresh.items() for q, y in fresh.items()}
        old, self.best = self.best, {}
        made: dict[tuple, Node] = {}
        for state, (cost, parent, edits, role) in fresh.items():
            node = old[parent][1]
            self.best[state] = (cost, self._grown(made, node, parent, edits, role, text, count, state))
        for _, node in self.best.values():
            node.held += 1
        for _, node in old.values():
            node.held -= 1
            self._release(node)
        for _, node in self.best.values():
            self._shortened(node)
        self._advance()

    @staticmethod
    def _grown(made: dict, node: Node, parent: int, edits: str, role: str | None, text: str | None, count: int,
               state: int) -> Node:
        """The node of ``edits`` below ``node``; equal beginnings are shared."""
        for i, edit in enumerate(edits):
            if edit == "I":            # the last of the inserts leads to the state itself
                turn, body = ROLE_OF[state if i == len(edits) - 1 else USER], ""
            else:
                turn, body = role, text
            key = (parent, edits[:i], edit, turn)
            if key not in made:
                made[key] = Node(node, edit, count if edit == "D" else 1, turn, body)
            node = made[key]
        return node

    def _release(self, node: Node) -> None:
        """Frees ``node`` and the ancestors that nothing refers to any more."""
        while node is not self.root and not node.kids and not node.held:
            parent = node.parent
            parent.kids.discard(node)
            node = parent

    def _shortened(self, node: Node) -> None:
        """Deletions that follow each other without a branch become one node."""
        parent = node.parent
        while (parent is not None and parent is not self.root and node.edit == parent.edit == "D"
               and not parent.held and len(parent.kids) == 1):
            node.count, node.parent = node.count + parent.count, parent.parent
            parent.parent.kids.discard(parent)
            parent.parent.kids.add(node)
            parent = node.parent

    def _advance(self) -> None:
        while len(self.root.kids) == 1 and not self.root.held:
            (child,) = self.root.kids
            self.emit(child.edit, child.count, child.role, child.text)
            child.parent, self.root = None, child

    def end(self) -> int:
        """The rest of the edits; returns the cost."""
        done = {s: (self.best[s][0], s, "", None) for s in (START, ASSISTANT) if s in self.best}
        last = min(done, key=lambda s: done[s][0])
        for s, offer in done.items():
            if offer[0] == done[last][0] and self._before(offer, done[last]):
                last = s
        path, node = [], self.best[last][1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.emit(node.edit, node.count, node.role, node.text)
        return done[last][0]


class Conversation:
    """Faults, edits and hash of one conversation, row by row."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = self.last_initial = None
        self.turns = 0
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.lines = 0
        self.search = Repair(self._edit)

    def _edit(self, edit: str, count: int, role: str | None, text: str | None) -> None:
        self.audit.append(edit * count)
        if edit != "D":
            self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.lines += 1

    def add(self, turn, role: str, text: str, copies: int, blank: bool, seen: bool, truncated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        self.last_initial = initial
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies if seen else copies - 1
            self.truncated += truncated and not seen
        self.search.row(role, text, copies, blank or seen, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        cost = self.search.end()
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                "".join(self.audit), self.digest.hexdigest())


FIELDS = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text,
    copies): its faults, the cost and initials of the cheapest edits, and the
    SHA-256 of the repaired ``role:text`` lines."""
    together = ordered(rows)
    kind = together.schema["conv_id"].dataType.simpleString()
    names = [c.split()[0] for c in FIELDS.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        done: list[tuple] = []
        held = 0
        types = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", *names])

        for batch in batches:
            types = types or [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = [batch.column(c).to_pylist() for c in
                       ("conv_id", "turn", "role", "text", "copies", "there", "blank", "seen", "truncated")]
            for conv_id, turn, role, text, copies, there, blank, seen, truncated in zip(*columns):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                        held += len(done[-1][7])
                    now = Conversation(conv_id)
                    if held > 1 << 20 or len(done) >= 4096:
                        yield out()
                        done, held = [], 0
                if there:
                    now.add(turn, role, text, copies, blank, seen, truncated)
        if now is not None:
            done.append(now.result())
        if done:
            yield out()

    return together.mapInArrow(search, f"conv_id {kind}, {FIELDS}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) of the repaired conversations, in the
    order of ``position`` in each; same rows and edits as ``repair``."""
    together = ordered(rows)
    kind = together.schema["conv_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, place, types = [], 0, None
        search_of = None

        def emitted(edit: str, count: int, role: str | None, text: str | None) -> None:
            nonlocal place
            if edit != "D":
                out.append((now[0], place, role, text))
                place += 1

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                               ["conv_id", "position", "role", "text"])
            out.clear()
            return batch

        for batch in batches:
            types = types or [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
            columns = [batch.column(c).to_pylist() for c in
                       ("conv_id", "role", "text", "copies", "there", "blank", "seen", "truncated")]
            for conv_id, role, text, copies, there, blank, seen, truncated in zip(*columns):
                if search_of is None or conv_id != now[0]:
                    if search_of is not None:
                        search_of.end()
                    now, place = [conv_id], 0
                    search_of = Repair(emitted)
                if there:
                    search_of.row(role, text, copies, blank or seen, truncated)
                if len(out) >= 1024:
                    yield flush()
        if search_of is not None:
            search_of.end()
        if out:
            yield flush()

    return together.mapInArrow(search, f"conv_id {kind}, position long, role string, text string")
