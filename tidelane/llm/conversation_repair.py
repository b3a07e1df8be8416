"""Conversation structure repair: the cheapest edits that turn a conversation into ``(system? (user assistant)+)?``.

A turn with a fault is blank (no character other than ASCII white space), a duplicate (its role and text were seen earlier
in the conversation) or truncated (its last such character is none of ``.!?``); the first of these counts. Edits: Keep
costs 0, Rerole to user or assistant 3, Delete 4 (the only edit of blank turns and duplicates), Insert an empty
user or assistant turn 3, and a truncated turn that stays adds 3. The audit is the edits' initials in order; of the
cheapest audits the least in ASCII order counts. An audit decides what is repaired, as the place in the grammar says which role is due.

Method: a dynamic programme over the turns with one best audit per place in the grammar (``START``, ``SYSTEM``, ``USER``,
``ASSISTANT``). Audits are nodes of a persistent tree that share their prefixes; a node knows its ancestors 1, 2, 4, ...
steps up and a rolling hash of its string. Equal costs are decided by searching the longest common prefix with these, and
what the hashes call equal is verified letter by letter up to the node that both share. The digest of the repaired text is
kept per place, so no text is held.

Layout: one shuffle by conversation; copies of a turn are numbered by a window inside it, then rows are sorted by turn and
streamed. A task holds one turn's text, and of a conversation the live part of its audits: letters
that all live audits share leave the tree (``Audits.compacted``). The digest of a conversation is sequential, so one conversation is one task's stream,
whatever its length; its rows are never gathered.

Awkward rows: a null role or text counts as one space, so a null text is blank and a null role must be replaced. Turns come in order of number (nulls
first), then role, then text. Rows without a conversation number form one conversation. Conversations without a
turn that is present give zeros, an empty audit and the digest of the empty text. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.llm.frames import small_batches

WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Where a role's initial leads from each place.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
#: Nodes of a tree before what its live audits share is cut off.
MOST_NODES = 1 << 16
MOST_LONG = (1 << 63) - 1


class Audits:
    """Strings of edits as a tree: a node is its parent's string and one more letter."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 0x1F3D5B79A):
        self.modulus, self.base = modulus, base
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... steps up
        self.letter, self.depth, self.hash = [""], [0], [0]

    def add(self, parent: int, letter: str) -> int:
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(up)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + ord(letter)) % self.modulus)
        return len(self.up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def _first_difference(self, a: int, b: int) -> tuple[int, int] | None:
        """The first places in which two strings of one length differ, by walking up to the node they share."""
        found = None
        while a != b:
            if self.letter[a] != self.letter[b]:
                found = a, b
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            places = self._first_difference(x, y)
        else:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            # the parents' hashes are equal; a difference above them is a collision and comes first
            places = self._first_difference(self.up[x][0], self.up[y][0]) or (x, y)
        if places is None:
            return self.depth[a] < self.depth[b]
        return self.letter[places[0]] < self.letter[places[1]]

    def string(self, node: int, above: int = 0) -> str:
        """Letters of a node's string after its first ``above``."""
        letters = []
        while self.depth[node] > above:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def compacted(self, live: list[int]) -> tuple[str, Audits, list[int]]:
        """What the live strings share, a tree of their rests, and their nodes in it."""
        depth = min(self.depth[node] for node in live)
        while len({self.ancestor(node, depth) for node in live}) > 1:
            depth -= 1
        tree, known, nodes = Audits(self.modulus, self.base), {}, []
        for node in live:
            at = 0
            for letter in self.string(node, depth):
                if (at, letter) not in known:
                    known[at, letter] = tree.add(at, letter)
                at = known[at, letter]
            nodes.append(at)
        return self.string(self.ancestor(live[0], depth)), tree, nodes


class Conversation:
    """The programme over one conversation. A state is (cost, node of its audit, digest of the repaired text)."""

    def __init__(self, most_nodes: int = MOST_NODES, **tree):
        self.tree, self.most_nodes, self.written = Audits(**tree), most_nodes, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last_turn = self.last_initial = None
        self.states = self._inserted([(0, 0, hashlib.sha256()), None, None, None])

    def _best(self, options: list[tuple]) -> tuple | None:
        """The cheapest of (cost, parent's node, letter, state before, what is written), ties by string."""
        if not options:
            return None
        cost = min(option[0] for option in options)
        best = None
        for option in options:
            if option[0] == cost and (best is None or self._before(option, best)):
                best = option
        _, parent, letter, before, written = best
        if written is None:
            digest = before[2]
        else:
            digest = before[2].copy()
            digest.update(written)
        node = best[1] if not letter else self.tree.add(parent, letter)
        return cost, node, digest

    def _before(self, a: tuple, b: tuple) -> bool:
        if a[1] == b[1]:
            return a[2] < b[2]
        nodes = [self.tree.add(x[1], x[2]) if x[2] else x[1] for x in (a, b)]
        return self.tree.less(*nodes)

    def _inserted(self, states: list) -> list:
        """Let turns be inserted after the last edit. More than one of a role never pays."""
        for role, to in (("u", USER), ("a", ASSISTANT)):
            options = [] if states[to] is None else [(states[to][0], states[to][1], "", states[to], None)]
            for place in NEXT[role]:
                if states[place] is not None:
                    options.append(self._option(states, place, INSERT, "I", ROLES[role], ""))
            states[to] = self._best(options)
        # what can follow START or SYSTEM can follow ASSISTANT, a kept first system turn then being deleted, so dearer
        # states than that end in no cheapest audit; without them old letters are soon shared by all live audits
        for place, more in ((START, DELETE), (SYSTEM, 0)):
            if states[place] is not None and states[place][0] > states[ASSISTANT][0] + more:
                states[place] = None
        return states

    def _option(self, states: list, place: int, cost: int, letter: str, role: str, text: str) -> tuple:
        written = f"{'' if place == START else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass")
        return states[place][0] + cost, states[place][1], letter, states[place], written

    def add(self, turn: int | None, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL
        self.last_initial = initial
        self.blank += blank
        self.duplicate += duplicate and not blank
        faulty = blank or duplicate
        cut = truncated and not faulty
        self.truncated += cut
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last_turn
            self.most = self.last_turn = turn
        before, after = self.states, []
        extra = TRUNCATED if cut else 0
        for to in (START, SYSTEM, USER, ASSISTANT):
            options = [] if before[to] is None else [(before[to][0] + DELETE, before[to][1], "D", before[to], None)]
            if not faulty:
                for place, target in NEXT.get(initial, {}).items():
                    if target == to and before[place] is not None:
                        options.append(self._option(before, place, extra, "K", role, text))
                for due, named in ROLES.items():
                    for place, target in NEXT[due].items():
                        if target == to and before[place] is not None:
                            options.append(self._option(before, place, extra + REROLE, "R", named, text))
            after.append(self._best(options))
        self.states = self._inserted(after)
        if len(self.tree.up) > self.most_nodes:
            self._compact()

    def _compact(self) -> None:
        live = [k for k in range(4) if self.states[k] is not None]
        shared, self.tree, nodes = self.tree.compacted([self.states[k][1] for k in live])
        self.written.append(shared)
        for k, node in zip(live, nodes):
            self.states[k] = (self.states[k][0], node, self.states[k][2])
        self.most_nodes = max(self.most_nodes, 2 * len(self.tree.up))

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
        ends = [s for s in (self.states[START], self.states[ASSISTANT]) if s is not None]
        cost, node, digest = self._best([(s[0], s[1], "", s, None) for s in ends])
        gaps = 0 if self.most is None else min(self.most - self.least + 1 - self.turns, MOST_LONG)
        audit = "".join(self.written) + self.tree.string(node)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()


def _white_cut(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def faults(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``present`` and the faults of each turn, sorted by conversation and turn."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), there.alias("present"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("duplicate")]
    copies = W.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    said = _white_cut(F.col("text"))
    return (
        rows.repartition("conv_id")
        .withColumns(
            {
                "blank": said == "",
                "duplicate": F.row_number().over(copies) > 1,
                "truncated": ~F.right(said, F.lit(1)).isin(*ENDS),
            }
        )
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)
    )


def _streamed(parts: Iterator[pa.RecordBatch], most_bytes: int = 1 << 20) -> Iterator[tuple]:
    for batch in parts:
        step = max(1, batch.num_rows * most_bytes // max(batch.nbytes, 1))
        for first in range(0, batch.num_rows, step):
            yield from zip(*[column.to_pylist() for column in batch.slice(first, step).columns])


MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit_conversations(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: faults, ``cost``, ``audit`` and ``repaired_sha256`` (repaired ``role:text`` lines joined by
    newlines). Rows for which ``present`` does not hold only name their conversation."""
    small_batches(turns.sparkSession)
    conv = turns.schema["conv_id"]
    schema = T.StructType(
        [
            T.StructField("conv_id", conv.dataType),
            *[T.StructField(name, T.LongType()) for name in MEASURES],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, done, current, named = None, [], None, None

        def batch() -> pa.RecordBatch:
            columns = [*zip(*done)] or [[]] * len(schema)
            kinds = [kind, *[pa.int64()] * len(MEASURES), pa.string(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)
            done.clear()
            return out

        def typed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for part in parts:
                kind = part.column(0).type
                yield part

        held = 0
        for conv_id, turn, role, text, there, blank, duplicate, truncated in _streamed(typed(parts)):
            if current is None or conv_id != named:
                if current is not None:
                    done.append((named, *current.result()))
                    held += 200 + len(done[-1][7])
                    if held > 1 << 22:
                        yield batch()
                        held = 0
                current, named = Conversation(), conv_id
            if there:
                current.add(turn, role, text, blank, duplicate, truncated)
        if current is not None:
            done.append((named, *current.result()))
            yield batch()

    return faults(turns, present).mapInArrow(work, schema)


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 1), ``edit``, ``role``, ``text`` of each turn that stays or is
    inserted. ``audits`` comes from ``audit_conversations`` of the same turns. Audit and turns of a conversation
    meet in one sorted stream."""
    small_batches(turns.sparkSession)
    conv = turns.schema["conv_id"]
    schema = T.StructType(
        [
            T.StructField("conv_id", conv.dataType),
            T.StructField("place", T.LongType()),
            T.StructField("edit", T.StringType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    none = lambda kind: F.lit(None).cast(kind)
    said = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), none("string").alias("audit"))
    told = audits.select("conv_id", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), "audit")
    first = F.col("conv_id").asc_nulls_first()
    both = (
        said.unionByName(told)
        .repartition("conv_id")
        .sortWithinPartitions(first, F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")
    )

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, held = None, [], 0

        def batch() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=schema.names)
            out.clear()
            return made

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for part in parts:
                kind = part.column(0).type
                yield part

        named, audit, at, place, due = None, "", 0, 0, "u"

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, due, held
            place += 1
            due = "a" if role[:1] == "u" else "u"
            held += len(text) + 100
            out.append((named, place, edit, role, text))

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                put("I", ROLES[due], "")

        for conv_id, _, role, text, told_audit in _streamed(typed()):
            if told_audit is not None:
                named, audit, at, place, due = conv_id, told_audit, 0, 0, "u"
                inserts()
                continue
            edit, at = audit[at], at + 1
            if edit == "K":
                put("K", role, text)
            elif edit == "R":
                put("R", ROLES[due], text)
            inserts()
            if held > 1 << 22:
                yield batch()
                held = 0
        if out:
            yield batch()

    return both.mapInArrow(work, schema)
