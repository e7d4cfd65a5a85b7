"""Repair of conversation structure by the cheapest audit trail of edits.

Roles must read `(s?(ua)+)?`. A dynamic program runs over a conversation's rows with one best edit string for each of
the grammar's four states. The strings are persistent: a string is a node that names its last edit and its parent, so
the states share their common prefixes. Every node carries a rolling hash and the ancestors at distances 1, 2, 4, ...;
of two strings of equal cost the smaller one is found by a search for the longest common prefix over these ancestors.
Equal hashes of different nodes are verified edit by edit.

Rows reach a task sorted by conversation and turn and are read as a stream. The prefix that all four strings share is
final: every FLUSH rows it is written to the audit and the digest and then forgotten. A conversation's digest runs over
its whole repaired text, so a conversation is read in order by one task, of any length, in the memory of the rows whose
edits are still open, besides 16 bytes for each of its different rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# The states of `(s?(ua)+)?` are empty, after s, after u, after a; what may follow each of them.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
# Adjacent role initials that are in order.
LEGAL = frozenset({"su", "ua", "au"})
# Rows after which the common prefix is written out.
FLUSH = 512
_BLANK = " \t\n\v\f\r"
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


class Edits:
    """A string of edits: the last one, and the string before it."""

    __slots__ = ("edit", "depth", "print", "up")

    def __init__(self, parent: Edits | None = None, edit: str = ""):
        self.edit = edit
        if parent is None:
            self.depth, self.print, self.up = 0, 0, []
        else:
            self.depth = parent.depth + 1
            self.print = (parent.print * _BASE + ord(edit)) % _MODULUS
            self.up = up = [parent]
            while len(up[-1].up) >= len(up):
                up.append(up[-1].up[len(up) - 1])

    def prefix(self, depth: int) -> Edits:
        node, left = self, self.depth - depth
        while left:
            step = left.bit_length() - 1
            node = node.up[step]
            left -= 1 << step
        return node


def same(a: Edits, b: Edits) -> bool:
    """Whether two strings of one length are equal; equal hashes are verified back to a shared node."""
    if a is b:
        return True
    if a.print != b.print:
        return False
    while a is not b:
        if a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def parted(a: Edits, b: Edits) -> tuple[Edits, Edits]:
    """The shortest prefixes of two strings of one length that differ; the strings themselves if they are equal."""
    if same(a, b):
        return a, b
    for step in reversed(range(len(a.up))):
        # After a step the ancestors of the new nodes may be fewer.
        if step < len(a.up) and not same(a.up[step], b.up[step]):
            a, b = a.up[step], b.up[step]
    return a, b


def smaller(a: Edits, b: Edits) -> Edits:
    """The string that is first in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = parted(a.prefix(depth), b.prefix(depth))
    if x.edit == y.edit:
        return a if a.depth <= b.depth else b
    return a if x.edit < y.edit else b


def better(a: tuple | None, b: tuple | None) -> tuple | None:
    """The cheaper of two (cost, string); of equal cost, the one with the smaller string."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if smaller(a[1], b[1]) is a[1] else b


def _more(state: tuple | None, cost: int, edit: str) -> tuple | None:
    return None if state is None else (state[0] + cost, Edits(state[1], edit))


def _cheaper(state: tuple | None, cost: int, than: tuple | None) -> bool:
    """Whether a step may be as good as what is there, so that its string is worth building."""
    return state is not None and (than is None or state[0] + cost <= than[0])


def inserted(states: list) -> list:
    """The states after any inserts: u after empty, s or a; then a after u. Longer runs come back to their state."""
    states = list(states)
    for source, target in ((0, 2), (1, 2), (3, 2), (2, 3)):
        if _cheaper(states[source], INSERT, states[target]):
            states[target] = better(states[target], _more(states[source], INSERT, "I"))
    return states


def step(states: list, initial: str, must_go: bool, truncated: bool) -> list:
    """The states after one more row."""
    extra = TRUNCATED if truncated else 0
    after = [_more(state, DELETE, "D") for state in states]
    if not must_go:
        for source, follows in enumerate(FOLLOWS):
            for role, target in follows.items():
                edits = [("K", KEEP)] if role == initial else []
                edits += [("R", REROLE)] if role in ROLES else []
                for edit, cost in edits:
                    if _cheaper(states[source], cost + extra, after[target]):
                        after[target] = better(after[target], _more(states[source], cost + extra, edit))
    return useful(inserted(after))


def useful(states: list) -> list:
    """The states without those that cannot be part of a cheapest string any more.

    After a, everything is possible that is possible after s, and at the cost of one more deleted row (an s) all that
    is possible after empty. Without this the string that deletes all rows would share no prefix with the others.
    """
    empty, s, u, a = states
    if a is not None and s is not None and a[0] < s[0]:
        s = None
    if a is not None and empty is not None and a[0] + DELETE < empty[0]:
        empty = None
    return [empty, s, u, a]


class Repair:
    """One conversation: rows in, counts, audit and digest out."""

    def __init__(self, key, flush: int = FLUSH):
        self.key, self.flush = key, flush
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.initial: str | None = None
        self.turns = 0
        self.least = self.most = self.turn = None
        self.states = inserted([(0, Edits()), None, None, None])
        self.open: deque[tuple[str, str]] = deque()
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.emitted = self.speakers = 0

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None and not pd.isna(turn):
            turn = int(turn)
            self.turns += turn != self.turn
            self.turn = turn
            self.least = turn if self.least is None else min(self.least, turn)
            self.most = turn if self.most is None else max(self.most, turn)
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL
        self.initial = initial
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "replace"), digest_size=16).digest()
        stripped = text.rstrip(_BLANK)
        blank, repeated = not stripped, mark in self.seen
        cut = not blank and not repeated and stripped[-1] not in ".!?"
        self.seen.add(mark)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut
        self.states = step(self.states, initial, blank or repeated, cut)
        self.open.append((role, text))
        self.rows += 1
        if self.rows % self.flush == 0:
            self._settle()

    def _settle(self) -> None:
        """Write out what all states share, and let the rest start at an empty string again."""
        live = [s[1] for s in self.states if s is not None]
        shared = live[0]
        for other in live[1:]:
            depth = min(shared.depth, other.depth)
            a, b = shared.prefix(depth), other.prefix(depth)
            if a is b:
                shared = a
            else:
                x, _ = parted(a, b)
                shared = x.up[0] if x.up else x
        self._write(shared)
        fresh = {id(shared): Edits()}

        def again(node: Edits) -> Edits:
            chain = []
            while id(node) not in fresh:
                chain.append(node)
                node = node.up[0]
            for old in reversed(chain):
                fresh[id(old)] = Edits(fresh[id(old.up[0])], old.edit)
            return fresh[id(chain[0])] if chain else fresh[id(node)]

        # Strings that end above the shared prefix of different nodes cannot be: every live string has it in front.
        self.states = [s if s is None else (s[0], again(self._under(s[1], shared))) for s in self.states]

    @staticmethod
    def _under(node: Edits, shared: Edits) -> Edits:
        """The string on the nodes of `shared`, which it equals up to there."""
        if node.prefix(shared.depth) is shared:
            return node
        tail = []
        while node.depth > shared.depth:
            tail.append(node.edit)
            node = node.up[0]
        node = shared
        for edit in reversed(tail):
            node = Edits(node, edit)
        return node

    def _write(self, node: Edits) -> None:
        edits = []
        while node.depth:
            edits.append(node.edit)
            node = node.up[0]
        edits.reverse()
        self.audit.extend(edits)
        for edit in edits:
            role, text = ("", "") if edit == "I" else self.open.popleft()
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                self.speakers = 0
            else:
                speaker = ROLES["ua"[self.speakers % 2]]
                role = speaker if edit in "RI" else role
                self.speakers += 1
            line = f"{role}:{text}"
            self.digest.update(((chr(10) if self.emitted else "") + line).encode("utf-8", "replace"))
            self.emitted += 1

    def result(self) -> tuple:
        final = None
        for state in FINAL:
            final = better(final, self.states[state])
        self._write(final[1])
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, final[0],
                "".join(self.audit), self.digest.hexdigest())


# --- the given damage -------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, there: the rows after the damage; a dropped row stays as one that is not `there`.

    Nulls of role and text are one space, and so are those of conv_id and turn in the hashed text.
    """
    def spelled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")).cast("binary")) % 20
    text = spelled("text")
    marked = rows.select("conv_id", "turn", spelled("role").alias("role"), text.alias("text"), kind.alias("kind"))
    hurt = F.when(F.col("kind") <= 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
    return marked.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        hurt.otherwise(F.col("text")).alias("text"), (F.col("kind") != 0).alias("there"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair(rows: DataFrame, flush: int = FLUSH) -> DataFrame:
    """One row per conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` has conv_id, turn, role, text (strings without nulls) and `there`; a row that is not there only names its
    conversation. Rows are taken by turn, nulls first, then by role and text, so ties and repeated rows have one
    order. All rows of a null conv_id are one conversation. A role's initial is its first character; one that is
    empty or not s, u or a cannot be kept. Other columns are ignored. No rows for an empty table.
    """
    out = StructType([StructField("conv_id", StringType())] + [
        StructField(n, LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ] + [StructField(n, StringType()) for n in ("audit", "repaired_sha256")])

    def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for batch in batches:
            done = []
            for key, unnamed, turn, role, text, there in batch.itertuples(index=False, name=None):
                key = None if unnamed else key
                if current is None or current.key != key:
                    if current is not None:
                        done.append(current.result())
                    current = Repair(key, flush)
                if there:
                    current.add(turn, role, text)
            if done:
                yield _frame(done, out)
        if current is not None:
            yield _frame([current.result()], out)

    # Keys and turns travel as text, so that a null among them does not turn the others into floating point numbers.
    ordered = rows.select("conv_id", "turn", "role", "text", "there").repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    stream = ordered.select(F.col("conv_id").cast("string"), F.col("conv_id").isNull().alias("unnamed"),
                            F.col("turn").cast("string"), "role", "text", "there")
    done = stream.mapInPandas(repaired, out)
    return done.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


def _frame(rows: list[tuple], schema: StructType) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=schema.names, dtype=object)
    return frame.astype({f.name: "int64" for f in schema.fields[1:7]})


def repair_table(rows: DataFrame) -> DataFrame:
    """The repair of every conversation of the given rows after their damage; see `damaged` and `repair`."""
    return repair(damaged(rows.select("conv_id", "turn", "role", "text")))
