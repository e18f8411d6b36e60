"""Repair of conversations as lightest derivations.

A conversation's rows, in the order of their turns, are edited so that the initials of the roles match ``(s?(ua)+)?``.
Keep costs 0, rerole to user or assistant 1, delete 2 (the only edit of blank and duplicate rows), insertion of an empty
user or assistant row 5; a truncated row that stays adds 5. Of the cheapest edits those stay whose initials ("audit") are
least in ASCII order.

The edits are deductions of a weighted hypergraph. Items are prefixes ``(rows read, state)`` and edits ``(row, edit)``;
a prefix and an edit of its next row give the next prefix, a prefix and an insertion another one of the same row, and
an accepting prefix of all rows the goal. An item weighs its cost and audit, an edit its cost alone. A deduction adds the
costs and appends the edit's initial, which never gives less than either part and is monotone: an audit tells its cost,
so of two derivations of an item with equal cost none is the beginning of the other. Knuth's agenda therefore finalises
items in the order of their weights.

Rows move once, dealt by conversation and sorted by turn; a conversation passes through its task as a stream, since its
digest needs its texts in order. It is repaired in segments: each starts from the weights of the last one's states, and
each state carries the digest of its own lightest path, so the texts of one segment are held, however long the
conversation is. Of the rest only the audit stays, a letter a row.

Defined cases: a null id is a conversation of its own; null turns come first; null roles and texts are one space. Equal
turns are ordered by role, then text. Roles other than those that begin with s, u or a can't be kept, nor can empty ones.
Rows that repeat are duplicates of the first one. Very long texts are held one by one; the texts of a segment wait for
its end. An empty table gives no rows. Other columns of the input are not carried, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import SLICE_CHARS
from .registry import query

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
#: Added for a truncated row that stays.
TRUNCATED = 5
#: States: nothing yet, and the last role's initial. Steps by initial; a missing one isn't allowed.
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ACCEPTING = ("", "a")
ROLES = {"u": "user", "a": "assistant"}
#: Neighbours that need no repair.
LEGAL = {"su", "ua", "au"}
#: Rows of a segment.
SEGMENT = 256
WHITE = " \t\n\v\f\r"
MOST = 2**63 - 1


def added(state: str) -> str:
    """The initial of the user or assistant row that may follow a state: there is exactly one."""
    return next(c for c in STEPS[state] if c in ROLES)


def edits(row: tuple[str, str | None]) -> list[tuple[int, str]]:
    """The edits of a row, given as its role's initial and its fault, with their costs."""
    initial, fault = row
    out = [(DELETE, "D")]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        out += [(REROLE + more, "R")] + [(KEEP + more, "K")] * (initial in ("s", "u", "a"))
    return out


def lightest(rows: list[tuple[str, str | None]], start: dict[str, tuple[int, str]], last: bool) -> dict[str, tuple[int, str]]:
    """The least (cost, audit) of each state after all rows; of the goal alone, under ``None``, if this is the end.

    ``rows`` holds initials and faults, ``start`` the weights of the states before the first row.
    """
    n = len(rows)
    agenda = [(cost, audit, ("prefix", 0, state)) for state, (cost, audit) in start.items()]
    agenda += [(cost, "", ("edit", i, letter)) for i, row in enumerate(rows) for cost, letter in edits(row)]
    heapq.heapify(agenda)
    final: set[tuple] = set()
    prefixes: list[list[tuple]] = [[] for _ in range(n + 1)]  # finalised, by rows read
    offers: list[list[tuple]] = [[] for _ in range(n)]  # finalised edits, by row
    reached: dict[str | None, tuple[int, str]] = {}

    def combine(prefix: tuple, edit: tuple) -> None:
        (cost, audit, (_, i, state)), (more, _, (_, _, letter)) = prefix, edit
        initial = rows[i][0] if letter == "K" else added(state)
        to = state if letter == "D" else STEPS[state].get(initial)
        if to is not None and ("prefix", i + 1, to) not in final:
            heapq.heappush(agenda, (cost + more, audit + letter, ("prefix", i + 1, to)))

    while agenda:
        found = cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final.add(item)
        kind, i, name = item
        if kind == "goal":
            return {None: (cost, audit)}
        if kind == "edit":
            offers[i].append(found)
            for prefix in prefixes[i]:
                combine(prefix, found)
            continue
        prefixes[i].append(found)
        to = STEPS[name][added(name)]
        if ("prefix", i, to) not in final:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", ("prefix", i, to)))
        if i < n:
            for edit in offers[i]:
                combine(found, edit)
        elif last:
            if name in ACCEPTING:
                heapq.heappush(agenda, (cost, audit, ("goal", n, "")))
        else:
            reached[name] = cost, audit
            if len(reached) == len(STEPS):
                break
    return reached


#: What it costs at most to go on from the first state as one would from the second, which ends as well.
INSTEAD = {("a", "s"): 0, ("a", ""): 2, ("a", "u"): 5, ("u", "a"): 5, ("u", "s"): 5, ("u", ""): 7}


class Digest:
    """The digest of the rows that stay, one ``role:text`` line each."""

    def __init__(self):
        self.sha, self.between = hashlib.sha256(), ""

    def child(self) -> "Digest":
        other = Digest()
        other.sha, other.between = self.sha.copy(), self.between
        return other

    def take(self, letter: str, role: str, text: str) -> None:
        if letter != "D":
            self.sha.update(f"{self.between}{role}:{text}".encode())
            self.between = "\n"


class Lines:
    """The rows that stay, of one segment; those of the segments before belong to the parent."""

    def __init__(self, parent: "Lines | None" = None):
        self.parent, self.rows = parent, []

    def child(self) -> "Lines":
        return Lines(self)

    def take(self, letter: str, role: str, text: str) -> None:
        if letter != "D":
            self.rows.append((role, text, letter))

    def chain(self) -> list["Lines"]:
        out = [self]
        while out[-1].parent is not None:
            out.append(out[-1].parent)
        return out[::-1]


@dataclass
class Path:
    """The lightest way to a state: its cost, its weight's text within the segment, all edits, and what they leave."""

    cost: int
    key: str
    state: str
    audit: tuple | None  # (edits before the segment, edits of the segment)
    left: Digest | Lines


class Conversation:
    """One conversation as a stream of rows; ``left`` receives the rows that stay.

    Only one segment of rows is held. Each state has a path of its own with its own copy of ``left``.
    """

    def __init__(self, left: Digest | Lines, segment: int = SEGMENT):
        self.segment = segment
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns = 0
        self.first = self.final = self.previous = None
        self.rows: list[tuple[str, str, str | None]] = []
        self.paths: dict[str | None, Path] = {"": Path(0, "", "", None, left)}

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> bool:
        """Take in the next row; whether this ended a segment."""
        if turn is not None and turn != self.final:
            self.first, self.final, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if fault:
            self.counts[fault] += 1
        if self.previous is not None and self.previous + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.previous = role[:1]
        self.rows.append((role, text, fault))
        if len(self.rows) < self.segment:
            return False
        self._repair(last=False)
        return True

    def _repair(self, last: bool) -> None:
        # Audits before the segment are as good as one letter each, in their order. One that goes on from another by
        # insertions is written as such, since what follows the shorter one decides between them.
        roots: list[Path] = []
        start = {}
        for state, path in sorted(self.paths.items(), key=lambda p: p[1].key):
            if not roots or not path.key.startswith(roots[-1].key):
                roots.append(path)
            start[state] = path.cost, chr(len(roots)) + path.key[len(roots[-1].key):]
        found = lightest([(role[:1], fault) for role, _, fault in self.rows], start, last)
        paths = {state: self._follow(roots[ord(key[0]) - 1], cost, key) for state, (cost, key) in found.items()}
        # A state from which no cheapest repair can go on is dropped.
        self.paths = {state: path for state, path in paths.items()
                      if not any(path.cost > other.cost + INSTEAD.get((name, state), path.cost) for name, other in paths.items())}
        self.rows = []

    def _follow(self, root: Path, cost: int, key: str) -> Path:
        left, state, at = root.left.child(), root.state, 0
        for letter in key[1:]:
            role, text = ROLES[added(state)], ""
            if letter != "I":
                own, text, _ = self.rows[at]
                role = own if letter in "KD" else role
                at += 1
            if letter != "D":
                state = STEPS[state][role[:1]]
            left.take(letter, role, text)
        return Path(cost, key, state, (root.audit, key[1:]), left)

    def finish(self) -> Path:
        """The goal: the cheapest repair of all rows."""
        self._repair(last=True)
        return self.paths[None]

    @staticmethod
    def audit(path: Path) -> str:
        parts, at = [], path.audit
        while at is not None:
            at, letters = at
            parts.append(letters)
        return "".join(reversed(parts))

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else min(MOST, self.final - self.first + 1 - self.turns)


def in_order(rows: DataFrame, conversation: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """Rows dealt by conversation and sorted, with their faults; rows that aren't present stand for their conversation only."""
    space = F.lit(" ")
    named = rows.select(
        F.col(conversation).alias("conversation"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"),
        F.coalesce(present if present is not None else F.lit(True), F.lit(False)).alias("present"),
    ).repartition("conversation")
    # Both orders are within the tasks that this deal makes.
    earlier = Window.partitionBy("conversation", "present", "role", F.col("text")).orderBy(F.asc_nulls_first("turn"))
    core = F.rtrim("text", F.lit(WHITE))
    fault = F.when(core == "", "blank").when(F.row_number().over(earlier) > 1, "duplicate") \
        .when(~F.right(core, F.lit(1)).isin(".", "!", "?"), "truncated")
    return named.withColumn("fault", fault).sortWithinPartitions(
        "conversation", F.desc("present"), F.asc_nulls_first("turn"), "role", "text", F.col("fault").eqNullSafe("duplicate"))


def streamed(batches: Iterator[pa.RecordBatch], begin: Callable, segment: int) -> Iterator[tuple]:
    """Run conversations over sorted rows: (id, conversation, its goal) at each one's end, the goal None at a segment's."""
    name, now = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conversation", "turn", "role", "text", "present", "fault")]
        for key, turn, role, text, present, fault in zip(*columns):
            if now is None or key != name:
                if now is not None:
                    yield name, now, now.finish()
                name, now = key, Conversation(begin(), segment)
            if present and now.add(turn, role, text, fault):
                yield name, now, None
    if now is not None:
        yield name, now, now.finish()


def _as_batches(rows: Iterator[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, each with its characters, as batches of bounded size."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held, size = [], 0
    for chars, row in rows:
        held.append(row)
        size += chars
        if len(held) >= 4000 or size >= SLICE_CHARS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _over(rows: DataFrame, conversation: str, fields: str, work) -> DataFrame:
    """``work`` over the ordered rows of each task; its rows hold the conversation and the fields."""
    first = T.StructField(conversation, rows.schema["conversation"].dataType)
    schema = T.StructType([first] + T._parse_datatype_string(fields).fields)
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _as_batches(work(batches), arrow), schema)


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations, row by row: conversation, ``place`` (from 0), ``role``, ``text`` and ``edit``.

    Deleted rows are left out. ``present`` marks the rows to read, all if it isn't given. Rows are given out as soon as
    all states agree on them.
    """
    def work(batches):
        place = 0
        for key, now, goal in streamed(batches, Lines, segment):
            paths = [goal] if goal is not None else list(now.paths.values())
            chains = [p.left.chain() for p in paths]
            sure = next((i for i, nodes in enumerate(zip(*chains)) if len(set(map(id, nodes))) > 1), min(map(len, chains)))
            for node in chains[0][:sure]:
                for name, words, letter in node.rows:
                    yield len(words), (key, place, name, words, letter)
                    place += 1
                node.rows, node.parent = [], None
            for chain in chains:
                if len(chain) > sure:
                    chain[sure].parent = None
            if goal is not None:
                place = 0

    ordered = in_order(rows, conversation, turn, role, text, present)
    return _over(ordered, conversation, "place long, role string, text string, edit string", work)


def report(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: faults, cost, audit, and the digest of its repaired ``role:text`` lines."""
    def work(batches):
        for key, now, goal in streamed(batches, Digest, segment):
            if goal is not None:
                audit = now.audit(goal)
                yield len(audit), (key, now.gaps, *now.counts.values(), goal.cost, audit, goal.left.sha.hexdigest())

    ordered = in_order(rows, conversation, turn, role, text, present)
    return _over(ordered, conversation, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                 "audit string, repaired_sha256 string", work)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by a checksum of id and turn; ``present`` is false where a row is lost."""
    space = F.lit(" ")
    id_turn = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    named = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), space).alias(c) for c in ("role", "text")],
                        (F.crc32(id_turn.cast("binary")) % 20).alias("harm"))
    text = F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return named.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("harm") != 0).alias("present"),
                        F.explode(times).alias("time")).drop("time")


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation of the table, damaged by rule, with its faults and its cheapest repair."""
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return report(damaged(rows), present=F.col("present"))
