"""Conversation structure repair: faults, cheapest edits, repaired turns.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length spans several tasks
and each task has a slice of whole turns in order. A conversation that lies inside one slice is
settled there. The others go on as runs: a table of what a run does from every state that may come
before it, which is small, and their turns; one task then chains a conversation's runs and streams
its turns once, holding the edits (a byte a turn, as the result has them) and no text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .alignment import Chain, follow, run_table
from .shared import stored

#: A conversation's turns that a task holds at once; beyond either number it goes on as runs.
RUN_TURNS, RUN_BYTES = 512, 4 << 20
#: Text in a slice.
SLICE_BYTES = 64 << 20
_SLICES = 12

_SPACE = " \t\n\x0b\x0c\r"
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = frozenset({"su", "ua", "au"})


def damage(conversations: DataFrame) -> DataFrame:
    """Conversation rows with known faults, and how often each occurs (`copies`, 0 for a dropped one).

    By crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes its sentence ends,
    3 repeats it, 4 makes it a user's. Nulls count as one space, but for the turn, which stays null.
    """
    name = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    rows = as_turns(conversations).withColumn("kind", kind)
    gone = F.col("kind") == 0
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(F.col("kind") == 4, "user").when(~gone, F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .when(~gone, F.col("text"))
        .alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def as_turns(conversations: DataFrame) -> DataFrame:
    """Conversation rows as they are: a null role or text is one space, every row occurs once."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(1).cast("bigint").alias("copies"),
    )


def _place(turn: Column) -> Column:
    """Turns in order, nulls first."""
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


def _sorted_slices(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, repeated) dealt and sorted by conversation and turn; rows of
    one turn by role, then by a digest of their text. Equal rows are one row with its copies."""
    size = turns.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    said = ["conv_id", "role", "digest"]
    first = (
        rows.where("copies > 0")
        .groupBy(*said)
        .agg(F.min(_place(F.col("turn"))).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in said], "first")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in said]
    marked = rows.join(first, same[0] & same[1] & same[2], "left").select(
        "conv_id", "turn", "role", "text", "copies", "digest",
        F.coalesce(_place(F.col("turn")) > F.col("first"), F.lit(False)).alias("repeated"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    slices = marked.repartitionByRange(max(_SLICES, -(-size // SLICE_BYTES)), *order)
    return slices.sortWithinPartitions(*order).drop("digest")


def _fault(text: str, repeated: bool) -> str:
    said = text.rstrip(_SPACE)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


def _code(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "d"
    code = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return code.upper() if fault == "truncated" else code


@dataclass
class Run:
    """Consecutive rows of one conversation: their codes and texts, and the counts of the report."""

    codes: list[str] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    bytes: int = 0
    faults: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0
    first_role: str | None = None
    last_role: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        fault = _fault(text, repeated)
        if fault:
            self.faults[fault] += 1
        if self.last_role is None:
            self.first_role = role[:1]
        elif self.last_role + role[:1] not in _LEGAL:
            self.illegal += 1
        self.last_role = role[:1]
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.codes.append(_code(role, fault))
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return len(self.codes) >= RUN_TURNS or self.bytes >= RUN_BYTES


class Report:
    """The counts of runs put together in order."""

    def __init__(self) -> None:
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.low = self.high = self.last_role = None

    def add(self, run: dict) -> None:
        for name in self.faults:
            self.faults[name] += run["faults"][name]
        self.illegal += run["illegal"]
        if run["last_role"] is not None:
            if self.last_role is not None and self.last_role + run["first_role"] not in _LEGAL:
                self.illegal += 1
            self.last_role = run["last_role"]
        if run["turns"]:
            self.turns += run["turns"] - (run["low"] == self.high)
            self.low = run["low"] if self.low is None else self.low
            self.high = run["high"]

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


class Repair:
    """Applies edits to the turns of a conversation as they come, and digests what stays."""

    def __init__(self, conv_id, cost: int, edits: str, report: Report, with_turns: bool) -> None:
        self.conv_id, self.cost, self.edits, self.report = conv_id, cost, edits, report
        self.with_turns, self.at, self.state = with_turns, 0, "0"
        self.hash, self.empty, self.kept = hashlib.sha256(), True, 0

    def _put(self, edit: str, role: str | None, text: str) -> Iterator[dict]:
        if role is not None:
            # SHA-256 of `role:text`, newline-joined, without holding the turns
            self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False
        if self.with_turns:
            self.kept += 1
            yield {"kind": _TURN, "conv_id": self.conv_id, "place": self.kept, "edit": edit,
                   "role": role, "text": text}

    def _other(self) -> str:
        """The role that an inserted or a reroled turn takes."""
        self.state = "a" if self.state == "u" else "u"
        return _ROLES[self.state]

    def _inserted(self) -> Iterator[dict]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield from self._put("I", self._other(), "")

    def turn(self, role: str, text: str) -> Iterator[dict]:
        yield from self._inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = role[:1]
        yield from self._put(edit, {"D": None, "K": role}.get(edit) if edit != "R" else self._other(), text)

    def finish(self) -> Iterator[dict]:
        yield from self._inserted()
        yield {
            "kind": _REPORT, "conv_id": self.conv_id, "gaps": self.report.gaps, **self.report.faults,
            "illegal": self.report.illegal, "cost": self.cost, "audit": self.edits,
            "repaired_sha256": self.hash.hexdigest(),
        }


_REPORT, _RUN, _OPEN, _TURN = range(4)
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PARTS = (
    "kind int, conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string, slice int, seq bigint, "
    "place bigint, edit string, role string, text string, first_role string, last_role string, "
    "low bigint, high bigint, turns bigint, ends string"
)


class _Out:
    """Rows as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.size = schema, [], 0

    def put(self, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            self.rows.append(row)
            self.size += len(row.get("text") or "") + len(row.get("ends") or "")
            if len(self.rows) >= 1000 or self.size > 1 << 20:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.size = [], 0
        return batch


def _settled(conv_id, run: Run, with_turns: bool) -> Iterator[dict]:
    """A conversation that is one run."""
    chain, report = Chain(), Report()
    chain.ends = follow(chain.ends, "".join(run.codes))
    report.add(vars(run))
    repair = Repair(conv_id, *chain.best(), report, with_turns)
    for role, text in zip(run.roles, run.texts):
        yield from repair.turn(role, text)
    yield from repair.finish()


def _open_run(conv_id, run: Run, number: int, seq: int) -> Iterator[dict]:
    """A run of a conversation that reaches beyond it: what it does, and its turns."""
    yield {
        "kind": _RUN, "conv_id": conv_id, "slice": number, "seq": seq, **run.faults,
        **{name: getattr(run, name) for name in ("illegal", "first_role", "last_role", "low", "high", "turns")},
        "ends": json.dumps(run_table("".join(run.codes))),
    }
    for place, (role, text) in enumerate(zip(run.roles, run.texts)):
        yield {"kind": _OPEN, "conv_id": conv_id, "slice": number, "seq": seq, "place": place,
               "role": role, "text": text}


def _slice_parts(schema: pa.Schema, with_turns: bool):
    """Over a sorted slice: reports of conversations that lie inside it, runs of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seq, out = TaskContext.get().partitionId(), 0, _Out(schema)
        conv, current, whole = None, None, False
        for batch in batches:
            for conv_id, turn, role, text, copies, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or conv_id != conv:
                    if whole:
                        yield from out.put(_settled(conv, current, with_turns))
                    elif current is not None:
                        yield from out.put(_open_run(conv, current, number, seq))
                        seq += 1
                    # the first conversation of a slice may have begun in the one before
                    conv, whole, current = conv_id, current is not None, Run()
                for copy in range(copies):
                    if current.full:
                        yield from out.put(_open_run(conv, current, number, seq))
                        seq, whole, current = seq + 1, False, Run()
                    current.add(turn, role, text, repeated or copy > 0)
        if current is not None:
            # the last one may go on in the next slice
            yield from out.put(_open_run(conv, current, number, seq))
        yield out.flush()

    return run


def _chained(schema: pa.Schema, with_turns: bool):
    """Over the parts of the other conversations, each one's runs in order and then its turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chain, report, repair, conv = _Out(schema), None, None, None, None
        for batch in batches:
            for part in batch.to_pylist():
                if chain is None or part["conv_id"] != conv:
                    if chain is not None:
                        repair = repair or Repair(conv, *chain.best(), report, with_turns)
                        yield from out.put(repair.finish())
                    conv, chain, report, repair = part["conv_id"], Chain(), Report(), None
                if part["kind"] == _RUN:
                    report.add(part | {"faults": {name: part[name] for name in report.faults}})
                    chain.add(json.loads(part["ends"]))
                    continue
                repair = repair or Repair(conv, *chain.best(), report, with_turns)
                yield from out.put(repair.turn(part["role"], part["text"]))
        if chain is not None:
            repair = repair or Repair(conv, *chain.best(), report, with_turns)
            yield from out.put(repair.finish())
        yield out.flush()

    return run


def _repaired(turns: DataFrame, with_turns: bool) -> DataFrame:
    schema = _PARTS.format(id=turns.schema["conv_id"].dataType.simpleString())
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    parts = stored(_sorted_slices(turns).mapInArrow(_slice_parts(arrow, with_turns), schema), "turns")
    beyond = (
        parts.where(F.col("kind").isin(_RUN, _OPEN))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "slice", "seq", "place")
        .mapInArrow(_chained(arrow, with_turns), schema)
    )
    return parts.where(F.col("kind").isin(_REPORT, _TURN)).unionByName(beyond)


def repair(turns: DataFrame) -> DataFrame:
    """One row a conversation of `turns` (conv_id, turn, role, text, copies; see `as_turns`).

    Rows go by turn, nulls first, those of one turn by role and then by the SHA-256 of their text. A
    row's first fault counts: blank (no character but white space), duplicate (role and text occur
    earlier in the conversation), truncated (the last character that is not white space ends no
    sentence). Edits keep a row (0), make it a user's or an assistant's (2), delete it (3) or insert an
    empty turn (2); blank rows and duplicates have to go, a truncated row that stays costs 1. `audit`
    has the initials of the cheapest edits that leave roles of the grammar (s?(ua)+)?, the ASCII-least
    of equal ones. `gaps` counts missing numbers between the least and the greatest turn (nulls do
    not count), `illegal` neighbours whose roles do not follow one another, `repaired_sha256` is of
    `role:text` of the turns left, one a line.

    A conversation without rows (all with copies 0) has zeros, an empty audit and the hash of an empty
    text; a null conv_id is a conversation of its own; an empty table gives no rows. Repeated rows are
    duplicates. Texts of any length count whole. Other columns are not read.
    """
    return _repaired(turns, with_turns=False).where(F.col("kind") == _REPORT).select(
        "conv_id", *_COUNTS, "audit", "repaired_sha256"
    )


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): every turn with its edit, inserted ones too. Deleted ones
    have no role; places count from 1 in a conversation."""
    return _repaired(turns, with_turns=True).where(F.col("kind") == _TURN).select(
        "conv_id", "place", "edit", "role", "text"
    )
