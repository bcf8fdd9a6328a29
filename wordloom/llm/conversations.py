"""Repair of the structure of conversations by a checkpointed program (operator 12).

The cheapest edits that turn the roles of a conversation into ``(s?(ua)+)?`` are
found by dynamic programming over its rows in turn order. States say what came
last: nothing, a system row, a user or an assistant. A backward pass makes, for
every row, the vector of the cost of each state, and keeps one vector in about
sqrt(n); the walk forward makes the vectors of one block again from the next
checkpoint and takes at each place the ASCII-least edit that is tight. Vectors
are kept relative to their least entry, so few distinct ones occur and a step is
a lookup.

What the program needs of a row is one byte: the class of its role and its
fault. Faults are found in Spark: copies of a row are added up before the
shuffle, and the first of the equal rows of a conversation is a minimum, joined
back on a key of its own. Rows are then sorted by range, so a long conversation
is spread over tasks and arrives as one value of bytes per task. Texts are
shuffled once and streamed past the edits, since a digest of a conversation has
to see it in order; no task holds the texts of a conversation.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import pairwise
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import shuffle_partitions

# Classes of roles by their first letter, and faults. A code is class + 4 * fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
# States: what came last. FOLLOWING is the state after the role that may come next.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
FOLLOWING = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
KEPT = {(START, SYSTEM): AFTER_SYSTEM, (START, USER): AFTER_USER,
        (AFTER_SYSTEM, USER): AFTER_USER, (AFTER_ASSISTANT, USER): AFTER_USER,
        (AFTER_USER, ASSISTANT): AFTER_ASSISTANT}
NAMES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
# Costs of the edits. Fixed values.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
_NEVER = 1 << 60
SEGMENT_ROWS = 1 << 20

Vector = tuple[int, int, int, int]

SEGMENTS = ("conv_id bigint, turn bigint, role string, digest binary, codes binary, "
            "low bigint, high bigint, turns bigint")
_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("digest", pa.binary()), ("codes", pa.binary()), ("low", pa.int64()),
    ("high", pa.int64()), ("turns", pa.int64())])
AUDITS = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint, cost bigint, audit string, repaired_sha256 string")
_AUDITS = pa.schema([
    ("conv_id", pa.int64()), *((c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string())])
TURNS = "conv_id bigint, position bigint, edit string, role string, text string"
_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()),
                    ("role", pa.string()), ("text", pa.string())])


# --- the program -------------------------------------------------------------


def _with_inserts(b: list[int]) -> Vector:
    """The least costs when missing rows may be put in first."""
    user, assistant = b[AFTER_USER], b[AFTER_ASSISTANT]
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return (min(b[START], INSERT + user), min(b[AFTER_SYSTEM], INSERT + user), user, assistant)


END = _with_inserts([0, _NEVER, _NEVER, 0])


def _costs(code: int, after: Vector) -> Vector:
    """Costs before a row, given those after it."""
    role, fault = code & 3, code >> 2
    best = [DELETE + c for c in after]
    if fault < BLANK:
        extra = CUT_OFF if fault == TRUNCATED else 0
        for state in range(4):
            best[state] = min(best[state], extra + REROLE + after[FOLLOWING[state]])
            if (state, role) in KEPT:
                best[state] = min(best[state], extra + after[KEPT[state, role]])
    return _with_inserts(best)


@functools.cache
def before(code: int, after: Vector) -> tuple[Vector, int]:
    """Costs before a row less their minimum, and that minimum, given those after it."""
    costs = _costs(code, after)
    least = min(costs)
    return tuple(c - least for c in costs), least


@functools.cache
def edits(code: int, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least tight edits that use up a row, and the state after them."""
    costs, letters = _costs(code, after), ""
    role, fault = code & 3, code >> 2
    extra = CUT_OFF if fault == TRUNCATED else 0
    while True:
        want, following = costs[state], FOLLOWING[state]
        if DELETE + after[state] == want:
            return letters + "D", state
        if INSERT + costs[following] == want:
            letters, state = letters + "I", following
        elif (state, role) in KEPT and extra + after[KEPT[state, role]] == want:
            return letters + "K", KEPT[state, role]
        else:
            return letters + "R", following


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the ASCII-least of the cheapest edits.

    Keeps one vector for about sqrt(n) rows and the vectors of one block.
    """
    n = len(codes)
    step = isqrt(n) + 1
    vector, cost, checkpoints = END, 0, {}
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i + 1 == n:
            checkpoints[i + 1] = vector
        vector, least = before(codes[i], vector)
        cost += least
    cost += vector[START]
    letters, state = [], START
    for first in range(0, n, step):
        last = min(first + step, n)
        block = [checkpoints[last]]
        for i in range(last - 1, first, -1):
            block.append(before(codes[i], block[-1])[0])
        for i in range(first, last):
            found, state = edits(codes[i], state, block.pop())
            letters.append(found)
    while END[state]:
        letters.append("I")
        state = FOLLOWING[state]
    return cost, "".join(letters)


# --- rows to segments --------------------------------------------------------


def _digest() -> Column:
    parts = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return F.unhex(F.sha2(parts, 256)).alias("digest")


def _code() -> Column:
    """Class of the role and fault of a row, as far as the row alone tells."""
    initial = F.left("role", F.lit(1))
    role = (F.when(initial == "s", SYSTEM).when(initial == "u", USER)
            .when(initial == "a", ASSISTANT).otherwise(OTHER))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(FINE))
    return (role + 4 * fault).alias("code")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SEGMENTS: the codes of a conversation's rows, from rows in order."""
    current, rows = None, []

    def done() -> tuple:
        conv_id, turn, role, digest, codes, low, high, turns = current
        return conv_id, turn, role, digest, bytes(codes), low, high, turns

    def batch_of() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SEGMENTS)],
                               schema=_SEGMENTS)

    for batch in batches:
        names = ("conv_id", "turn", "role", "digest", "code", "copies", "first")
        for conv_id, turn, role, digest, code, copies, first in zip(
                *(batch.column(c).to_pylist() for c in names), strict=True):
            if current is None or current[0] != conv_id or len(current[4]) >= SEGMENT_ROWS:
                if current is not None:
                    rows.append(done())
                current = [conv_id, turn, role, digest, bytearray(), None, None, 0]
            if not copies:
                continue
            again = code if code >> 2 == BLANK else code & 3 | DUPLICATE << 2
            current[4].append(code if first else again)
            current[4].extend(bytes([again]) * (copies - 1))
            if turn is not None and turn != current[6]:
                current[5] = turn if current[5] is None else current[5]
                current[6], current[7] = turn, current[7] + 1
        if rows:
            yield batch_of()
            rows = []
    if current is not None:
        rows.append(done())
        yield batch_of()


def segments(rows: DataFrame) -> DataFrame:
    """SEGMENTS of rows with conv_id, turn, role, digest, code and copies."""
    alike = rows.groupBy("conv_id", "digest", "turn").agg(
        F.min("role").alias("role"), F.min("code").alias("code"), F.sum("copies").alias("copies")
    )
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("least")
    firsts = alike.where("copies > 0").groupBy("conv_id", "digest").agg(earliest).select(
        F.col("conv_id").alias("of_conv"), F.col("digest").alias("of_digest"),
        F.col("least.turn").alias("of_turn"), F.lit(True).alias("first"),
    )
    same = (F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("digest") == F.col("of_digest"))
            & F.col("turn").eqNullSafe(F.col("of_turn")))
    order = ["conv_id", "turn", "role", "digest"]
    flagged = alike.join(firsts, same, "left").select(
        *order, "code", "copies", F.coalesce("first", F.lit(False)).alias("first"))
    parts = shuffle_partitions(rows.sparkSession)
    ordered = flagged.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ordered.mapInArrow(_segments, SEGMENTS)


# --- repair ------------------------------------------------------------------


class _Repair:
    """One conversation as it streams by: its segments, then its rows."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.codes = conv_id, bytearray()
        self.low = self.high = self.audit = None
        self.turns = self.at = self.at_row = self.position = 0
        self.state = START

    def add(self, codes: bytes, low: int | None, high: int | None, turns: int) -> None:
        self.codes += codes
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def plan(self) -> None:
        faults = [c >> 2 for c in self.codes]
        self.faults = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        self.illegal = sum((a & 3, b & 3) not in LEGAL for a, b in pairwise(self.codes))
        self.gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        self.cost, self.audit = cheapest_edits(bytes(self.codes))

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = FOLLOWING[self.state]
            self.at += 1
            yield "I", NAMES[self.state], ""

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what becomes of a row and of the inserts before it."""
        if self.audit is None:
            self.plan()
        for _ in range(copies):
            yield from self._inserted()
            code, letter = self.codes[self.at_row], self.audit[self.at]
            self.at += 1
            self.at_row += 1
            if letter == "K":
                self.state = KEPT[self.state, code & 3]
                yield letter, role, text
            elif letter == "R":
                self.state = FOLLOWING[self.state]
                yield letter, NAMES[self.state], text

    def finish(self) -> Iterator[tuple[str, str, str]]:
        if self.audit is None:
            self.plan()
        yield from self._inserted()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Repair, tuple | None]]:
    """Repaired rows in order; after the last of a conversation comes a None."""
    current = None
    names = ("conv_id", "role", "codes", "low", "high", "turns", "text", "copies")
    for batch in batches:
        for conv_id, role, codes, low, high, turns, text, copies in zip(
                *(batch.column(c).to_pylist() for c in names), strict=True):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    for turn in current.finish():
                        yield current, turn
                    yield current, None
                current = _Repair(conv_id)
            if codes is not None:
                current.add(codes, low, high, turns)
            else:
                for turn in current.row(role, text, copies):
                    yield current, turn
    if current is not None:
        for turn in current.finish():
            yield current, turn
        yield current, None


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded weight."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)],
                               schema=schema)

    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= 1 << 22:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        digest, glue = hashlib.sha256(), ""
        for repair, turn in _stream(batches):
            if turn is not None:
                digest.update(f"{glue}{turn[1]}:{turn[2]}".encode())
                glue = "\n"
                continue
            yield (repair.conv_id, repair.gaps, *repair.faults, repair.illegal, repair.cost,
                   repair.audit, digest.hexdigest())
            digest, glue = hashlib.sha256(), ""

    yield from _batches(rows(), _AUDITS, lambda row: 500 + len(row[7]))


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for repair, turn in _stream(batches):
            if turn is not None:
                yield (repair.conv_id, repair.position, *turn)
                repair.position += 1

    yield from _batches(rows(), _TURNS, lambda row: 100 + len(row[4]))


def _streamed(rows: DataFrame, consume, schema: str) -> DataFrame:
    """``consume`` over the conversations of each task: segments first, then rows, in order."""
    parts = rows.select("conv_id", "turn", "role", "digest", "text", "copies").where("copies > 0")
    codes = segments(rows.select("conv_id", "turn", "role", "digest", _code(), "copies"))
    empty = lambda *names: {c: F.lit(None).cast(t) for c, t in names}
    both = codes.withColumns(empty(("text", "string"), ("copies", "int"))).unionByName(
        parts.withColumns(empty(("codes", "binary"), ("low", "bigint"), ("high", "bigint"),
                                ("turns", "bigint"))))
    whole = both.withColumn("is_row", F.col("codes").isNull()).repartition(
        shuffle_partitions(rows.sparkSession), "conv_id")
    return whole.sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest").mapInArrow(
        consume, schema)


def _rows(conversations: DataFrame, columns: dict[str, str], copies: str | None) -> DataFrame:
    column = lambda name: conversations[columns.get(name, name)]
    words = lambda name: F.coalesce(column(name).cast("string"), F.lit(" ")).alias(name)
    return conversations.select(
        column("conv_id").cast("bigint").alias("conv_id"), column("turn").cast("bigint").alias("turn"),
        words("role"), words("text"),
        (F.lit(1) if copies is None else conversations[copies].cast("int")).alias("copies"),
    ).withColumn("digest", _digest())


def audited(
    conversations: DataFrame, *, columns: dict[str, str] | None = None, copies: str | None = None
) -> DataFrame:
    """AUDITS: faults, cheapest edits and digest of the repaired rows, for each conversation.

    Rows are taken by turn, null turns first, then by role and by the digest of
    role and text. Null roles and texts are one blank; null conversation ids are
    one conversation. A row whose role has no first letter cannot be kept as it
    is. ``columns`` maps conv_id, turn, role and text to other names; other
    columns are not looked at. ``copies`` names a column with the number of times
    a row stands there; rows with 0 are missing, but their conversation is
    reported, with zeros, no edits and the digest of nothing if it has no other.
    Repeated rows are duplicates; an empty table gives no rows. A conversation may
    be of any length; one task holds a byte and a letter of each of its rows.
    """
    return _streamed(_rows(conversations, columns or {}, copies), _audits, AUDITS)


def repaired(
    conversations: DataFrame, *, columns: dict[str, str] | None = None, copies: str | None = None
) -> DataFrame:
    """TURNS: the rows of the repaired conversations; arguments as in ``audited``.

    ``position`` counts from 0, ``edit`` is K, R or I. Conversations of which
    nothing is left have no rows.
    """
    return _streamed(_rows(conversations, columns or {}, copies), _turns, TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` with the faults that the rows' hash names.

    crc32 of ``conv_id:turn`` (a null is a blank) modulo 20: 0 the row is missing,
    1 its text is empty, 2 it has no marks that end a sentence, 3 it is there
    twice, 4 its role is user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"),
    )
    key = F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")
    rows = rows.withColumn("damage", F.crc32(key) % 20)
    damage = F.col("damage")
    return rows.select(
        "conv_id", "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1).alias("copies"),
    )
