"""Conversation structure repair by alignment with an alternating grammar.

A conversation is sound when its roles' initials read ``(s?(ua)+)?``. Its turns are
aligned with the grammar's string of each feasible length by the Wagner-Fischer
recurrence (keep, rerole, delete, insert), computed only inside the Ukkonen band
that the cheapest alignment so far leaves open; each alignment is traced back to
its least audit, and of all lengths the cheapest wins, then the least audit.

Longer conversations are cut into pieces of PIECE turns. The same alignment is made
for every state of the grammar in which a piece can begin and end; costs are
chained from the last piece back, audits from the first piece on. Inserts always go
in front of the turn that follows, so of two audits of a piece from one state
neither continues the other, and choosing the least piece by piece is exact.

Two passes stream conversations through sorted partitions. The first sees a few
columns of each turn (no texts), holds one byte a turn of one conversation and
gives its audit; copies of a turn are counted before the shuffle. The second holds
one audit and passes texts through.

Order of turns: by ``turn`` (nulls first), then role, then the text's md5. Null
roles and texts count as one space. Faults, the first counting: blank (nothing
but white space), duplicate (role and text seen before in the conversation),
truncated (last character before white space not ``.``, ``!`` or ``?``). A null
``conv_id`` is a conversation of its own. Roles other than the three are kept only
if their first letter fits. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import slices

#: Turns of one alignment; longer conversations are chained.
PIECE = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEVER = 1 << 40
#: States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Classes of a role: its first letter, anything else OTHER. A code is class + 4 * fault.
CLASSES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
OTHER = 0
SOUND, BLANK, DUPLICATE, CUT = range(4)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
SPACE = " \t\n\x0b\x0c\r"


def wanted(state: int) -> int:
    """What an inserted or reroled turn becomes in this state."""
    return ASSISTANT if state == USER else USER


def targets(state: int, length: int) -> list[list[int]]:
    """The grammar's strings of this length from this state, as the states that
    their letters lead to."""
    def turns(at: int, n: int) -> list[int]:
        out = []
        for _ in range(n):
            at = wanted(at)
            out.append(at)
        return out

    out = [turns(state, length)]
    if state == START and length:
        out.append([SYSTEM, *turns(SYSTEM, length - 1)])
    return out


def align(codes: bytes, target: list[int], most: int, tail: bool) -> tuple[int, str] | None:
    """Cheapest edits that turn the coded turns into ``target``, with the least
    audit of that cost; None if they cost over ``most``. Without ``tail``, nothing
    is inserted after the last turn.

    ``cost[i][j]`` is what turns i.. and target j.. cost. A cell is left out when the
    inserts or deletes that its diagonal needs before and after it cost over ``most``.
    """
    n, m = len(codes), len(target)
    shift = lambda by: INSERT * by if by > 0 else -DELETE * by
    width = m + 1
    cost = [[NEVER] * width for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = cost[i], cost[i + 1] if i < n else None
        cls, fault = (codes[i] & 3, codes[i] >> 2) if i < n else (OTHER, SOUND)
        for j in range(m, -1, -1):
            if shift(j - i) + shift((m - j) - (n - i)) > most:
                continue
            if i == n and j == m:
                row[j] = 0
                continue
            best = NEVER
            if i < n:
                best = DELETE + below[j]
                if j < m:
                    best = min(best, _turn(cls, fault, target[j]) + below[j + 1])
            if j < m and target[j] != SYSTEM and (i < n or tail):
                best = min(best, INSERT + row[j + 1])
            row[j] = best
    if cost[0][0] > most or cost[0][0] >= NEVER:
        return None
    # backtrace: D, I, K, R in this order of preference
    i = j = 0
    audit = []
    while i < n or j < m:
        here = cost[i][j]
        if i < n and here == DELETE + cost[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and target[j] != SYSTEM and (i < n or tail) and here == INSERT + cost[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if codes[i] & 3 == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def _turn(cls: int, fault: int, to: int) -> int:
    """Cost of keeping or reroling a turn of this class and fault."""
    if fault in (BLANK, DUPLICATE) or (to == SYSTEM and cls != SYSTEM):
        return NEVER
    return (KEEP if cls == to else REROLE) + (TRUNCATED if fault == CUT else 0)


@lru_cache(maxsize=1 << 15)
def piece(codes: bytes, state: int, tail: bool) -> dict[int, tuple[int, str]]:
    """End state -> (cost, audit) of the best alignment of a piece that begins in
    ``state``, over the strings of every length that can still be best.

    Lengths are tried from the piece's own outwards; a length needs so many inserts or
    deletes that, once these cost more than what was found for every end state,
    farther ones can't win. With ``tail`` (the conversation's last piece) only strings
    after which the grammar may end count, as one end state."""
    n = len(codes)
    best: dict[int | None, tuple[int, str]] = {}
    for away in range(2 * n + 4):
        for length in sorted({n - away, n + away}):
            if length < 0:
                continue
            least = INSERT * (length - n) if length > n else DELETE * (n - length)
            for target in targets(state, length):
                end = target[-1] if target else state
                if tail and end in (SYSTEM, USER):
                    continue
                end = None if tail else end
                most = best[end][0] if end in best else NEVER - 1
                if least <= most and (found := align(codes, target, most, tail)) is not None:
                    best[end] = min(best.get(end, found), found)
        # every shorter string was tried, and longer ones cost more in inserts alone
        if away >= max(n, 2) and all(INSERT * (away + 1) > cost for cost, _ in best.values()):
            break
    return best


def repair_codes(codes: bytes) -> tuple[int, str]:
    """(cost, least audit) of a conversation's turns, given as codes."""
    *parts, last = [codes[i : i + PIECE] for i in range(0, len(codes), PIECE)] or [b""]
    if not parts:
        return piece(last, START, True)[None]
    # what it costs to go on from each state, from the last piece back
    ahead = [{s: piece(last, s, True)[None][0] for s in range(4)}]
    for part in reversed(parts):
        after = ahead[-1]
        ahead.append({s: min(c + after[end] for end, (c, _) in piece(part, s, False).items()) for s in range(4)})
    ahead.reverse()
    state, audits = START, []
    for k, part in enumerate(parts):
        text, state = min(
            (text, end) for end, (c, text) in piece(part, state, False).items()
            if c + ahead[k + 1][end] == ahead[k][state]
        )
        audits.append(text)
    return ahead[0][START], "".join([*audits, piece(last, state, True)[None][1]])


def _prepared(rows: DataFrame, key: str) -> DataFrame:
    """``__key`` (never null, so that null ids stay together), turn, role, text and
    the text's hash, nulls of the last two as one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(
        F.struct(F.col(key).alias("id")).alias("__key"), F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"),
    ).withColumn("hash", F.unhex(F.md5(F.col("text").cast("binary"))))


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("hash")]


def audit(spark: SparkSession, rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row for each conversation in ``rows(key, turn, role, text)``: the key,
    gaps, blank, duplicate, truncated, illegal, cost (longs) and audit.

    ``gaps`` are the turns missing between the least and the largest; the faults count
    by each turn's first; ``illegal`` counts neighbours other than s-u, u-a and a-u."""
    bare = F.btrim("text", F.lit(SPACE))
    slim = _prepared(rows, key).select(
        "__key", "turn", "role", "hash", (F.length(bare) == 0).alias("blank"),
        F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ends"),
    ).groupBy("__key", "turn", "role", "hash", "blank", "ends").agg(F.count(F.lit(1)).alias("copies"))
    same = F.struct("__key", "role", "hash")
    # the least turn with this role and text, null before numbers
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = slim.groupBy(same.alias("__same")).agg(F.min(at).alias("__first"))
    marked = slim.withColumn("__same", same).join(firsts, "__same").select(
        "__key", "turn", "role", "hash", "blank", "ends", "copies", (F.col("__first") == at).alias("first")
    )
    id_field = rows.schema[key]
    schema = T.StructType([
        T.StructField(key, id_field.dataType),
        *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", T.StringType()),
    ])
    id_type = T.StructType([T.StructField("id", id_field.dataType)])
    ordered = marked.repartition("__key").sortWithinPartitions("__key", *_order()).select(
        F.col("__key").cast(id_type).alias("__key"), "turn", F.left("role", F.lit(1)).alias("initial"),
        "blank", "ends", "first", "copies",
    )
    names = schema.fieldNames()

    def look(batches):
        current, state = None, None
        for batch in batches:
            done = []
            keys = batch.column("__key").field("id").to_pylist()
            for k, turn, initial, blank, ends, first, copies in zip(
                keys, *(batch.column(c).to_pylist() for c in ("turn", "initial", "blank", "ends", "first", "copies"))
            ):
                if state is None or k != current:
                    if state is not None:
                        done.append((current, *state.close()))
                    current, state = k, _Turns()
                state.add(turn, initial, blank, ends, first, copies)
            if done:
                yield _batch(done, names, batch.schema.field("__key").type.field("id").type)
        if state is not None:
            yield _batch([(current, *state.close())], names, batch.schema.field("__key").type.field("id").type)

    return ordered.mapInArrow(look, schema)


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, *[pa.int64()] * 6, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


class _Turns:
    """One conversation's turns, as they come: a code each, and what is counted."""

    def __init__(self) -> None:
        self.codes, self.faults = bytearray(), [0, 0, 0, 0]
        self.low = self.high = self.last = None
        self.distinct = self.illegal = 0
        self.before: int | None = None

    def add(self, turn, initial, blank, ends, first, copies) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        cls = CLASSES.get(initial, OTHER)
        fault = BLANK if blank else DUPLICATE if not first else SOUND if ends else CUT
        again = BLANK if blank else DUPLICATE
        self.faults[fault] += 1
        self.faults[again] += copies - 1
        self.codes.append(cls + 4 * fault)
        self.codes += bytes([cls + 4 * again]) * (copies - 1)
        self.illegal += self.before is not None and (self.before, cls) not in LEGAL
        self.illegal += (copies - 1) * ((cls, cls) not in LEGAL)
        self.before = cls

    def close(self) -> tuple[int, int, int, int, int, int, str]:
        gaps = self.high - self.low + 1 - self.distinct if self.low is not None else 0
        cost, text = repair_codes(bytes(self.codes))
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, cost, text


def repaired(spark: SparkSession, rows: DataFrame, audits: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turns of the repaired conversations: the key, ``at`` (from 0), ``edit``
    (K, R or I), ``turn`` (null for inserted ones), role and text. A conversation's
    turns come together and in order, in one partition."""
    turns = _prepared(rows, key).withColumn("audit", F.lit(None).cast("string"))
    heads = audits.select(
        F.struct(F.col(key).alias("id")).alias("__key"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(b"").alias("hash"), "audit",
    )
    id_field = rows.schema[key]
    ordered = (
        turns.unionByName(heads).repartition("__key")
        .sortWithinPartitions("__key", F.col("audit").isNull(), *_order())
        .select("__key", "turn", "role", "text", "audit")
    )
    schema = T.StructType([
        T.StructField(key, id_field.dataType), T.StructField("at", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    names = schema.fieldNames()

    def look(batches):
        edits = None
        for batch in slices(batches):
            ids = batch.column("__key").field("id")
            done = []
            for k, turn, role, text, letters in zip(
                ids.to_pylist(), *(batch.column(c).to_pylist() for c in ("turn", "role", "text", "audit"))
            ):
                if letters is not None:
                    edits = _Edits(k, letters)
                else:
                    edits.take(turn, role, text)
                done += edits.out
                edits.out.clear()
            if done:
                types = [ids.type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return ordered.mapInArrow(look, schema)


class _Edits:
    """Applies one conversation's audit to its turns as they come."""

    def __init__(self, key, letters: str) -> None:
        self.key, self.letters, self.next, self.state, self.at = key, letters, 0, START, 0
        self.out: list[tuple] = []
        self._insert()

    def _emit(self, edit: str, turn, role: str, text: str, state: int) -> None:
        self.out.append((self.key, self.at, edit, turn, role, text))
        self.at, self.state = self.at + 1, state

    def _insert(self) -> None:
        while self.next < len(self.letters) and self.letters[self.next] == "I":
            to = wanted(self.state)
            self._emit("I", None, ROLES[to], "", to)
            self.next += 1

    def take(self, turn, role: str, text: str) -> None:
        edit = self.letters[self.next]
        self.next += 1
        if edit == "K":
            self._emit("K", turn, role, text, CLASSES[role[:1]])
        elif edit == "R":
            to = wanted(self.state)
            self._emit("R", turn, ROLES[to], text, to)
        self._insert()


def digests(spark: SparkSession, turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``repaired_sha256`` of each conversation in the rows of ``repaired``: the
    hash of ``role:text`` lines, taken as they pass."""
    id_field = turns.schema[key]
    schema = T.StructType([T.StructField(key, id_field.dataType), T.StructField("repaired_sha256", T.StringType())])

    def look(batches):
        current, running, id_type = None, None, None
        for batch in slices(batches):
            ids, done = batch.column(key), []
            id_type = ids.type
            for k, at, role, text in zip(ids.to_pylist(), *(batch.column(c).to_pylist() for c in ("at", "role", "text"))):
                if at == 0:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = k, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (id_type, pa.string()))], names=schema.fieldNames())
        if running is not None:
            done = [(current, running.hexdigest())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (id_type, pa.string()))], names=schema.fieldNames())

    return turns.select(key, "at", "role", "text").mapInArrow(look, schema)
