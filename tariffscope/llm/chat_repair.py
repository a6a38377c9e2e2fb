"""Repair of the turn structure of conversations at least cost.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Rows may be kept, given the
role of the user or the assistant, or deleted, and empty rows of both may be inserted; blank rows and rows seen
before must go, rows cut short cost one more where they stay. The cheapest edits are found by dynamic programming
over four states (nothing yet, after the system, the user, the assistant):

* Every row is one of twelve symbols: class of its role and its fault. Equal neighbours collapse to a run.
* A symbol is a min-plus matrix over the states; a run of n is its n-th power, and a vector of costs is taken
  through it by the cached binary powers of the symbol.
* From the costs at the ends of the runs the choices are unrolled forwards, least letter first among equal costs.

Rows are range-partitioned by conversation and turn, so that a conversation of any size is spread over tasks.
Conversations that lie in one partition are repaired there. The one or two at the rim of a partition send one byte for each
row to the task that unrolls them - no more than the audit string that is their result - and their texts, which stay
where they are, are hashed in order as they stream by.

Defined results: nulls in role or text count as one space; rows of a null conversation id form a conversation. Rows
go by turn, nulls first; rows of the same turn by role, then by a digest of the row. Repeated rows are duplicates. A
conversation without rows has zeros, an empty audit and the hash of the empty string; an empty table gives no rows.
Extra columns of the input do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.session import materialize, package_on_workers, shared_dir

#: Text that one partition holds, about.
PART_BYTES = 24 << 20
#: Rows of a run that are unrolled at once.
STRETCH = 4096
WHITE = " \t\n\v\f\r"

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
_FAR = 1 << 60
#: States: nothing yet, system, user, assistant. The role that may be put after each.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
#: Role classes by initial; others cannot be kept. Where a kept row of the class may stand.
_CLASSES = "sua"
_OTHER = 3
_AFTER = ((_START,), (_START, _SYSTEM, _ASSISTANT), (_USER,), ())
#: Faults of a symbol.
FINE, TRUNCATED, MUST_GO = range(3)
_LEGAL = {"su", "ua", "au"}

Vector = tuple[int, int, int, int]


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) after reproducible damage; ``present`` is false where a row was dropped.

    The remainder of the checksum of ``conv_id:turn`` by 20 picks the damage: 0 drops the row, 1 empties its text, 2
    removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    plain = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    present = F.col("kind") != 0
    return plain.select("conv_id", "turn", role.alias("role"), F.when(present, text).otherwise("").alias("text"), present.alias("present"), copies.alias("copy"))


# Costs


@functools.cache
def _steps(symbol: int) -> tuple[tuple[str, int, tuple[int, ...]], ...]:
    """Edits of a row with this symbol, letters ascending: letter, cost, state reached from each state (-1: not allowed)."""
    kind, fault = divmod(symbol, 3)
    stay = (0, 1, 2, 3)
    edits = [("D", DELETE, stay)]
    if fault != MUST_GO:
        extra = CUT_SHORT * (fault == TRUNCATED)
        edits.append(("K", KEEP + extra, tuple(kind + 1 if p in _AFTER[kind] else -1 for p in stay)))
        edits.append(("R", REROLE + extra, _NEXT))
    return tuple(edits)


def _inserting(p: int) -> Iterator[tuple[int, int]]:
    """Cost and state after no, one or two inserted rows; more never pay."""
    for n in range(3):
        yield INSERT * n, p
        p = _NEXT[p]


@functools.cache
def _power(symbol: int, k: int) -> tuple[Vector, ...]:
    """Min-plus matrix of 2^k rows of a symbol: least cost from state to state, inserted rows included."""
    if k:
        half = _power(symbol, k - 1)
        return tuple(tuple(min(half[p][m] + half[m][q] for m in range(4)) for q in range(4)) for p in range(4))
    out = [[_FAR] * 4 for _ in range(4)]
    for p in range(4):
        for before, m in _inserting(p):
            for _, cost, reached in _steps(symbol):
                q = reached[m]
                if q >= 0:
                    out[p][q] = min(out[p][q], before + cost)
    return tuple(map(tuple, out))


@functools.lru_cache(1 << 16)
def _through(symbol: int, n: int, after: Vector) -> Vector:
    """Costs to the end before n rows of a symbol, from the costs after them."""
    k = 0
    while n:
        if n & 1:
            matrix = _power(symbol, k)
            after = tuple(min(matrix[p][q] + after[q] for q in range(4)) for p in range(4))
        n >>= 1
        k += 1
    return after


def costs_before(symbol: int, n: int, after: Vector) -> Vector:
    # vectors that differ by a constant share their cached result
    base = min(after)
    return tuple(x + base for x in _through(symbol, n, tuple(x - base for x in after)))


#: Cost of ending in each state: an open turn is closed by inserted rows, nothing at all is well formed.
AT_END: Vector = (0, 2 * INSERT, INSERT, 0)


def _letters(symbol: int, before: Vector, after: Vector, p: int) -> tuple[str, int]:
    """Edits up to and with the next row, and the state then."""
    out = ""
    due = before[p]
    while True:
        for letter, cost, reached in _steps(symbol):
            if letter > "I" and INSERT + before[_NEXT[p]] == due:
                break
            if reached[p] >= 0 and cost + after[reached[p]] == due:
                return out + letter, reached[p]
        # an inserted row is least of what is left, or the only way on
        out += "I"
        p = _NEXT[p]
        due = before[p]


def repair(symbols: bytes) -> tuple[int, list[str]]:
    """Least cost, and the edits at each row: inserted rows before it and its own; one more entry for the end."""
    values = np.frombuffer(symbols, np.uint8)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    runs = list(zip(values[starts].tolist(), np.diff(np.r_[starts, len(values)]).tolist(), strict=True))
    ends = [AT_END]
    for symbol, n in reversed(runs):
        ends.append(costs_before(symbol, n, ends[-1]))
    cost = ends[-1][_START]
    p, edits = _START, []
    for (symbol, n), after in zip(runs, reversed(ends[:-1]), strict=True):
        while n:
            size = min(n, STRETCH)
            n -= size
            ahead = [costs_before(symbol, n, after)]
            for _ in range(size):
                ahead.append(costs_before(symbol, 1, ahead[-1]))
            for i in range(size, 0, -1):
                letters, p = _letters(symbol, ahead[i], ahead[i - 1], p)
                edits.append(letters)
    edits.append("I" * {_SYSTEM: 2, _USER: 1}.get(p, 0))
    return cost, edits


def rewritten(edits: list[str], state: int, roles: list[str], texts: list[str]) -> tuple[list[str], int]:
    """The rows after the edits as ``role:text``, and the state after them. The last entry of edits may have no row."""
    out = []
    for i, letters in enumerate(edits):
        for letter in letters:
            if letter == "K":
                state = _CLASSES.index(roles[i][0]) + 1
                out.append(f"{roles[i]}:{texts[i]}")
            elif letter != "D":
                state = _NEXT[state]
                out.append(f"{_NAMES[state]}:{texts[i] if letter == 'R' else ''}")
    return out, state


# Conversations

_COUNTERS = ("blank", "duplicate", "truncated", "illegal")
RESULT = ("gaps", *_COUNTERS, "cost")


def _symbol(role: str, fault: int) -> int:
    kind = _CLASSES.find(role[:1]) if role else -1
    return 3 * (kind if kind >= 0 else _OTHER) + fault


class _Rows:
    """The rows of one conversation in one partition, in order."""

    def __init__(self, turns: list, roles: list[str], texts: list[str], repeated: list[bool]):
        self.roles, self.texts = roles, texts
        self.counts = dict.fromkeys(_COUNTERS, 0)
        symbols = bytearray()
        for role, text, again in zip(roles, texts, repeated, strict=True):
            end = text.rstrip(WHITE)[-1:]
            fault = "blank" if not end else "duplicate" if again else "truncated" if end not in ".!?" else ""
            if fault:
                self.counts[fault] += 1
            symbols.append(_symbol(role, {"": FINE, "truncated": TRUNCATED}.get(fault, MUST_GO)))
        self.symbols = bytes(symbols)
        self.initials = (roles[0][:1], roles[-1][:1]) if roles else ("", "")
        self.counts["illegal"] = sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))
        known = sorted({t for t in turns if t is not None})
        self.turns = (known[0], known[-1], len(known)) if known else (None, None, 0)


def _gaps(first: int | None, last: int | None, distinct: int) -> int:
    return last - first + 1 - distinct if distinct else 0


def _done(rows: _Rows) -> dict:
    cost, edits = repair(rows.symbols)
    out, _ = rewritten(edits, _START, rows.roles, rows.texts)
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return {"gaps": _gaps(*rows.turns), **rows.counts, "cost": cost, "audit": "".join(edits), "repaired_sha256": digest}


_OUT = pa.schema([*((c, pa.int64()) for c in RESULT), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_RIM = pa.schema(
    [("symbols", pa.binary()), ("first_initial", pa.string()), ("last_initial", pa.string())]
    + [(c, pa.int64()) for c in ("first_turn", "last_turn", "n_turns")]
)
_PIECE = pa.schema([*((c, pa.int64()) for c in RESULT), ("audit", pa.string()), ("state", pa.int32()), ("edits", pa.list_(pa.string()))])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _table(rows: list[dict], conv_type: pa.DataType, schema: pa.Schema, part: bool = True) -> pa.Table:
    fields = [pa.field("conv_id", conv_type), *([pa.field("part", pa.int32())] if part else []), *schema]
    return pa.Table.from_pylist(rows, pa.schema(fields))


def _conversations(table: pa.Table, repeats: set[int]) -> Iterator[tuple[object, bool, list]]:
    """Conversations of a partition in order: id, whether it is the first or the last, (turn, role, text, repeated) rows."""
    columns = [table.column(c).to_pylist() for c in ("conv_id", "at", "turn", "role", "text", "present")]
    order = np.argsort(np.asarray(columns[1]), kind="stable").tolist()
    convs = [(k, list(g)) for k, g in groupby(order, key=columns[0].__getitem__)]
    for i, (conv, places) in enumerate(convs):
        rows = [(columns[2][j], columns[3][j], columns[4][j], columns[1][j] in repeats) for j in places if columns[5][j]]
        yield conv, i in (0, len(convs) - 1), rows


def _in_partition(key: tuple, table: pa.Table, repeats: pa.Table) -> pa.Table:
    """Whole conversations repaired; those at the rim as symbols, for another partition may have the rest."""
    again = set(repeats.column("at").to_pylist())
    out = []
    for conv, at_rim, rows in _conversations(table, again):
        own = _Rows(*map(list, zip(*rows, strict=True))) if rows else _Rows([], [], [], [])
        row = {"conv_id": conv, "part": key[0].as_py()}
        if at_rim:
            names = ("first_turn", "last_turn", "n_turns")
            row |= {"symbols": own.symbols, "first_initial": own.initials[0], "last_initial": own.initials[1], **own.counts}
            row |= dict(zip(names, own.turns, strict=True))
        else:
            row |= _done(own)
        out.append(row)
    return _table(out, table.schema.field("conv_id").type, pa.schema([*_OUT, *_RIM]))


def _across(table: pa.Table) -> pa.Table:
    """A conversation from all its partitions: totals with the first of them, the edits of each with its own rows."""
    segments = sorted(table.to_pylist(), key=lambda s: s["part"])
    cost, edits = repair(b"".join(s["symbols"] for s in segments))
    totals = dict.fromkeys(_COUNTERS, 0)
    distinct, first, last, initial = 0, None, None, ""
    for s in segments:
        for c in _COUNTERS:
            totals[c] += s[c]
        if s["symbols"]:
            totals["illegal"] += bool(initial) and initial + s["first_initial"] not in _LEGAL
            initial = s["last_initial"]
        if s["n_turns"]:
            distinct += s["n_turns"] - (last is not None and last == s["first_turn"])
            first, last = s["first_turn"] if first is None else first, s["last_turn"]
    roles = [_CLASSES[x // 3] if x // 3 < _OTHER else "" for s in segments for x in s["symbols"]]
    state, at, out = _START, 0, []
    for i, s in enumerate(segments):
        upto = at + len(s["symbols"])
        own = edits[at:] if i == len(segments) - 1 else edits[at:upto]
        row = {"conv_id": s["conv_id"], "part": s["part"], "state": state, "edits": own}
        if not i:
            row |= {"gaps": _gaps(first, last, distinct), **totals, "cost": cost, "audit": "".join(edits)}
        out.append(row)
        _, state = rewritten(own, state, [*roles[at:upto], ""], [""] * (len(own) + 1))
        at = upto
    return _table(out, table.schema.field("conv_id").type, _PIECE)


def _texts(key: tuple, table: pa.Table, pieces: pa.Table) -> pa.Table:
    """The repaired rows of the conversations at the rim, as one text for each."""
    wanted = {p["conv_id"]: p for p in pieces.to_pylist()}
    out = []
    for conv, at_rim, rows in _conversations(table, set()):
        if at_rim:
            p = wanted[conv]
            lines, _ = rewritten(p["edits"], p["state"], [r[1] for r in rows], [r[2] for r in rows] + [""])
            row = {c: p[c] for c in ("conv_id", "part", *RESULT, "audit")}
            out.append(row | {"lines": len(lines), "body": "\n".join(lines).encode()})
    schema = pa.schema([*((c, pa.int64()) for c in RESULT), ("audit", pa.string()), ("lines", pa.int64()), ("body", pa.binary())])
    return _table(out, table.schema.field("conv_id").type, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions' texts of a conversation come one after the other and go into one hash."""
    held, digest, started = None, hashlib.sha256(), False
    conv_type = pa.null()

    def finished() -> pa.RecordBatch:
        row = {c: held[c] for c in ("conv_id", *RESULT, "audit")} | {"repaired_sha256": digest.hexdigest()}
        return _table([row], conv_type, _OUT, part=False).to_batches()[0]

    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if held is None or held["conv_id"] != row["conv_id"]:
                if held is not None:
                    yield finished()
                held, digest, started = row, hashlib.sha256(), False
            if row["lines"]:
                digest.update(b"\n" + row["body"] if started else row["body"])
                started = True
    if held is not None:
        yield finished()


def _placed(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn, as a table with one bucket for each range of them.

    The partition number is the bucket, so that grouping by it later leaves the texts where they are. A number of the
    row breaks ties last, so that many equal rows are no hot key.
    """
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # no fewer than the shuffle partitions, or grouping would rather move the rows
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    keyed = rows.withColumn("key", F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256)).withColumn("tie", F.monotonically_increasing_id())
    by = ("conv_id", "turn", "role", "key", "tie")
    ranged = keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    name = f"turns_{uuid.uuid4().hex}"
    (
        ranged.select("conv_id", "turn", "role", "text", "present", "key")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id())
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", f"{shared_dir(spark)}/{name}")
        .bucketBy(parts, "part")
        .sortBy("at")
        .saveAsTable(name)
    )
    placed = spark.table(name)
    # the files stay for the plans that read them; the catalog keeps no entry
    spark.sql(f"DROP TABLE {name}")
    return placed


def repaired(rows: DataFrame) -> DataFrame:
    """Cheapest repair of every conversation of rows as ``damaged`` gives them (conv_id, turn, role, text, present).

    Returns one row per conv_id: gaps in the turns, counts of blank, duplicate, truncated rows and of illegal neighbours,
    cost, audit (the edits' letters) and repaired_sha256.
    """
    package_on_workers(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType.simpleString()
    placed = _placed(rows)
    keys = placed.where("present").select("key", "at", "part")
    # the first of equal rows by a combined aggregate; no key is gathered
    first = keys.groupBy("key").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).where("n > 1")
    repeats = materialize(keys.join(first, "key").where("at > first_at").select("part", "at"), "repeated_turns")
    texts = placed.drop("key")
    found = materialize(
        texts.groupBy("part")
        .cogroup(repeats.groupBy("part"))
        .applyInArrow(_in_partition, f"conv_id {conv}, part int, {_ddl(_OUT)}, {_ddl(_RIM)}"),
        "repaired_turns",
    )
    names = ("conv_id", *_OUT.names)
    whole = found.where("symbols is null").select(*names)
    rims = found.where("symbols is not null").select("conv_id", "part", *_COUNTERS, *_RIM.names)
    pieces = materialize(rims.groupBy("conv_id").applyInArrow(_across, f"conv_id {conv}, part int, {_ddl(_PIECE)}"), "repair_edits")
    bodies = (
        texts.groupBy("part")
        .cogroup(pieces.groupBy("part"))
        .applyInArrow(_texts, f"conv_id {conv}, part int, {_ddl(pa.schema([*_OUT][:-1]))}, lines bigint, body binary")
    )
    joined = bodies.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(joined.mapInArrow(_hashed, f"conv_id {conv}, {_ddl(_OUT)}"))
