"""Conversation structure repair by lazy weighted determinisation.

Every row of a conversation is one of nine symbols: what must go, or one of four role initials, whole or truncated. The cheapest edits that make the role
initials read `(s?(ua)+)?` are shortest paths through four places of that pattern. Scanned from the last row to the first, the costs to the end from the
four places are a vector; less its minimum there are only a few dozen such vectors, so each becomes a state of an automaton that is built as it is met, and a
row costs one lookup in its transition table. The trace then goes against the scan, from the first row on, along arcs that are tight (an arc's cost
and what lies behind it make up exactly what lies before it), and takes the edit with the least letter among them.

Rows are sorted over the cluster by conversation and turn, in ranges. What lies whole inside a range is repaired as it streams by. A conversation that
crosses ranges or is long goes in chunks: each gives its (min, +) matrix, by the same automaton from four unit vectors; the chunks' matrices are
joined from the end, which gives each chunk the vector behind it; each then traces all four ways in, and a walk over the chunks picks the one taken.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, stash, thrifty

#: A conversation of more rows or bytes goes in chunks of as many.
CHUNK_ROWS = 4096
CHUNK_BYTES = 4 << 20
INF = 1 << 40
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: Places in the pattern: at its start, behind s, behind u, behind a. NEXT is where the one role that a place takes besides s leads.
START, S, U, A = range(4)
NEXT, TAKES = (U, U, A, U), "uuau"
KEEP = ({"s": S, "u": U}, {"u": U}, {"a": A}, {"u": U})
#: Costs to the end where no row is left.
END = (0, 2 * INSERT, INSERT, 0)
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
INK = re.compile("[^\x20\x09-\x0d]")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW_DDL = "pid int, chunk int, idx long, turn long, role string, text string, fault int, seen binary, gone boolean"
FIRST_DDL = f"open boolean, {RESULT_DDL}, {ROW_DDL}"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}
GOOD, BLANK, DUPLICATE, CUT = range(4)


def schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split(" ")[0], _TYPES[c.split(" ")[1]]) for c in ddl.split(", ")])


def damage(conv: int | None, turn: int | None, role: str | None, text: str | None) -> list[tuple[str, str]]:
    """The rows (role, text) that a row becomes, none to two; a null is one space."""
    role, text = " " if role is None else role, " " if text is None else text
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    elif kind == 2:
        text = re.sub("[.!?]", "", text)
    elif kind == 4:
        role = "user"
    return [(role, text)] * (2 if kind == 3 else 1)


def fault(text: str) -> int:
    """What is wrong with a text by itself."""
    last = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1:]
    return BLANK if not last else GOOD if last in ".!?" else CUT


def symbol(role: str, wrong: int) -> int:
    """0 for a row that must go, else 1 to 8 by initial and truncation."""
    if wrong in (BLANK, DUPLICATE):
        return 0
    at = INITIALS.find(role[:1]) if role else -1
    return 1 + 2 * (at if at >= 0 else 3) + (wrong == CUT)


class Automaton:
    """Vectors of costs to the end, less their minimum, as states; transitions are computed when they are first met."""

    def __init__(self) -> None:
        self.ids: dict[tuple[int, ...], int] = {}
        self.vectors: list[tuple[int, ...]] = []
        self.table: list[list[tuple[int, int] | None]] = []

    def state(self, costs: tuple[int, ...]) -> tuple[int, int]:
        """The state of a vector and what was taken off it."""
        least = min(costs)
        vector = tuple(min(c - least, INF) for c in costs)
        if vector not in self.ids:
            self.ids[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.table.append([None] * 9)
        return self.ids[vector], least

    def before(self, costs: tuple[int, ...], sym: int) -> tuple[int, ...]:
        """Costs before a row, from those behind it."""
        out = [DELETE + c for c in costs]
        if sym:
            initial, more = (*INITIALS, "")[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)
            for q in range(4):
                out[q] = min(out[q], REROLE + more + costs[NEXT[q]])
                if initial in KEEP[q]:
                    out[q] = min(out[q], more + costs[KEEP[q][initial]])
        u, a = min(out[U], INSERT + out[A]), min(out[A], INSERT + out[U])
        return min(out[START], INSERT + u), min(out[S], INSERT + u), u, a

    def scan(self, symbols: list[int], behind: tuple[int, ...] = END) -> tuple[list[int], list[int], tuple[int, ...]]:
        """From the last row to the first: the state before each row and behind the last, what each step took off, and the costs before the first row."""
        at, total = self.state(behind)
        states, offs, table = [at], [], self.table
        for sym in reversed(symbols):
            step = table[at][sym]
            if step is None:
                step = table[at][sym] = self.state(self.before(self.vectors[at], sym))
            at, off = step
            states.append(at)
            offs.append(off)
            total += off
        states.reverse()
        offs.reverse()
        return states, offs, tuple(min(c + total, INF) for c in self.vectors[at])

    def trace(self, symbols: list[int], states: list[int], offs: list[int], place: int = START, last: bool = True) -> tuple[str, int]:
        """The least letters along tight arcs from a place before the first row, and the place behind the last row; last: no more rows follow."""
        out, i, n = [], 0, len(symbols)
        while True:
            here = self.vectors[states[i]]
            if i == n:
                if not last or END[place] == 0:
                    return "".join(out), place
                out.append("I")
                place = NEXT[place]
                continue
            have, rest, sym = here[place] + offs[i], self.vectors[states[i + 1]], symbols[i]
            more = TRUNCATED * ((sym - 1) % 2) if sym else 0
            if have == DELETE + rest[place]:
                out.append("D")
                i += 1
            elif here[place] == INSERT + here[NEXT[place]]:
                out.append("I")
                place = NEXT[place]
            else:
                kept = KEEP[place].get((*INITIALS, "")[(sym - 1) // 2]) if sym else None
                if kept is not None and have == more + rest[kept]:
                    out.append("K")
                    place = kept
                else:
                    out.append("R")
                    place = NEXT[place]
                i += 1


def lines(audit: str, rows: list[tuple[str, str]], place: int = START) -> list[str]:
    """role:text of what the edits leave."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            out.append(f"{ROLES[TAKES[place]]}:")
            place = NEXT[place]
            continue
        role, text = rows[i]
        i += 1
        if edit == "R":
            out.append(f"{ROLES[TAKES[place]]}:{text}")
            place = NEXT[place]
        elif edit == "K":
            out.append(f"{role}:{text}")
            place = KEEP[place][role[:1]]
    return out


def tally(turns: list[int | None], roles: list[str], faults: list[int]) -> dict:
    """What a run of rows in order says of itself: counts, turn numbers, initials at its ends."""
    known = [t for t in turns if t is not None]
    steps = sum(a != b for a, b in zip(known, known[1:]))
    return {
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
        "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:])),
        "low": known[0] if known else None, "high": known[-1] if known else None, "distinct": steps + bool(known),
        "first": roles[0][:1] if roles else None, "final": roles[-1][:1] if roles else None,
    }


def joined(parts: list[dict]) -> dict:
    """The tally of runs that follow each other."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "low": None, "high": None, "distinct": 0, "first": None, "final": None}
    for p in parts:
        for k in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            out[k] += p[k]
        if p["first"] is not None:
            out["illegal"] += out["final"] is not None and out["final"] + p["first"] not in LEGAL
            out["first"], out["final"] = p["first"] if out["first"] is None else out["first"], p["final"]
        if p["low"] is not None:
            out["distinct"] -= out["high"] == p["low"]
            out["low"], out["high"] = p["low"] if out["low"] is None else out["low"], p["high"]
    out["gaps"] = 0 if out["low"] is None else out["high"] - out["low"] + 1 - out["distinct"]
    return out


def key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def whole(auto: Automaton, conv: int | None, rows: list[tuple[int | None, str, str]]) -> dict:
    """The result of a conversation from its rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        wrong, k = fault(text), (role, text)
        faults.append(DUPLICATE if wrong != BLANK and k in seen else wrong)
        seen.add(k)
    t = joined([tally([r[0] for r in rows], [r[1] for r in rows], faults)])
    symbols = [symbol(r[1], f) for r, f in zip(rows, faults)]
    states, offs, costs = auto.scan(symbols)
    audit, _ = auto.trace(symbols, states, offs)
    body = "\n".join(lines(audit, [r[1:] for r in rows]))
    return {c: t[c] for c in COUNTS[:-1]} | {"conv_id": conv, "cost": costs[START], "audit": audit, "repaired_sha256": hashlib.sha256(body.encode()).hexdigest()}


def first_pass(batches, chunk_rows: int = CHUNK_ROWS):
    """Sorted rows of a range: results of the conversations that lie whole inside, damaged rows in chunks of the others."""
    auto, form, pid = Automaton(), schema(FIRST_DDL), TaskContext.get().partitionId()
    out: list[dict] = []
    size = idx = chunk = in_chunk = chunk_bytes = 0
    held: list[tuple[int | None, str, str]] = []
    held_bytes, conv, started, streaming = 0, None, False, True

    def put(row: dict, n: int) -> None:
        nonlocal size
        out.append(row)
        size += n + 64

    def opened(rows) -> None:
        nonlocal idx, chunk, in_chunk, chunk_bytes
        for turn, role, text in rows:
            gone = role is None
            if in_chunk >= chunk_rows or chunk_bytes >= CHUNK_BYTES:
                chunk, in_chunk, chunk_bytes = chunk + 1, 0, 0
            n = 0 if gone else len(text)
            put({"open": True, "conv_id": conv, "pid": pid, "chunk": chunk, "idx": idx, "turn": turn, "role": role, "text": text, "fault": None if gone else fault(text), "seen": None if gone else key(role, text), "gone": gone}, n)
            idx, in_chunk, chunk_bytes = idx + 1, in_chunk + 1, chunk_bytes + n

    def flush():
        nonlocal out, size
        if out:
            yield pa.RecordBatch.from_pylist(out, form)
        out, size = [], 0

    def closed() -> None:
        nonlocal chunk, in_chunk, chunk_bytes
        if not streaming:
            put({"open": False, **whole(auto, conv, held)}, 200 + 2 * len(held))
        chunk, in_chunk, chunk_bytes = chunk + 1, 0, 0

    for b in batches:
        for c, turn, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text"))):
            if not started or c != conv:
                if started:
                    closed()
                    streaming = False
                conv, held, held_bytes, started = c, [], 0, True
                if streaming:  # the range's first conversation may have begun in the range before
                    opened([(turn, None, None)])
            rows = [(turn, r, t) for r, t in damage(c, turn, role, text)]
            if not streaming and (held_bytes > CHUNK_BYTES or len(held) >= chunk_rows):
                opened([(None, None, None), *held])
                streaming, held = True, []
            if streaming:
                opened(rows)
            else:
                held += rows
                held_bytes += sum(len(t) for _, _, t in rows)
            if size > CHUNK_BYTES:
                yield from flush()
    if started and not streaming:  # the last one may go on in the next range
        opened([(None, None, None), *held])
    yield from flush()


SUM_DDL = "conv_id long, pid int, chunk int, matrix array<long>, blank long, duplicate long, truncated long, illegal long, low long, high long, distinct long, first string, final string"
VEC_DDL = "conv_id long, pid int, chunk int, head boolean, last boolean, behind array<long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
WAY_DDL = "conv_id long, pid int, chunk int, exits array<int>, audits array<string>"
CHOSEN_DDL = "conv_id long, pid int, chunk int, place int, audit string"
BLOB_DDL = "conv_id long, pid int, chunk int, body binary"


def ordered(t: pa.Table, *by: str) -> list[dict]:
    return t.sort_by([(c, "ascending") for c in by]).to_pylist()


def content(rows: list[dict]) -> tuple[list[dict], list[int], list[int]]:
    """Rows that are there, with faults and symbols."""
    rows = [r for r in rows if not r["gone"]]
    faults = [DUPLICATE if r["again"] and r["fault"] != BLANK else r["fault"] for r in rows]
    return rows, faults, [symbol(r["role"], f) for r, f in zip(rows, faults)]


def chunk_sum(t: pa.Table) -> pa.Table:
    rows = ordered(t, "idx")
    name = {c: rows[0][c] for c in ("conv_id", "pid", "chunk")}
    rows, faults, symbols = content(rows)
    auto = Automaton()
    units = [auto.scan(symbols, tuple(0 if q == to else INF for q in range(4)))[2] for to in range(4)]
    matrix = [units[to][q] for q in range(4) for to in range(4)]
    return pa.Table.from_pylist([{**name, "matrix": matrix, **tally([r["turn"] for r in rows], [r["role"] for r in rows], faults)}], schema(SUM_DDL))


def conversation_costs(t: pa.Table) -> pa.Table:
    """The vector behind each chunk of a conversation, and its counts beside the first one."""
    rows = ordered(t, "pid", "chunk")
    behind, out = END, []
    for r in reversed(rows):
        out.append({**{c: r[c] for c in ("conv_id", "pid", "chunk")}, "head": False, "last": not out, "behind": behind})
        m = r["matrix"]
        behind = tuple(min(min(m[4 * q + to] + behind[to] for to in range(4)), INF) for q in range(4))
    counts = joined(rows)
    out[-1] |= {"head": True, "cost": behind[START], **{c: counts[c] for c in COUNTS[:-1]}}
    return pa.Table.from_pylist(out, schema(VEC_DDL))


def chunk_ways(t: pa.Table, vectors: pa.Table) -> pa.Table:
    rows, vector = ordered(t, "idx"), vectors.to_pylist()[0]
    symbols, auto = content(rows)[2], Automaton()
    states, offs, _ = auto.scan(symbols, tuple(vector["behind"]))
    ways = [auto.trace(symbols, states, offs, q, vector["last"]) for q in range(4)]
    return pa.Table.from_pylist([{**{c: vector[c] for c in ("conv_id", "pid", "chunk")}, "exits": [w[1] for w in ways], "audits": [w[0] for w in ways]}], schema(WAY_DDL))


def chosen_ways(t: pa.Table) -> pa.Table:
    place, out = START, []
    for r in ordered(t, "pid", "chunk"):
        out.append({**{c: r[c] for c in ("conv_id", "pid", "chunk")}, "place": place, "audit": r["audits"][place]})
        place = r["exits"][place]
    return pa.Table.from_pylist(out, schema(CHOSEN_DDL))


def chunk_body(t: pa.Table, ways: pa.Table) -> pa.Table:
    rows, way = ordered(t, "idx"), ways.to_pylist()[0]
    body = "\n".join(lines(way["audit"], [(r["role"], r["text"]) for r in rows if not r["gone"]], way["place"]))
    return pa.Table.from_pylist([{**{c: way[c] for c in ("conv_id", "pid", "chunk")}, "body": body.encode()}], schema(BLOB_DDL))


def hashed(batches):
    """sha256 over the bodies of each conversation's chunks, which come sorted."""
    conv, state, empty, started, out = None, None, True, False, []
    for b in batches:
        for c, body in zip(b.column("conv_id").to_pylist(), b.column("body")):
            if not started or c != conv:
                if started:
                    out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                conv, state, empty, started = c, hashlib.sha256(), True, True
            body = body.as_py()
            if body:
                if not empty:
                    state.update(b"\n")
                state.update(body)
                empty = False
        yield pa.RecordBatch.from_pylist(out, schema("conv_id long, repaired_sha256 string"))
        out = []
    if started:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema("conv_id long, repaired_sha256 string"))


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, nulls first; rows of one turn by a hash of role and text, so repeated rows follow each other and the second is a duplicate. A null
    conversation is a conversation of its own, null roles and texts are one space, an empty role is no role that could stay. A conversation
    of which no row is left has zeros, an empty audit and the hash of nothing. Other columns are not read; an empty table gives no rows.
    A conversation's rows never meet in one task, but for the running hash of the repaired text, which streams in order, and its chunks' small sums.
    """
    spark = turns.sparkSession
    arrow_limits(spark)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    order = ["conv_id", "turn", F.xxhash64(F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" ")))]
    first = stash(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(thrifty(lambda batches: first_pass(batches, chunk_rows)), FIRST_DDL), "turns")
    done = first.where("not open").select(*[c.split(" ")[0] for c in RESULT_DDL.split(", ")])

    parts = first.where("open").select("conv_id", *[c.split(" ")[0] for c in ROW_DDL.split(", ")])
    at = F.struct("pid", "idx")
    again = parts.where("not gone").groupBy("conv_id", "seen").agg(F.min(at).alias("owner"), F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c"), F.col("seen").alias("s"), "owner")
    met = parts.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seen") == F.col("s")), "left")
    parts = stash(met.select(*parts.columns, F.coalesce(at > F.col("owner"), F.lit(False)).alias("again")), "turn-chunks")

    chunk = ["conv_id", "pid", "chunk"]
    costs = stash(parts.groupBy(*chunk).applyInArrow(chunk_sum, SUM_DDL).groupBy("conv_id").applyInArrow(conversation_costs, VEC_DDL), "turn-costs")
    ways = parts.groupBy(*chunk).cogroup(costs.groupBy(*chunk)).applyInArrow(chunk_ways, WAY_DDL)
    chosen = stash(ways.groupBy("conv_id").applyInArrow(chosen_ways, CHOSEN_DDL), "turn-ways")
    bodies = parts.groupBy(*chunk).cogroup(chosen.groupBy(*chunk)).applyInArrow(chunk_body, BLOB_DDL)
    hashes = bodies.repartition("conv_id").sortWithinPartitions(*chunk).mapInArrow(hashed, "conv_id long, repaired_sha256 string")
    audits = chosen.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pid", "chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    total = costs.where("head").select("conv_id", *COUNTS)
    for side in (audits, hashes):
        side = side.withColumnRenamed("conv_id", "c")
        total = total.join(side, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return done.unionByName(total)
