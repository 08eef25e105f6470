"""Conversations brought to a legal order of turns by the cheapest edits, with an audit of them.

The edit lattice has a node for each place between rows and each state of the order
``(s?(ua)+)?``; keeping, reroling, deleting and inserting are its edges. The cheapest path is
found by Dijkstra from both ends. Rows are sorted by conversation over range partitions; a long
conversation is cut in pieces, whose paths between any two states are found apart and then joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import NO_ID, SPACES, id_key, rows_of
from tidepanel.operators.ordering import with_entity_index
from tidepanel.session import write_table

PIECE_ROWS, FAN = 512, 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# What a new or reroled row becomes in each state of the order: nothing yet, s, u, a.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
BEFORE = {s: [q for q in STATES if NEXT[q] == s] for s in STATES}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
LEGAL = {"su", "ua", "au"}
# Only u or ua are missing at the end of a conversation in these states.
CLOSING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
FAR = 1 << 60
FAULTS = BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"

Row = tuple[str, bool, int]  # initial of the role, has to go, what leaving it costs


def fault_of(text: str, seen: bool) -> str | None:
    """The first fault of a row; ``seen`` tells whether its role and text came before."""
    bare = text.strip(SPACES)
    return BLANK if not bare else DUPLICATE if seen else None if bare[-1] in ".!?" else CUT


def keeps(initial: str, state: int) -> int | None:
    """The state after a row of that role is kept."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    return NEXT[state] if INITIAL[NEXT[state]] == initial else None


def _onward(rows: list[Row], closing: bool, at: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    if at < len(rows):
        initial, must_go, extra = rows[at]
        yield DELETE, "D", at + 1, state
        if not must_go:
            yield REROLE + extra, "R", at + 1, NEXT[state]
            kept = keeps(initial, state)
            if kept is not None:
                yield KEEP + extra, "K", at + 1, kept
    if at < len(rows) or closing:
        yield INSERT, "I", at, NEXT[state]


def _backward(rows: list[Row], closing: bool, at: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    if at:
        initial, must_go, extra = rows[at - 1]
        yield DELETE, "D", at - 1, state
        if not must_go:
            for before in BEFORE[state]:
                yield REROLE + extra, "R", at - 1, before
            for before in STATES:
                if keeps(initial, before) == state:
                    yield KEEP + extra, "K", at - 1, before
    if at < len(rows) or closing:
        for before in BEFORE[state]:
            yield INSERT, "I", at, before


def cheapest(rows: list[Row], begin: int, ends: list[int], closing: bool = True) -> tuple[int, str] | None:
    """Cost and least audit from state ``begin`` to one of ``ends``; without ``closing`` nothing is
    inserted behind the last row.

    Each side settles nodes by cost, then by rows passed: edges without cost pass a row, so a
    settled node has its least audit. Audits to one node are never prefixes of each other, so
    least parts join to a least whole. The search goes on while the sum of both heaps' least costs
    does not exceed the best crossing: by then every path of that cost crosses an edge between a node
    settled from the front and one settled from behind.
    """
    last = len(rows)
    sides = ({}, {})
    known = ({(0, begin): (0, "")}, {(last, e): (0, "") for e in ends})
    heaps = ([(0, 0, "", begin)], [(0, 0, "", e) for e in sorted(ends)])
    best = (FAR, "")
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else FAR for h in heaps]
        if tops[0] + tops[1] > best[0]:
            break
        side = 0 if tops[0] <= tops[1] else 1
        cost, passed, audit, state = heappop(heaps[side])
        at = passed if side == 0 else last - passed
        if (at, state) in sides[side]:
            continue
        sides[side][at, state] = (cost, audit)
        there = sides[1 - side]
        if (at, state) in there:
            met = there[at, state]
            best = min(best, (cost + met[0], audit + met[1] if side == 0 else met[1] + audit))
        for price, edit, to, then in (_backward if side else _onward)(rows, closing, at, state):
            longer = (cost + price, edit + audit if side else audit + edit)
            met = there.get((to, then))
            if met and longer[0] + met[0] <= best[0]:
                best = min(best, (longer[0] + met[0], met[1] + longer[1] if side else longer[1] + met[1]))
            if (to, then) not in sides[side] and longer < known[side].get((to, then), (FAR, "")):
                known[side][to, then] = longer
                heappush(heaps[side], (longer[0], last - to if side else to, longer[1], then))
    return best if best[0] < FAR else None


def edited(roles: list[str], texts: list[str], audit: str, state: int = NOTHING) -> tuple[list[str], list[str]]:
    """The rows after the edits of an audit that starts in ``state``."""
    out, at = ([], []), 0
    for edit in audit:
        if edit == "K":
            state = keeps(roles[at][:1], state)
            row = (roles[at], texts[at])
        elif edit != "D":
            state = NEXT[state]
            row = (ROLE[state], texts[at] if edit == "R" else "")
        if edit != "D":
            out[0].append(row[0])
            out[1].append(row[1])
        at += edit != "I"
    return out


# --- pieces of long conversations ----------------------------------------------------------------

def between(rows: list[Row]) -> tuple[list[int], list[str], list[int]]:
    """For each pair of states: the cost of the piece (-1: no way), its audit, and the audit's place
    among those from the same state."""
    found = [cheapest(rows, q, [e], closing=False) for q in STATES for e in STATES]
    costs, audits = [f[0] if f else -1 for f in found], [f[1] if f else "" for f in found]
    places = [sorted(a for a, c in zip(audits[4 * q : 4 * q + 4], costs[4 * q : 4 * q + 4]) if c >= 0) for q in STATES]
    return costs, audits, [places[i // 4].index(a) if costs[i] >= 0 else -1 for i, a in enumerate(audits)]


def route(pieces: list[tuple[list[int], list[int]]], begin: int, end: int) -> tuple[int, list[int]] | None:
    """The cheapest states behind each piece in turn (cost, states). Audits of a piece from one state
    to different ones differ and none is a prefix of another: their places break ties."""
    rest, choice = {end: 0}, []
    for costs, places in reversed(pieces):
        step = {}
        for q in STATES:
            ways = [(costs[4 * q + e] + rest[e], places[4 * q + e], e) for e in rest if costs[4 * q + e] >= 0]
            if ways:
                step[q] = min(ways)
        rest = {q: way[0] for q, way in step.items()}
        choice.append({q: way[2] for q, way in step.items()})
    if begin not in rest:
        return None
    states, q = [], begin
    for step in reversed(choice):
        q = step[q]
        states.append(q)
    return rest[begin], states


def joined(pieces: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """Costs and places of a run of pieces, as :func:`between` gives them for one."""
    costs, places = [], []
    for q in STATES:
        found = [route(pieces, q, e) for e in STATES]
        order = {}
        for e, f in enumerate(found):
            if f:
                # The first piece that differs decides; before it the states are the same.
                way = [q, *f[1]]
                order[e] = [p[1][4 * a + b] for p, a, b in zip(pieces, way, way[1:])]
        ranked = sorted(order, key=order.get)
        costs += [f[0] if f else -1 for f in found]
        places += [ranked.index(e) if e in order else -1 for e in STATES]
    return costs, places


# --- over tables ----------------------------------------------------------------------------------

COUNTS = ("blank", "duplicate", "truncated", "illegal")
_STATS = "first_turn long, last_turn long, turns long, first_role string, last_role string, " + ", ".join(f"{c} long" for c in COUNTS)
_PIECE = f"cid long, bucket int, k long, whole boolean, n int, {_STATS}, cost long, audit string, roles array<string>, texts array<string>, keys array<binary>"
_SOLVED = f"cid long, bucket int, k long, {_STATS}, costs array<long>, places array<int>, audits array<string>, roles array<string>, texts array<string>"
_LEVEL = f"cid long, seq long, {_STATS}, costs array<long>, places array<int>"


def _stats(turns: list[int | None], roles: list[str], faults: list[str | None]) -> list:
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    ends = [known[0], known[-1]] if known else [None, None]
    return [*ends, len(set(known)), initials[0] if initials else None, initials[-1] if initials else None,
            *[faults.count(f) for f in FAULTS], illegal]


def _merged(parts: list[list]) -> list:
    """The statistics of neighbouring runs as one; rows are in the order of their turns."""
    out = list(parts[0])
    for part in parts[1:]:
        if part[0] is not None:
            out[2] += part[2] - (out[1] == part[0])
            out[0], out[1] = part[0] if out[0] is None else out[0], part[1]
        if part[3] is not None:
            out[8] += out[4] is not None and out[4] + part[3] not in LEGAL
            out[3], out[4] = part[3] if out[3] is None else out[3], part[4]
        out[5:] = [a + b for a, b in zip(out[5:], part[5:])]
    return out


def _costed(roles: list[str], faults: list[str | None]) -> list[Row]:
    return [(r[:1], f in (BLANK, DUPLICATE), TRUNCATED if f == CUT else 0) for r, f in zip(roles, faults)]


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = []
    for part in schema.split(", "):
        name, kind = part.split()
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(pa.field(name, kinds[inner] if inner == kind else pa.list_(kinds[inner])))
    return pa.schema(fields)


def _per_row(schema: str, rows_from: Callable[[Iterator[tuple]], Iterator[tuple]]):
    """A ``mapInArrow`` function over a partition's rows as tuples."""
    types = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (row for batch in rows_of(batches, 256) for row in zip(*[c.to_pylist() for c in batch.columns]))
        yield from _batches(rows_from(given), types)

    return run


def _cut(limit: int):
    """Sorted rows to pieces. A conversation inside one partition, not its first or last and of
    ``limit`` rows at most, is repaired at once."""

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        first, now, k, seen, held, bucket = True, None, 0, set(), [], None

        def piece(whole: bool) -> tuple:
            turns, roles, texts, keys, marks = (list(c) for c in zip(*held)) if held else ([], [], [], [], [])
            faults = [fault_of(t, m) for t, m in zip(texts, marks)]
            stats = _stats(turns, roles, faults)
            if not whole:
                return now, bucket, k, False, len(held), *stats, None, None, roles, texts, keys
            cost, audit = cheapest(_costed(roles, faults), NOTHING, [NOTHING, ASSISTANT])
            return now, bucket, k, True, len(held), *stats, cost, audit, *edited(roles, texts, audit), None

        started = False
        for cid, part, turn, role, text, absent in rows:
            if not started or cid != now:
                if started:
                    yield piece(whole=not first and k == 0)
                    first = False
                started, now, k, seen, held, bucket = True, cid, 0, set(), [], part
            if absent:
                continue
            if len(held) == limit:
                yield piece(whole=False)
                k, held = k + 1, []
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            held.append((turn, role, text, key, key in seen))
            seen.add(key)
        if started:
            yield piece(whole=False)

    return pieces


def _solve(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Open pieces, with the places of rows that came before anywhere in their conversation."""
    for cid, bucket, k, first_turn, last_turn, turns, roles, texts, again in rows:
        again = set(again or ())
        faults = [fault_of(t, i in again) for i, t in enumerate(texts)]
        stats = _stats([], roles, faults)
        stats[:3] = first_turn, last_turn, turns
        costs, audits, places = between(_costed(roles, faults))
        yield cid, bucket, k, *stats, costs, places, audits, roles, texts


_STAT_NAMES = [c.split()[0] for c in _STATS.split(", ")]


def _rise(level: DataFrame) -> DataFrame:
    """Runs of ``FAN`` pieces as one piece each."""
    types = _arrow(_LEVEL)

    def fold(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        costs, places = joined([(r["costs"], r["places"]) for r in rows])
        stats = _merged([[r[c] for c in _STAT_NAMES] for r in rows])
        return pa.Table.from_pylist([dict(zip(types.names, (key[0].as_py(), key[1].as_py(), *stats, costs, places)))], types)

    return write_table(level.groupBy("cid", F.floor(F.col("seq") / FAN).alias("block")).applyInArrow(fold, _LEVEL), "levels")


def _descend(level: DataFrame, chosen: DataFrame) -> DataFrame:
    """(cid, seq, entry, exit) of the pieces from those of the runs that they are in."""
    schema = "cid long, seq long, entry int, exit int"
    types = _arrow(schema)

    def fold(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        _, states = route([(r["costs"], r["places"]) for r in rows], rows[0]["entry"], rows[0]["exit"])
        way = [rows[0]["entry"], *states]
        return pa.Table.from_pylist([dict(zip(types.names, (r["cid"], r["seq"], a, b))) for r, a, b in zip(rows, way, way[1:])], types)

    block = F.floor(F.col("seq") / FAN).alias("block")
    runs = chosen.select("cid", F.col("seq").alias("block"), "entry", "exit")
    dealt = level.select("cid", block, "seq", "costs", "places").join(runs, ["cid", "block"])
    return write_table(dealt.groupBy("cid", "block").applyInArrow(fold, schema), "levels")


def _end(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Whole conversations: the exit that is cheapest with what closes the order behind it."""
    for cid, seq, *stats, costs, places in rows:
        ways = [(costs[e] + INSERT * len(CLOSING[e]), places[e], e) for e in STATES if costs[e] >= 0]
        cost, _, end = min(ways)
        yield cid, seq, *stats, cost, NOTHING, end


def _edit(rows: Iterator[tuple]) -> Iterator[tuple]:
    for cid, seq, audits, roles, texts, entry, end, final in rows:
        audit = audits[4 * entry + end]
        out = edited(roles, texts, audit, entry)
        if final:
            closing = edited([], [], CLOSING[end], end)
            audit, out = audit + CLOSING[end], (out[0] + closing[0], out[1] + closing[1])
        yield cid, seq, audit, *out


@dataclass(frozen=True)
class Repaired:
    """``summary``: a row per conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost).
    ``pieces``: its repaired rows in order of ``seq`` (conv_id, seq, many, audit, roles, texts);
    ``many`` tells whether the conversation has several pieces."""

    summary: DataFrame
    pieces: DataFrame


def _conv_id():
    return F.when(F.col("cid") != NO_ID, F.col("cid")).alias("conv_id")


def repair(messages: DataFrame, absent: str | None = None, piece_rows: int = PIECE_ROWS, buckets: int | None = None) -> Repaired:
    """Repair the conversations of ``messages`` (conv_id, turn, role, text).

    Rows are taken by turn, nulls first; rows of one turn by role and text; repeated rows after each
    other, where all but the first are duplicates. A null role or text is one space; null conv_ids
    are one conversation; empty texts are blank; other columns are ignored; an empty table gives no
    rows. A conversation none of whose rows is present (``absent`` names a boolean column) has zeros.

    A conversation of any length is range-partitioned with the others and cut in pieces of
    ``piece_rows``, which alone are in memory with its texts; what joins them is 16 numbers a piece,
    gathered ``FAN`` at a time.
    """
    spark, space = messages.sparkSession, F.lit(" ")
    gone = F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)
    rows = messages.select(
        id_key("conv_id").cast("long").alias("cid"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), gone.alias("absent"),
        F.monotonically_increasing_id().alias("row"),
    )
    keys = ["cid", "turn", "role", "text", "row"]
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    cut = laid.select("cid", F.spark_partition_id().alias("bucket"), "turn", "role", "text", "absent")
    pieces = write_table(cut.mapInArrow(_per_row(_PIECE, _cut(piece_rows)), _PIECE), "pieces")

    done = pieces.where("whole")
    stretch = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    gaps = F.coalesce(stretch, F.lit(0)).alias("gaps")
    summary = done.select(_conv_id(), gaps, *COUNTS, "cost")
    parts = done.select(_conv_id(), F.lit(0).cast("long").alias("seq"), F.lit(False).alias("many"), "audit", "roles", "texts")

    open_ = pieces.where("NOT whole").drop("whole", "cost", "audit")
    place = ["cid", "bucket", "k"]
    rung = open_.select(*place, F.posexplode("keys").alias("at", "key"))
    first = rung.groupBy("cid", "key").agg(F.min(F.struct("bucket", "k", "at")).alias("f")).select("cid", "f.*", F.lit(True).alias("new"))
    again = rung.join(first, [*place, "at"], "left").where("new IS NULL").groupBy(*place).agg(F.collect_list("at").alias("again"))
    given = open_.join(again, place, "left").select(*place, "first_turn", "last_turn", "turns", "roles", "texts", "again")
    solved = write_table(given.mapInArrow(_per_row(_SOLVED, _solve), _SOLVED), "solved")
    small = solved.select(*place, *_STAT_NAMES, "costs", "places")
    levels = [write_table(with_entity_index(small, ["cid"], ["bucket", "k"], "seq", buckets=n).select("cid", "bucket", "k", "seq", *_STAT_NAMES, "costs", "places"), "levels")]
    while True:
        levels.append(_rise(levels[-1].select("cid", "seq", *_STAT_NAMES, "costs", "places")))
        if not levels[-1].where("seq > 0").limit(1).count():
            break
    top_schema = f"cid long, seq long, {_STATS}, cost long, entry int, exit int"
    top = write_table(levels[-1].mapInArrow(_per_row(top_schema, _end), top_schema), "levels")
    chosen = top.select("cid", "seq", "entry", "exit")
    for level in reversed(levels[:-1]):
        chosen = _descend(level, chosen)
    sizes = levels[0].groupBy("cid").agg((F.max("seq") + 1).alias("size"))
    dealt = levels[0].select(*place, "seq").join(chosen, ["cid", "seq"]).join(sizes, "cid")
    final = F.col("seq") == F.col("size") - 1
    edits = solved.select(*place, "audits", "roles", "texts").join(dealt, place)
    out = "cid long, seq long, audit string, roles array<string>, texts array<string>"
    changed = edits.select("cid", "seq", "audits", "roles", "texts", "entry", "exit", final.alias("final")).mapInArrow(_per_row(out, _edit), out)
    many = changed.join(sizes.select("cid", (F.col("size") > 1).alias("many")), "cid")
    return Repaired(
        summary.unionByName(top.select(_conv_id(), gaps, *COUNTS, "cost")),
        parts.unionByName(many.select(_conv_id(), "seq", "many", "audit", "roles", "texts")),
    )


def digests(repaired: Repaired) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the hash of the repaired ``role:text`` lines.

    SHA-256 takes its bytes in order. A conversation of one piece is hashed where it lies; the
    pieces of a longer one go to one task, which streams them and holds one piece at a time.
    """
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    short = repaired.pieces.where("NOT many").select("conv_id", "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    schema = "conv_id long, audit string, repaired_sha256 string"

    def stream(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, audits, own, begun = None, None, None, False
        for cid, conv_id, seq, audit, size, text in rows:
            if cid != now:
                if own is not None:
                    yield last, "".join(audits), own.hexdigest()
                now, audits, own, begun, last = cid, [], hashlib.sha256(), False, conv_id
            audits.append(audit)
            if size:
                own.update((b"\n" if begun else b"") + text.encode())
                begun = True
        if own is not None:
            yield last, "".join(audits), own.hexdigest()

    long_ = repaired.pieces.where("many").select(id_key("conv_id").alias("cid"), "conv_id", "seq", "audit", F.size("roles").alias("size"), lines.alias("text"))
    dealt = long_.repartition("cid").sortWithinPartitions("cid", "seq")
    return short.unionByName(dealt.mapInArrow(_per_row(schema, stream), schema))


def messages(repaired: Repaired) -> DataFrame:
    """(conv_id, seq, place, role, text): the repaired rows."""
    return repaired.pieces.select("conv_id", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "m")).select(
        "conv_id", "seq", "place", F.col("m.roles").alias("role"), F.col("m.texts").alias("text")
    )
