"""Operator 13 against dynamic programming over the whole lattice."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidepanel.llm import queries, structure
from tests.llm.test_operators import SCHEMA, HOSTILE

WHITE = " \t\n\x0b\x0c\r"
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def brute_repair(rows):
    """rows: (initial, fault). The least (cost, audit) to each state, row by row."""
    def inserts(now):
        for _ in range(4):
            for q, (c, a) in list(now.items()):
                for role in "ua":
                    if role in AFTER[q]:
                        now[role] = min(now.get(role, (10**9, "")), (c + 5, a + "I"))
        return now

    now = inserts({"": (0, "")})
    for initial, fault in rows:
        then = {}
        for q, (c, a) in now.items():
            ways = [(q, 2, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                ways += [(r, 1 + extra, "R") for r in "ua" if r in AFTER[q]]
                ways += [(initial, extra, "K")] if initial in AFTER[q] and initial else []
            for r, w, e in ways:
                then[r] = min(then.get(r, (10**9, "")), (c + w, a + e))
        now = inserts(then)
    return min(now[q] for q in ("", "a") if q in now)


def brute(rows):
    """rows: (turn, role, text) of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, *_ in rows if t is not None]
    cost, audit = brute_repair([(role[:1], f) for (_, role, _), f in zip(rows, faults)])
    out, state, left = [], "", iter(rows)
    for e in audit:
        row = next(left) if e != "I" else None
        if e == "D":
            continue
        state = row[1][:1] if e == "K" else next(r for r in "ua" if r in AFTER[state])
        role = row[1] if e == "K" else {"u": "user", "a": "assistant"}[state]
        out.append(f"{role}:{row[2] if row else ''}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_damage(conv_id, turn, role, text):
    role, text = (" " if x is None else x for x in (role, text))
    case = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
    if case == 0:
        return []
    text = "" if case == 1 else text.translate({ord(c): None for c in ".!?"}) if case == 2 else text
    return [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


def read(found):
    rows = {r["conv_id"]: r for r in structure.digests(found).collect()}
    got = {}
    for r in found.summary.collect():
        d = rows[r["conv_id"]]
        got[r["conv_id"]] = (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], d["audit"], d["repaired_sha256"])
    assert len(got) == len(rows) == found.summary.count()
    return got


def random_rows(rng, n):
    return [(rng.choice(["s", "u", "a", "x", ""]), rng.choice([None, None, None, "blank", "duplicate", "truncated"])) for _ in range(n)]


def test_bidirectional_search_finds_the_least_audit():
    rng = random.Random(7)
    for _ in range(1500):
        rows = random_rows(rng, rng.randrange(12))
        costed = [(i, f in ("blank", "duplicate"), 5 * (f == "truncated")) for i, f in rows]
        assert structure.cheapest(costed, structure.NOTHING, [structure.NOTHING, structure.ASSISTANT]) == brute_repair(rows)


def test_pieces_join_to_the_whole():
    rng = random.Random(8)
    for _ in range(150):
        rows = random_rows(rng, rng.randrange(1, 16))
        costed = [(i, f in ("blank", "duplicate"), 5 * (f == "truncated")) for i, f in rows]
        size = rng.randrange(1, 6)
        parts = [structure.between(costed[at : at + size]) for at in range(0, len(rows), size)]
        small = [(c, p) for c, _, p in parts]
        runs = [small[at : at + 2] for at in range(0, len(small), 2)]
        above = [structure.joined(r) for r in runs]
        whole = structure.joined(above)
        ways = [(whole[0][e] + 5 * len(structure.CLOSING[e]), whole[1][e], e) for e in structure.STATES if whole[0][e] >= 0]
        cost, _, end = min(ways)
        state, audit = structure.NOTHING, ""
        at = structure.NOTHING
        for run, to in zip(runs, structure.route(above, structure.NOTHING, end)[1]):
            for state in structure.route(run, at, to)[1]:
                audit += parts[[id(s) for s in small].index(id(run[0]))][1][4 * at + state]
                run, at = run[1:], state
        assert (cost, audit + structure.CLOSING[end]) == brute_repair(rows)


@pytest.mark.parametrize(("piece_rows", "fan", "buckets"), [(512, 512, 4), (3, 2, 5), (4, 3, 1)])
def test_conversations_in_pieces(spark, monkeypatch, piece_rows, fan, buckets):
    monkeypatch.setattr(structure, "FAN", fan)
    rng = random.Random(9)
    texts = ["yes.", "no", "", " \n", "what? ", "ok!", "tail,"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(texts))
            for c in [*range(12)] * 4 + [99] * 60 + [None] * 5]
    rows += [(99, 3, "user", "the same.")] * 25
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = structure.repair(df, piece_rows=piece_rows, buckets=buckets)
    want = {}
    for c, *row in rows:
        want.setdefault(c, []).append(tuple(row))
    assert read(found) == {c: brute(r) for c, r in want.items()}
    long_ = [r for r in structure.messages(found).where("conv_id = 99").orderBy("seq", "place").collect()]
    assert all(a["role"][:1] + b["role"][:1] in structure.LEGAL for a, b in zip(long_, long_[1:]))


def test_op13_against_brute_force(spark, sf_dir, duck):
    got = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in contract.queries()["op13_structure_repair"](spark, sf_dir).collect()}
    want = {}
    for row in duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall():
        want.setdefault(row[0], []).extend(brute_damage(*row))
    assert got == {c: brute(rows) if rows else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, rows in want.items()}


def test_structure_of_hostile_rows(spark):
    docs = spark.createDataFrame(HOSTILE, SCHEMA).select("*", F.col("doc_id").alias("conv_id"), F.col("row").alias("turn"), F.col("lang").alias("role"))
    docs = docs.withColumns({"cid": F.lit("x"), "bucket": F.lit(1), "absent": F.lit("y"), "k": F.lit(None)}).drop("row")
    damaged = queries.damaged(docs).drop("dropped")
    want = {}
    for r in HOSTILE:
        want.setdefault(r[0], []).extend(brute_damage(r[0], r[6], r[2], r[1]))
    got = read(structure.repair(damaged.where("NOT (conv_id IS NULL AND turn IS NULL AND false)")))
    # repair() alone doesn't know of dropped rows: compare the conversations that have none.
    whole = {c for c in want if all(brute_damage(r[0], r[6], r[2], r[1]) for r in HOSTILE if r[0] == c)}
    assert whole and {c: got[c] for c in whole} == {c: brute(want[c]) for c in whole}
    marked = read(structure.repair(queries.damaged(docs), absent="dropped"))
    assert marked == {c: brute(rows) if rows else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, rows in want.items()}
    none = structure.repair(docs.limit(0))
    assert none.summary.count() == 0 and structure.digests(none).count() == 0
