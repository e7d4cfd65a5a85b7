import hashlib
import itertools
import random
import zlib

import pytest

from bidloom.llm import conversations as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_repair(rows):
    """(cost, audit) over whole strings, and the repaired text."""
    seen, faults = set(), []
    for role, text in rows:
        stripped = text.rstrip(" \t\n\v\f\r")
        blank, dup = not stripped, (role, text) in seen
        seen.add((role, text))
        faults.append((blank, dup and not blank, not blank and not dup and stripped[-1] not in ".!?"))
    states = {"": (0, "")}

    def closed(states):
        for _ in range(3):
            for source, targets in (("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                if source in states:
                    cost, audit = states[source]
                    new = (cost + 5, audit + "I")
                    states[targets] = min(states.get(targets, new), new)
        return states

    states = closed(states)
    for (role, _), (blank, dup, cut) in zip(rows, faults):
        after = {}

        def put(state, value):
            after[state] = min(after.get(state, value), value)

        for state, (cost, audit) in states.items():
            put(state, (cost + 2, audit + "D"))
            if not blank and not dup:
                for target in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    if role[:1] == target:
                        put(target, (cost + 5 * cut, audit + "K"))
                    if target in "ua":
                        put(target, (cost + 5 * cut + 1, audit + "R"))
        states = closed(after)
    cost, audit = min(states[s] for s in ("", "a") if s in states)
    left, out, turn = iter(rows), [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if not (edit == "K" and role[0] == "s"):
            role = role if edit == "K" else ("user", "assistant")[turn % 2]
            turn += 1
        out.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (*(sum(f[k] for f in faults) for k in range(3)), illegal, cost, audit, digest)


def plain_table(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *plain_repair([(r, t) for _, r, t in kept])))
    return sorted(out, key=str)


def run(rows, flush):
    repair = c.Repair(0, flush)
    for role, text in rows:
        repair.add(None, role, text)
    return repair.result()[2:]


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    return [(rng.choice(roles), rng.choice(["Yes.", "No", "", " \n", "Why?", "So", f"{rng.random()}."])) for _ in range(n)]


@pytest.mark.parametrize("flush", [1, 3, 512])
def test_against_whole_strings(flush):
    rng = random.Random(flush)
    for n in [0, 1, 2, 3, 5, 8, 13, 40] * 12 + [300]:
        rows = random_rows(rng, n)
        assert run(rows, flush) == plain_repair(rows)


def test_against_all_edit_strings():
    """Every string of edits of up to three rows and four inserts is tried."""
    rng = random.Random(7)
    for n in [0, 1, 2, 3] * 6:
        rows = random_rows(rng, n)
        found = []
        for inserts in range(5):
            for audit in map("".join, itertools.product("DIKR", repeat=n + inserts)):
                if audit.count("I") == inserts and (cost := price(rows, audit)) is not None:
                    found.append((cost, audit))
        assert run(rows, 512)[4:6] == min(found)


def price(rows, audit):
    state, cost, left, seen = "", 0, iter(rows), set()
    for edit in audit:
        role = "?"
        if edit != "I":
            role, text = next(left)
            blank, dup = not text.strip(), (role, text) in seen
            seen.add((role, text))
            if edit == "D":
                cost += 2
                continue
            if blank or dup:
                return None
            cost += 5 * (text.strip()[-1] not in ".!?")
        step = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if edit == "K" and role[:1] not in list(step):
            return None
        state = role[0] if edit == "K" else step[-1]
        cost += {"K": 0, "R": 1, "I": 5}[edit]
    return cost if state in ("", "a") else None


def test_equal_hashes_are_verified():
    """Two strings whose hashes are made equal still compare by their edits."""
    root = c.Edits()
    a, b = c.Edits(c.Edits(root, "K"), "D"), c.Edits(c.Edits(root, "D"), "K")
    a.print = b.print = a.up[0].print = b.up[0].print = 1
    assert not c.same(a, b)
    assert c.smaller(a, b) is b


def test_open_edits_stay_few():
    repair = c.Repair(0, 64)
    rng = random.Random(3)
    for _ in range(5000):
        repair.add(None, rng.choice(["user", "assistant"]), f"{rng.random()}.")
    assert len(repair.open) < 256


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (3, None, "user", "b"),
            (3, -5, "assistant", "x" * 200_000), (3, 7, None, "c."), (4, 0, "", ""), (4, 0, "System", "d.")]
    rng = random.Random(1)
    for conv in range(5, 60):
        rows += [(conv, rng.choice([None, *range(8)]), *row) for row in random_rows(rng, rng.randrange(12))]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS audit", "1 AS there", "2 AS kind", "3 AS copy")
    for partitions in (1, 5):
        got = c.repair_table(df.repartition(partitions)).collect()
        assert sorted(map(tuple, got), key=str) == plain_table(rows)


def test_empty_table_and_text_keys(spark):
    empty = c.repair_table(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.schema["conv_id"].dataType.simpleString() == "bigint"
    named = spark.createDataFrame([("a", 1, "user", "x."), (None, 1, "user", "x.")], "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in c.repair_table(named).collect()} == {"a", None}


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = sorted(map(tuple, c.repair_table(df).collect()), key=str)
    assert got == plain_table([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
