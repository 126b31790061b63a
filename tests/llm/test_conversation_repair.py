"""Conversation repair against every edit sequence, a plain chart of all splits, and a
row-by-row version of the whole contract."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F, types as T

from sparkops.llm.conversation_repair import CLOSURE, LEAVES, Repair, cheapest, combined, conversation_repair, deleted, parse

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def every(kinds):
    """The least (cost, audit) of all ways to edit, with at most two insertions at a place."""
    choices = []
    for k in kinds:
        extra = 5 if k.isupper() else 0
        choices.append([("D", 2, "")] + ([] if k == "x" else [("K", extra, k.lower()), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]))
    gaps = [("", 0, ""), ("I", 5, "u"), ("I", 5, "a"), ("II", 10, "ua"), ("II", 10, "au")]
    found = []
    for row in itertools.product(*choices):
        for more in itertools.product(gaps, repeat=len(kinds) + 1):
            parts = [more[0], *itertools.chain(*zip(row, more[1:]))]
            if LEGAL.match("".join(p[2] for p in parts)):
                found.append((sum(p[1] for p in parts), "".join(p[0] for p in parts)))
    return min(found)


@pytest.mark.parametrize("kinds", ["", "s", "u", "A", "x", "ua", "au", "us", "su", "sU", "uu", "aa", "oo", "sa", "xa", "Ox",
                                   "sua", "usa", "aau", "uxa", "SUA", "ooo", "uAu", "sso"])
def test_cheapest_of_all_edits(kinds):
    assert parse(kinds) == every(kinds)


def chart(kinds):
    """All spans by length, all splits of each."""
    n, cells = len(kinds), {}
    for i, k in enumerate(kinds):
        cells[i, i + 1] = LEAVES[k]
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = {}
            for m in range(i + 1, i + length):
                for key, value in combined(cells[i, m], cells[m, i + length]).items():
                    cell[key] = min(cell.get(key, value), value)
            cells[i, i + length] = cell
    return cells[0, n] if n else CLOSURE


@pytest.mark.parametrize("seed", range(60))
def test_one_split_is_enough(seed):
    rng = random.Random(seed)
    kinds = "".join(rng.choice("suaoSUAOx" if seed % 2 else "uaUAx") for _ in range(rng.randrange(1, 14)))
    assert parse(kinds) == cheapest(chart(kinds))


def test_run_of_deleted_rows():
    for n in range(1, 6):
        assert deleted(n) == chart("x" * n)


def plain(rows):
    """The contract, conversation by conversation."""
    said = lambda v: " " if v is None else str(v)
    by, ids = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        fate, role, text = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20, said(role), said(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        by[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = {}
    for conv in ids:
        own = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}:{r[2]}".encode()).hexdigest()))
        faults, seen, kinds = Counter(), set(), ""
        for _, role, text in own:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            o = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not core:
                faults["blank"] += 1
                kinds += "x"
            elif (role, text) in seen:
                faults["duplicate"] += 1
                kinds += "x"
            elif core[-1] not in ".!?":
                faults["truncated"] += 1
                kinds += o.upper()
            else:
                kinds += o
            seen.add((role, text))
        cell = {(0, 0): (0, ""), (0, 2): (5, "I"), (0, 3): (10, "II")}
        for k in kinds:  # from left to right
            cell = combined(cell, LEAVES[k])
        cost, audit = cheapest(cell)
        lines, k, place = [], 0, ""
        for e in audit:
            if e == "D":
                k += 1
                continue
            turn_of = "user" if place[-1:] in ("", "s", "a") else "assistant"
            role, text = (own[k][1] if e == "K" else turn_of, own[k][2]) if e != "I" else (turn_of, "")
            k += e != "I"
            place += role[0]
            lines.append(f"{role}:{text}")
        assert LEGAL.match(place)
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"],
                     faults["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows, parts=3):
    table = spark.createDataFrame(rows, ROWS).repartition(parts)
    for clash in ("c", "n", "h", "kind", "timed", "head", "audit", "_i"):
        table = table.withColumn(clash, F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in conversation_repair(table).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == plain(rows)


def test_odd_rows(spark):
    texts = ["Yes.", "no", "", None, " \t", "Why? \n", " ", "été.", "x" * 300_000 + "!", "a:b\nc."]
    roles = ["user", "assistant", "system", None, "", "User", "tool", "unknown"]
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, 1, 2, 3, 7]), rng.choice(roles), rng.choice(texts)) for _ in range(120)]
    check(spark, rows + [(9, None, "user", "Only."), (10, -2**63, "user", "a."), (11, None, None, None)] + rows[:7])


def test_gaps_beyond_a_long(spark):
    got = Repair(spark.createDataFrame([(1, -2**63, "user", "a."), (1, 2**63 - 1, "assistant", "b.")], ROWS)).conversations().first()
    assert (got.gaps, got.audit, got.cost) == (2**63 - 1, "KK", 0)


def test_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    words = ["Good.", "bad", "Well?", "", "so!"]
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"{rng.choice(words)[:-1]}{t // 2}{rng.choice('.!? x')}")
            for t in range(4000)]
    rows += [(2, 5, "user", "again.")] * 3000 + [(c, t, "user", "Hello.") for c in range(3, 40) for t in range(3)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_empty_table_and_repaired_rows(spark):
    assert conversation_repair(spark.createDataFrame([], ROWS)).collect() == []
    table = spark.createDataFrame([(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hi."), (1, 3, "user", "Oh?"), (2, 1, "user", " ")], ROWS)
    ids = spark.createDataFrame([(3,)], "conv_id long")
    made = Repair(table, ids)
    heads = {r.conv_id: (r.cost, r.audit) for r in made.conversations().collect()}
    assert heads == {1: (2, "KRR"), 2: (2, "D"), 3: (0, "")}
    rows = sorted((r.conv_id, r.place, r.edit, r.role, r.text) for r in made.rows().collect())
    assert rows == [(1, 1, "K", "system", "Be kind."), (1, 2, "R", "user", "Hi."), (1, 3, "R", "assistant", "Oh?")]
