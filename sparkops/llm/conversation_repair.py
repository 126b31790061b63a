"""Conversation repair: the cheapest edits that make turns alternate, by weighted
interval parsing.

A legal conversation is ``(s?(ua)+)?`` in the initials of its roles. The repair
grammar is in Chomsky normal form. Its nonterminals ``N[p, q]`` say that a span of
rows, once edited, leads the legal pattern from place ``p`` to place ``q`` (places:
0 start, 1 after s, 2 after u, 3 after a): ``N[p, q] -> N[p, r] N[r, q]`` for any
``r``, and ``N[p, q] -> row`` for an edit of one row. A cell of the chart holds for
each nonterminal the least (cost, audit), audits being compared as ASCII text.
Insertions are the closure of the unit productions: any number before and after
each row, so no cell lacks them.

Cells are combined bottom-up by span length: 1, 2, 4, ... rows. Since the rule for
``N[p, q]`` takes every ``r``, all ways to split a span in two give the same cell,
and one split is enough. (Least costs and audits stay least when a span grows: of
two audits of equal cost over the same rows neither is a beginning of the other,
as they differ by insertions only if one costs more.) The same holds for spans of
different tasks: rows are dealt to tasks by ranges of (conversation, place), each
task parses its part of a conversation, and the parts' cells are combined again.
So a conversation may hold any share of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sparkops.operators.joins import salted_join

from ._common import Store, trimmed

# Fixed values of the contract: costs, and the white space of a blank text.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# Places of the legal pattern and the initials that lead from one to the next.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WHOLE = (0, 3)  # places where a conversation may end
NAMES = {"u": "user", "a": "assistant"}

Cell = dict[tuple[int, int], tuple[int, str]]


def better(cell: Cell, key: tuple[int, int], cost: int, audit: str) -> None:
    if key not in cell or (cost, audit) < cell[key]:
        cell[key] = (cost, audit)


def combined(one: Cell, two: Cell) -> Cell:
    """The cell of a span from those of its two parts."""
    out: Cell = {}
    for (p, r), (c1, a1) in one.items():
        for q in range(4):
            right = two.get((r, q))
            if right is not None:
                better(out, (p, q), c1 + right[0], a1 + right[1])
    return out


def closure() -> Cell:
    """Insertions alone, as few as lead from p to q."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    for p in range(4):
        at, n = p, 0
        while n < 2:
            at, n = next(STEPS[at, x] for x in "ua" if (at, x) in STEPS), n + 1
            better(cell, (p, at), INSERT * n, "I" * n)
    return cell


CLOSURE = closure()


def leaf(kind: str) -> Cell:
    """The cell of one row: its initial (or another letter), upper case if truncated;
    ``x`` for a row that must go."""
    cell: Cell = {}
    extra = TRUNCATED if kind.isupper() else 0
    for p in range(4):
        better(cell, (p, p), DELETE, "D")
        if kind == "x":
            continue
        if (p, kind.lower()) in STEPS:
            better(cell, (p, STEPS[p, kind.lower()]), KEEP + extra, "K")
        for to in "ua":
            if (p, to) in STEPS:
                better(cell, (p, STEPS[p, to]), REROLE + extra, "R")
    return combined(combined(CLOSURE, cell), CLOSURE)


def deleted(n: int) -> Cell:
    """The cell of ``n`` rows that must go: insertions come last, as D sorts before I."""
    return {key: (DELETE * n + cost, "D" * n + audit) for key, (cost, audit) in CLOSURE.items()}


LEAVES = {k: leaf(k) for k in "suaoSUAOx"}


class Spans:
    """Cells of the spans of one sequence of rows, joined as soon as two neighbours
    are of one length; ``cell`` joins what is left, short spans first."""

    def __init__(self, cache: dict[tuple[int, int], tuple[Cell, Cell, Cell]]):
        self.stack: list[tuple[int, Cell]] = []
        self.cache = cache  # of spans of up to four rows

    def join(self, one: Cell, two: Cell, short: bool) -> Cell:
        if not short:
            return combined(one, two)
        key = (id(one), id(two))  # the entry keeps both cells, so that the ids stay theirs
        if key not in self.cache:
            self.cache[key] = (combined(one, two), one, two)
        return self.cache[key][0]

    def add(self, cell: Cell, length: int = 1) -> None:
        while self.stack and self.stack[-1][0] <= length:
            n, left = self.stack.pop()
            cell, length = self.join(left, cell, n == length and length <= 2), n + length
        self.stack.append((length, cell))

    def cell(self) -> Cell:
        while len(self.stack) > 1:
            (n2, two), (n1, one) = self.stack.pop(), self.stack.pop()
            self.stack.append((n1 + n2, combined(one, two)))
        return self.stack[0][1] if self.stack else CLOSURE


def cheapest(cell: Cell) -> tuple[int, str]:
    """Of the whole conversation. No row, no edit: inserting costs more than nothing."""
    return min(cell[0, q] for q in WHOLE if (0, q) in cell)


def parse(kinds: str) -> tuple[int, str]:
    """Least cost and audit of a conversation given by its rows' kinds (see ``leaf``)."""
    spans = Spans({})
    for k in kinds:
        spans.add(LEAVES[k])
    return cheapest(spans.cell())


def damage(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The four columns of the rows, damaged by ``crc32(conv:turn) % 20``: 0 drops a
    row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it,
    4 makes it the user's. A null is one space; null ids and turns stay null but
    for the hash."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col)]
    fate = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(said[3], "".join(ENDS), "")).otherwise(said[3])
    rows = conversations.select(
        F.col(conv_col), F.col(turn_col), F.when(fate == 4, "user").otherwise(said[2]).alias(role_col),
        text.alias(text_col), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("_times"))
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_times")))).where("_i < _times").drop("_i", "_times")


def key_of(col: str) -> Column:
    """A text that tells ids apart, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def runs_of(rows: DataFrame, store: Store) -> DataFrame:
    """Equal rows (conversation, turn, role, text) as one, ``n`` of them, with ``kind``
    of the first of them (the others are duplicates), stored."""
    some = rows.groupBy("c", "timed", "turn", "role", "text").agg(F.count("*").alias("n"))
    core = F.rtrim("text", F.lit(BLANKS))
    some = store.put(some.withColumn("h", F.sha2(F.concat_ws(":", "role", "text"), 256))
                     .withColumn("blank", core == "").withColumn("cut", ~F.substring(core, -1, 1).isin(*ENDS)), "said")
    when = F.struct("timed", "turn")
    first = some.where("not blank").groupBy("c", "h").agg(F.min(when).alias("first"), F.count("*").alias("times"))
    first = store.put(first.where("times > 1").select("c", "h", "first"), "first")
    # Texts said at one turn only need no look-up; of the others those of later turns are duplicates.
    later = salted_join(some.withColumn("at", when), first, ["c", "h"], ["c", "timed", "turn"], how="left")
    dup = F.coalesce(F.col("at") != F.col("first"), F.lit(False))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = F.when(F.col("blank") | dup, "x").when(F.col("cut"), F.upper(known)).otherwise(known)
    return store.put(later.select("c", "timed", "turn", "role", "text", "n", "h", "blank", kind.alias("kind"),
                                  known.alias("initial")), "runs")


def stats_of(runs: DataFrame) -> DataFrame:
    """Per conversation the gaps of its turns and its rows by fault."""
    gone = F.col("kind") == "x"
    turns = runs.groupBy("c", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(gone, F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum((~gone & (F.upper("kind") == F.col("kind"))).cast("bigint")).alias("truncated"))
    wide = [F.col(c).cast("decimal(38,0)") for c in ("hi", "lo", "turns")]
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    return turns.groupBy("c").agg(
        F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count("turn").alias("turns"),
        *(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated"))).select(
        "c", F.when(F.col("turns") == 0, 0).otherwise(F.least(wide[0] - wide[1] + 1 - wide[2], most).cast("bigint")).alias("gaps"),
        "blank", "duplicate", "truncated")


PART = "c string, part int, first string, last string, illegal bigint, ps array<int>, qs array<int>, costs array<bigint>, audits array<string>"
LEGAL = {"su", "ua", "au"}


def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a sorted part of the runs: its cell (of a
    conversation that lies wholly inside, only the cheapest way), its first and
    last initial and the illegal neighbours."""
    part, cache = TaskContext.get().partitionId(), {}
    out: list[tuple] = []
    conv, spans, first, last, illegal, seen = None, None, "", "", 0, 0

    def done(border: bool) -> None:
        cell = spans.cell()
        if not border:
            cell = {(0, 3): cheapest(cell)}
        keys = sorted(cell)
        out.append((conv, part, first, last, illegal, [p for p, _ in keys], [q for _, q in keys],
                    [cell[k][0] for k in keys], [cell[k][1] for k in keys]))

    def batch() -> pa.RecordBatch:
        rows = list(zip(*out, strict=True))
        types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()),
                 pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())]
        made = pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)],
                                          ["c", "part", "first", "last", "illegal", "ps", "qs", "costs", "audits"])
        out.clear()
        return made

    for b in batches:
        for c, n, kind, initial in zip(*(b.column(x).to_pylist() for x in ("c", "n", "kind", "initial")), strict=True):
            if c != conv or spans is None:
                if spans is not None:
                    done(border=seen == 1)
                conv, spans, first, last, illegal, seen = c, Spans(cache), initial, "", 0, seen + 1
            illegal += n - 1 + bool(last and last + initial not in LEGAL)
            last = initial
            if kind != "x":
                spans.add(LEAVES[kind])
                n -= 1
            if n == 1:
                spans.add(LEAVES["x"])
            elif n:
                spans.add(deleted(n), n)
        if len(out) >= 2000:
            yield batch()
        if len(cache) > 20_000:
            cache.clear()
    if spans is not None:
        done(border=True)
    if out:
        yield batch()


def joined(key, part):
    """The parts of one conversation, at most one a task, as one."""
    rows = sorted(part.to_pylist(), key=lambda r: r["part"])
    spans, last, illegal = Spans({}), "", 0
    for r in rows:
        cell = {(p, q): (c, a) for p, q, c, a in zip(r["ps"], r["qs"], r["costs"], r["audits"], strict=True)}
        spans.add(cell)
        illegal += r["illegal"] + bool(last and last + r["first"] not in LEGAL)
        last = r["last"]
    cost, audit = cheapest(spans.cell())
    return pa.table({"c": pa.array([rows[0]["c"]]), "illegal": pa.array([illegal], pa.int64()),
                     "cost": pa.array([cost], pa.int64()), "audit": pa.array([audit], pa.string())})


def edited(audit: str, runs: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that stay, from an audit and the runs (role,
    text, n). Runs are taken one by one."""
    place, left, role, text = 0, 0, "", ""
    runs = iter(runs)
    for edit in audit:
        if edit == "I":
            place = next(STEPS[place, x] for x in "ua" if (place, x) in STEPS)
            yield edit, NAMES["u" if place == 2 else "a"], ""
            continue
        if not left:
            role, text, left = next(runs)
        left -= 1
        if edit == "K":
            place = STEPS[place, role[0]]
            yield edit, role, text
        elif edit == "R":
            place = next(STEPS[place, x] for x in "ua" if (place, x) in STEPS)
            yield edit, NAMES["u" if place == 2 else "a"], text


def streamed(batches: Iterator[pa.RecordBatch], one: Callable) -> Iterator:
    """Calls ``one(head, runs)`` for each conversation of sorted rows: its head (a dict),
    then its runs, read as they come."""
    names = ("c", "head", "role", "text", "n", "audit")
    rows = (r for b in batches for r in zip(*(b.column(x).to_pylist() for x in names), strict=True))
    ahead = next(rows, None)

    def own(c: str) -> Iterator[tuple[str, str, int]]:
        nonlocal ahead
        while (ahead := next(rows, None)) is not None and ahead[0] == c:
            yield ahead[2], ahead[3], ahead[4]

    while ahead is not None:
        c, audit = ahead[0], ahead[5]
        runs = own(c)
        yield from one(c, audit, runs)
        for _ in runs:  # rows after the last edit: none, but the next conversation must be met
            pass


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    weight = 0
    for r in rows:
        some.append(r)
        weight += sum(len(x) for x in r if isinstance(x, str))
        if len(some) >= size or weight > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)],
                                             schema=schema)
            some, weight = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)],
                                         schema=schema)


class Repair:
    """The repair of all conversations of a table of rows.

    ``conversations()`` has a row for each id of the rows and of ``ids`` (a DataFrame
    with the id column, for conversations that lost all rows): gaps, blank, duplicate, truncated, illegal,
    cost, audit. ``rows()`` has the repaired rows, ``digests()`` adds the hash of
    their ``role:text`` lines.

    Rows are taken by turn, nulls first, rows of one turn by role and then by the
    hash of role and text; equal rows follow each other. A null role or text is one
    space, so such a text is blank, and a role without the initial of a legal one can
    only be changed or go. The conversation of the null id is one. An id without rows
    has zeros and an empty audit. Gaps over the range of a long are its greatest
    value. Extra columns are not read; an empty table has no rows.
    """

    def __init__(self, rows: DataFrame, ids: DataFrame | None = None, *, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        self.store = store = Store(rows.sparkSession, "op11")
        self.conv_col = conv_col
        known = rows.select(conv_col) if ids is None else rows.select(conv_col).unionByName(ids.select(conv_col))
        self.ids = known.select(key_of(conv_col).alias("c"), F.col(conv_col).alias("conv")).distinct()
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        rows = rows.select(key_of(conv_col).alias("c"), F.col(turn_col).isNotNull().alias("timed"),
                           F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
        self.runs = runs_of(rows, store)
        store.drop("said", "first")
        light = self.runs.select("c", "timed", "turn", "role", "h", "n", "kind", "initial")
        order = ["c", "timed", "turn", "role", "h"]
        parts = store.put(light.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "n", "kind", "initial")
                          .mapInArrow(trimmed(parted), PART), "parts")
        alone = F.size("ps") == 1  # the cheapest way of a conversation inside one part
        split = parts.where(~alone).groupBy("c").applyInArrow(joined, "c string, illegal bigint, cost bigint, audit string")
        found = parts.where(alone).select("c", "illegal", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
        head = self.ids.join(found.unionByName(split), "c", "left").join(stats_of(self.runs), "c", "left")
        self.heads = store.put(head.select("c", "conv", *(F.coalesce(x, F.lit(0)).alias(x) for x in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit")), "heads")
        store.drop("parts")

    def conversations(self) -> DataFrame:
        return self.heads.withColumnRenamed("conv", self.conv_col).drop("c")

    def sorted_rows(self) -> DataFrame:
        """Each conversation's head and then its runs, in one task, read as a stream."""
        nothing = F.lit(None)
        heads = self.heads.select("c", F.lit(0).alias("head"), nothing.cast("boolean").alias("timed"),
                                  nothing.cast(self.runs.schema["turn"].dataType).alias("turn"), nothing.cast("string").alias("role"),
                                  nothing.cast("string").alias("h"), nothing.cast("string").alias("text"),
                                  nothing.cast("bigint").alias("n"), "audit")
        runs = self.runs.select("c", F.lit(1).alias("head"), "timed", "turn", "role", "h", "text", "n",
                                nothing.cast("string").alias("audit"))
        return (heads.unionByName(runs).repartition("c").sortWithinPartitions("c", "head", "timed", "turn", "role", "h")
                .select("c", "head", "role", "text", "n", "audit"))

    def rows(self) -> DataFrame:
        """(id, place from 1, edit, role, text) of the repaired rows."""
        schema = pa.schema([("c", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                            ("text", pa.string())])

        def one(c, audit, runs):
            for place, (edit, role, text) in enumerate(edited(audit, runs), 1):
                yield c, place, edit, role, text

        @trimmed
        def all_rows(batches):
            yield from batched(streamed(batches, one), schema)

        made = self.sorted_rows().mapInArrow(all_rows, "c string, place bigint, edit string, role string, text string")
        return made.join(self.heads.select("c", F.col("conv").alias(self.conv_col)), "c").select(
            self.conv_col, "place", "edit", "role", "text")

    def digests(self) -> DataFrame:
        schema = pa.schema([("c", pa.string()), ("repaired_sha256", pa.string())])

        def one(c, audit, runs):
            digest, before = hashlib.sha256(), b""
            for _, role, text in edited(audit, runs):
                digest.update(before + f"{role}:{text}".encode())
                before = b"\n"
            yield c, digest.hexdigest()

        @trimmed
        def all_digests(batches):
            yield from batched(streamed(batches, one), schema)

        made = self.sorted_rows().mapInArrow(all_digests, "c string, repaired_sha256 string")
        return self.heads.join(made, "c").withColumnRenamed("conv", self.conv_col).drop("c")


def conversation_repair(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Damage the rows (see ``damage``), repair them (see ``Repair``) and return, for each
    id of the table, gaps, blank, duplicate, truncated, illegal, cost, audit and
    ``repaired_sha256``."""
    names = {"conv_col": conv_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}
    return Repair(damage(conversations, **names), conversations.select(conv_col), **names).digests()
