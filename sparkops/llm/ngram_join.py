"""Jaccard join of documents on word n-grams, by token-combination prefixes.

Tokens are 64-bit hashes of shingles. Their global order puts rare tokens first
(by hash) and frequent ones last (by hash), so a document's prefix, the first
``n - ceil(t n) + 1`` tokens, is rare wherever it can be. Linked documents share
a token of both prefixes. If that token is rare, it is found in the index of
single tokens, whose lists are short by definition. Otherwise both documents
have all their rare tokens inside the prefix and share none of them, so all
they share is frequent; their prefixes are extended to ``2 + 0.3 n - 2 r`` frequent
tokens (r: their rare tokens), where they must share two neighbours: each token
of one document only breaks at most two neighbourhoods, each of the other's at
most one, together fewer than there are. The index holds these combinations of
two in place of the frequent tokens.

Frequencies: a token of the lower part of the hash range (``zone``) is frequent
if at least ``frequent`` documents hold it. The upper part matters only to
documents whose lower part is too short or too frequent for a whole prefix,
and is counted over those. Both are properties of the token alone, so the
order is the same for all. Documents of equal sets are joined as one.

Only spanning links need verification for the components: a pair whose
documents are connected already is skipped.

Documents that share much, but too little to link, meet in the lists of many
combinations. So each document of that index brings a signature: 512 bits, of which
every token of its set flips one. Two signatures differ in no more bits than the
sets in tokens, so a pair that differs in more bits than linked sets may differ in
tokens isn't a pair, and is never built. Pairs that remain are alike and share many
combinations; each document brings its least ones, too, and a pair whose least ones
meet is built in the list of the least that they share, not in every list.

Of a large group of near copies nearly all pairs are linked, and few links connect it:
each document is first compared with a few drawn from its lists. What is left are pairs
of documents still apart, and those of a list's largest component needn't meet there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._common import Store, ascii_words, byte_slices, list_array, mix64, rolling, sized, trimmed, within, word_hashes
from .sketch import PARTIAL, merge, partial

SIGN = np.uint64(1 << 63)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of its distinct shingles, and these, hashed, in order
    of the (signed) hash. Shorter texts have the whole sequence as one shingle."""
    counts, words = ascii_words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashes = word_hashes(words, 5)
    at = within(counts, width)
    ends = np.cumsum(counts)
    doc, values = np.searchsorted(ends, at, side="right"), rolling(hashes, width)[at] if len(at) else at.astype(np.uint64)
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            doc = np.concatenate([doc, short])
            values = np.concatenate([values, rolling(hashes, n)[(ends - counts)[short]] + np.uint64(n)])
    values = (values ^ SIGN).view(np.int64)
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return np.bincount(doc[new], minlength=len(counts)), values[new]


def sets_of(docs: DataFrame, id_col: str, text_col: str, width: int, zone: float, slice_bytes: int) -> DataFrame:
    """(id, n, key, na, a, b): set size, fingerprint of the whole set (null if it is
    empty), and the tokens below (``na`` of them) and above the zone's border."""
    border = int(zone * 2**64) - 2**63

    @trimmed
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in byte_slices(batches, "text", slice_bytes):
            counts, values = shingle_sets(batch.column("text"), width)
            ends = np.cumsum(counts)
            low = values < border
            doc = np.repeat(np.arange(len(counts)), counts)
            na = np.bincount(doc[low], minlength=len(counts))
            keys = [xxhash.xxh3_128_digest(values[e - n:e].tobytes()) if n else None
                    for e, n in zip(ends, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts.astype(np.int64)), pa.array(keys, pa.binary()),
                 pa.array(na.astype(np.int64)), list_array(values[low], na), list_array(values[~low], counts - na)],
                ["id", "n", "key", "na", "a", "b"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        make, f"id {kind}, n bigint, key binary, na bigint, a array<bigint>, b array<bigint>")


WORDS = [f"s{i}" for i in range(8)]  # a signature is eight 64-bit words


def signatures(sets: DataFrame) -> DataFrame:
    """(row, s0 .. s7) of (row, a, b): the parity of the number of tokens per place."""
    @trimmed
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                n, flips = batch.num_rows, np.zeros(batch.num_rows * 512, np.int64)
                for side in ("a", "b"):
                    lists = batch.column(side)
                    tokens = lists.flatten().to_numpy().view(np.uint64)
                    of = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
                    flips += np.bincount(of * 512 + (mix64(tokens) & np.uint64(511)).astype(np.int64), minlength=n * 512)
                words = np.packbits((flips % 2).astype(np.uint8).reshape(n, 512), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(np.ascontiguousarray(w)) for w in words.T)],
                                                 ["row", *WORDS])

    return sets.select("row", "a", "b").mapInArrow(make, "row bigint, " + ", ".join(f"{w} bigint" for w in WORDS))


LEAST = 8  # combinations that a document brings
HUBS = 4  # documents of a list that all others of the list are compared with first


def least_combos(combos: DataFrame) -> DataFrame:
    """(row, least) of (row, combo): its smallest combinations."""
    nth = F.row_number().over(Window.partitionBy("row").orderBy("combo"))
    few = combos.select("row", "combo", nth.alias("nth")).where(F.col("nth") <= LEAST)
    return few.groupBy("row").agg(F.collect_list("combo").alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes that have an edge, by alternating large and small
    stars; root is the smallest node of the component. Each round is stored."""
    store = Store(edges.sparkSession, "op3-stars")
    e = store.put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "small")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store.put(large.where("u <> v").distinct(), "large")
        store.drop("small")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = store.put(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        store.drop("large")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b) if b < 2**20 else F.ceil(a / b)


class Join:
    """One join; ``percent`` is the least similarity in hundredths."""

    def __init__(self, docs: DataFrame, *, id_col: str, text_col: str, width: int, percent: int, zone: float,
                 frequent: int, most_rows: int, slice_bytes: int):
        self.percent, self.zone, self.frequent, self.most_rows = percent, zone, frequent, most_rows
        self.store = Store(docs.sparkSession, "op3")
        self.sets = self.store.put(sets_of(docs, id_col, text_col, width, zone, slice_bytes)
                           .withColumn("row", F.monotonically_increasing_id()), "sets")
        first = self.sets.where("key is not null").groupBy("key").agg(F.min("row").alias("rep"))
        self.members = self.store.put(self.sets.select("row", "id", "n", "key").join(first, "key", "left")
                              .select("row", "id", "n", "key", F.coalesce("rep", "row").alias("rep")), "members")
        copies = self.store.put(self.members.where("row <> rep").select("row"), "copies")
        self.reps = self.sets.where("n > 0").join(sized(copies, most_rows), "row", "left_anti")

    def prefix(self) -> Column:
        """Length of the prefix: n - ceil(t n) + 1."""
        return F.col("n") - ceil_div(self.percent * F.col("n"), 100) + 1

    def low_entries(self) -> DataFrame:
        """(row, k, token): the tokens below the border that may occur again; k is the
        place among all of these."""
        @trimmed
        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = []
            for b in batches:
                keys.append(b.column("a").flatten().to_numpy().view(np.uint64))
                if sum(map(len, keys)) > 1_000_000:
                    yield partial(np.concatenate(keys))
                    keys = []
            if keys:
                yield partial(np.concatenate(keys))

        again = merge(self.store.put(self.reps.select("a").mapInArrow(cells, PARTIAL), "sketch"))
        self.store.drop("sketch")
        shared = self.sets.sparkSession.sparkContext.broadcast(again)

        @trimmed
        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                tokens, na = b.column("a").flatten().to_numpy(), b.column("na").to_numpy()
                starts = np.cumsum(na) - na
                keep = np.flatnonzero(shared.value(tokens.view(np.uint64)))
                of = np.repeat(np.arange(len(na)), na)[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.column("row").to_numpy()[of]), pa.array((keep - starts[of]).astype(np.int32)),
                     pa.array(tokens[keep])], ["row", "k", "token"])

        return self.store.put(self.reps.where("na > 0").select("row", "na", "a").mapInArrow(
            entries, "row bigint, k int, token bigint"), "low")

    def counted(self, entries: DataFrame) -> DataFrame:
        """Entries of tokens that at least two of them have, with f (1: the token is
        frequent), and in the row f_before (frequent tokens before) and f_all."""
        counts = entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select(
            "token", (F.col("df") >= self.frequent).cast("int").alias("f"))
        by_row = Window.partitionBy("row")
        before = by_row.orderBy("token").rowsBetween(Window.unboundedPreceding, -1)
        return entries.join(counts, "token").withColumn(
            "f_before", F.coalesce(F.sum("f").over(before), F.lit(0)).cast("int")).withColumn(
            "f_all", F.sum("f").over(by_row).cast("int"))

    def index(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Single tokens (row, token, code: twice n, and 1 more if the prefix holds
        frequent tokens), combinations (row, n, combo), and of rows whose prefix is
        the plain one its last token (row, last)."""
        p = self.prefix()
        facts = self.store.put(self.reps.select("row", "n", "na", F.get("a", (F.least(p, "na") - 1).cast("int")).alias("last")),
                               "facts")
        low = self.store.put(self.counted(self.low_entries()).join(facts, "row"), "low-counted")
        rare_low = F.col("na") - F.col("f_all")
        singles = low.where((rare_low >= p) & (F.col("f") == 0) & (F.col("k") - F.col("f_before") < p)).select(
            "row", "token", (2 * F.col("n")).alias("code"))
        # Documents without a whole prefix of rare tokens below the border.
        marks = self.store.put(low.where("f_all > 0").select("row", "f_all").distinct(), "marks")
        facts = facts.join(marks, "row", "left").withColumn("f_all", F.coalesce("f_all", F.lit(0)))
        lasts = facts.where((F.col("f_all") == 0) & (F.col("na") >= p)).select("row", "last")
        rest = self.store.put(facts.where(rare_low < p).select("row", "n", "f_all", rare_low.alias("rare_low")), "rest")
        high = self.reps.select("row", "b").join(sized(rest.select("row"), self.most_rows), "row")
        high = self.store.put(self.counted(high.select("row", F.posexplode("b").alias("k", "token"))
                                           ).withColumnRenamed("f_all", "f_high"), "high-counted")
        more = high.where("f_high > 0").select("row", "f_high").distinct()
        rest = self.store.put(rest.join(more, "row", "left").withColumn("f_high", F.coalesce("f_high", F.lit(0)))
                              .withColumn("r", F.col("n") - F.col("f_all") - F.col("f_high")), "rest-all")
        known = sized(rest.select("row", "n", "rare_low", "r"), self.most_rows)
        heavy = F.col("r") < p
        low = low.select("row", "k", "token", "f", "f_before").join(known, "row")
        high = high.select("row", "k", "token", "f", "f_before").join(known, "row")
        frequents = None
        for part, place in ((low, F.col("k") - F.col("f_before")), (high, F.col("rare_low") + F.col("k") - F.col("f_before"))):
            singles = singles.unionByName(part.where((F.col("f") == 0) & (place < p)).select(
                "row", "token", (2 * F.col("n") + heavy.cast("int")).alias("code")))
            more = part.where((F.col("f") == 1) & heavy).select("row", "n", "r", "token")
            frequents = more if frequents is None else frequents.unionByName(more)
        order = Window.partitionBy("row").orderBy("token")
        # At least twice the share of tokens that one document may have alone.
        broken = F.floor(2 * (100 - self.percent) * F.col("n") / 100)
        combos = (frequents.withColumn("i", F.row_number().over(order)).withColumn("next", F.lead("token").over(order))
                  .where(F.col("next").isNotNull() & (F.col("i") < 2 + broken - 2 * F.col("r")))
                  .select("row", "n", F.xxhash64("token", "next").alias("combo")))
        return (self.store.put(singles, "singles"), self.store.put(combos, "combos"), self.store.put(lasts, "lasts"))

    def alike_marks(self) -> Column:
        """Whether the signatures of a pair differ in no more bits than its sets may in tokens."""
        bits = reduce(lambda x, y: x + y, [F.bit_count(F.col(w + "1").bitwiseXOR(F.col(w + "2"))) for w in WORDS])
        return (100 + self.percent) * bits <= (100 - self.percent) * (F.col("n1") + F.col("n2"))

    def combo_pairs(self, has: DataFrame) -> DataFrame:
        """(x, y) of the entries (combo, row, n, least, signature) whose documents meet in a
        list and are alike by size and marks; with a column root, of different roots only; with
        a column main, one of the list's roots, its documents aren't compared with each other."""
        one, two = (has.select("combo", *(F.col(c).alias(f"{c}{i}") for c in has.columns if c != "combo")) for i in (1, 2))
        once = F.col("row1") < F.col("row2")
        if "main" in has.columns:
            one, once = one.where("root1 <> main1"), once | (F.col("root2") == F.col("main2"))
        met = one.join(two, "combo").where(once & self.alike_sizes("n1", "n2") & self.alike_marks())
        met = met.where("root1 <> root2") if "root" in has.columns else met
        # All lists that both are in lead to the same pair: the first of the least shared will do.
        first = F.array_min(F.array_intersect("least1", "least2"))
        met = met.where(F.coalesce(first == F.col("combo"), F.lit(True)))
        return met.select(F.least("row1", "row2").alias("x"), F.greatest("row1", "row2").alias("y"))

    def alike_sizes(self, n1: Column | str, n2: Column | str) -> Column:
        return 100 * F.least(n1, n2) >= self.percent * F.greatest(n1, n2)

    def single_pairs(self, singles: DataFrame, lasts: DataFrame) -> DataFrame:
        """(x, y) that share rare prefix tokens, enough for the similarity: of two
        prefixes the one that ends first holds all that is shared up to its end."""
        n1, n2 = F.floor(F.col("code1") / 2), F.floor(F.col("code2") / 2)
        one, two = (singles.select(F.col("row").alias(f"row{i}"), F.col("code").alias(f"code{i}"), "token") for i in (1, 2))
        pairs = (one.join(two, "token").where((F.col("row1") < F.col("row2")) & self.alike_sizes(n1, n2))
                 .groupBy("row1", "row2", "code1", "code2").agg(F.count("*").alias("c")))
        o = F.ceil(self.percent * (n1 + n2) / (100 + self.percent))
        z1, z2 = (o - ceil_div(self.percent * n, 100) + 1 for n in (n1, n2))
        heavy = (F.col("code1") % 2 == 1) & (F.col("code2") % 2 == 1)
        pairs = self.store.put(pairs.where(heavy | (F.col("c") >= F.least(z1, z2))), "pairs-met")
        a, b = (lasts.select(F.col("row").alias(f"row{i}"), F.col("last").alias(f"last{i}")) for i in (1, 2))
        both = pairs.join(a, "row1", "left").join(b, "row2", "left")
        need = F.when(F.col("last1") <= F.col("last2"), z1).when(F.col("last1") > F.col("last2"), z2).otherwise(F.lit(0))
        return self.store.put(both.where(F.col("c") >= need).select(F.col("row1").alias("x"), F.col("row2").alias("y")),
                              "pairs")

    def verify(self, pairs: DataFrame, tokens: DataFrame) -> DataFrame:
        """Those of the pairs (x, y) that are linked, stored. Of the tokens only those of
        the pairs' documents are moved."""
        pairs = self.store.put(pairs, "asked")
        xs = self.store.put(pairs.select(F.col("x").alias("row")).distinct(), "asked-x")
        first = tokens.join(sized(xs, self.most_rows), "row", "left_semi").select(
            F.col("row").alias("x"), F.col("n").alias("n1"), F.col("t").alias("t1"))
        second = tokens.select(F.col("row").alias("y"), F.col("n").alias("n2"), F.col("t").alias("t2"))
        both = F.size(F.array_intersect("t1", "t2"))
        return self.store.put(second.join(sized(pairs, self.most_rows), "y").join(first, "x")
                              .where(100 * both >= self.percent * (F.col("n1") + F.col("n2") - both)).select("x", "y"),
                              "links")

    def pivots(self, has: DataFrame, turn: int) -> DataFrame:
        """(x, y) of entries as for ``combo_pairs``: the documents of a list meet the ``HUBS``
        of the list, the first by a hash that differs between lists and turns, where both are
        alike by size and marks and, with a column root, of different roots. Only the lists
        of a document's least combinations take part: at most ``HUBS`` rows an entry."""
        has = has.where(F.array_contains("least", F.col("combo")))
        drawn = Window.partitionBy("combo").orderBy(F.xxhash64("row", "combo", F.lit(turn)), "row")
        hubs = has.withColumn("nth", F.row_number().over(drawn)).where(F.col("nth") <= HUBS)
        names = [c for c in has.columns if c in ("row", "n", "root", *WORDS)]
        one, two = (e.select("combo", *(F.col(c).alias(f"{c}{i}") for c in names)) for i, e in ((1, has), (2, hubs)))
        met = one.join(two, "combo").where((F.col("row1") != F.col("row2")) & self.alike_sizes("n1", "n2") & self.alike_marks())
        met = met.where("root1 <> root2") if "root" in names else met
        return met.select(F.least("row1", "row2").alias("x"), F.greatest("row1", "row2").alias("y")).distinct()

    def apart(self, pairs: DataFrame, comp: DataFrame) -> DataFrame:
        """Pairs whose documents are in different components so far."""
        a, b = (comp.select(F.col("row").alias(c), F.col("root").alias("root_" + c)) for c in "xy")
        both = pairs.join(a, "x", "left").join(b, "y", "left")
        return both.where(F.coalesce("root_x", "x") != F.coalesce("root_y", "y")).select("x", "y")

    def links(self, spanning: bool = True) -> DataFrame:
        """Verified links (x, y) between documents (rows) of different sets; with
        ``spanning`` as many as connect all that is linked, else every link."""
        singles, combos, lasts = self.index()
        self.store.drop("low", "low-counted", "high-counted", "facts", "marks", "rest", "rest-all")
        pairs = self.single_pairs(singles, lasts)
        self.store.drop("singles", "lasts", "pairs-met")
        wanted = pairs.select(F.explode(F.array("x", "y")).alias("row")).unionByName(
            combos.select("row")).distinct()
        wanted = self.store.put(wanted, "wanted")
        tokens = self.store.put(self.reps.join(sized(wanted, self.most_rows), "row", "left_semi")
                        .select("row", "n", F.concat("a", "b").alias("t")), "tokens")
        asked = sized(self.store.put(combos.select("row").distinct(), "combo-rows"), self.most_rows)
        marks = self.store.put(signatures(self.reps.join(asked, "row", "left_semi")).join(least_combos(combos), "row"), "signatures")
        self.store.drop("sets", "copies", "combo-rows")

        def entries(comp: DataFrame | None) -> DataFrame:
            has = combos.select("combo", "row", "n").join(sized(marks, self.most_rows // 8), "row")
            if comp is not None:
                has = has.join(comp, "row", "left").withColumn("root", F.coalesce("root", "row"))
                roots = has.groupBy("combo", "root").agg(F.count("*").alias("c"))
                mixed = roots.groupBy("combo").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("c", "root")).alias("main"))
                has = self.store.put(has.join(mixed.where("roots > 1").select("combo", "main"), "combo"), "mixed")
            return has

        if not spanning:
            found = self.verify(self.store.put(pairs.unionByName(self.combo_pairs(entries(None)).distinct()).distinct(), "all"), tokens)
            self.tidy()
            return found
        star = pairs.groupBy("y").agg(F.min("x").alias("x")).select("x", "y")
        found = self.verify(star.unionByName(self.pivots(entries(None), 0)).distinct(), tokens)
        comp = None
        for turn, last in ((1, False), (2, True)):
            nodes = components(found.select(F.col("x").alias("u"), F.col("y").alias("v")))
            comp = nodes.select(F.col("node").alias("row"), "root")
            left = self.apart(pairs, comp).unionByName(self.combo_pairs(entries(comp))) if last else self.pivots(entries(comp), turn)
            found = found.unionByName(self.verify(self.store.put(left.distinct(), "left"), tokens))
        self.tidy()
        return found

    def tidy(self) -> None:
        """Drop all tables but the members and the links."""
        self.store.drop(*(name for name in list(self.store.paths) if name not in ("members", "links")))


def placed_rows(docs: DataFrame, id_col: str, text_col: str, *, width: int = 4, percent: int = 85, zone: float = 0.25,
                frequent: int = 50, most_rows: int = 500_000, slice_bytes: int = 2 << 20) -> DataFrame:
    """(row, id, n, key, rep, root) of every row of ``docs``: its set's size and
    fingerprint, the first row of the same set, and the first of its component."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    join = Join(docs, id_col=id_col, text_col=text_col, width=width, percent=percent, zone=zone, frequent=frequent,
                most_rows=most_rows, slice_bytes=slice_bytes)
    links = join.links()
    roots = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))
    return join.members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "row", "id", "n", "key", "rep", F.coalesce("root", "rep").alias("root"))


def ngram_jaccard_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                       percent: int = 85, zone: float = 0.25, frequent: int = 50, most_rows: int = 500_000,
                       slice_bytes: int = 2 << 20) -> DataFrame:
    """Per row of ``docs``: the id, ``n_shingles`` (distinct ``width``-word shingles,
    A-Z lower-cased; of a shorter text the whole sequence is one),
    ``component_id`` (the smallest id reachable over links: a similarity of
    ``percent`` hundredths or more, in whole numbers) and ``n_same`` (rows of the
    same set, itself included).

    Texts that are null or have no words are empty sets and linked with
    nothing, not even one another: they keep their own id, ``n_same`` is 1.
    Repeated rows are linked rows; null ids take part, and are passed over for
    the smallest id. Tables of up to ``most_rows`` row numbers, counted first,
    are broadcast.
    """
    placed = placed_rows(docs, id_col, text_col, width=width, percent=percent, zone=zone, frequent=frequent,
                         most_rows=most_rows, slice_bytes=slice_bytes)
    smallest = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    same = placed.groupBy("rep").agg(F.count("*").alias("n_same"))
    return placed.join(smallest, "root").join(same, "rep").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_same")


def fingerprints(texts: pa.Array, width: int) -> pa.Array:
    """Per text the key of its set; null if it is empty."""
    import xxhash

    counts, values = shingle_sets(texts, width)
    return pa.array([xxhash.xxh3_128_digest(values[e - n:e].tobytes()) if n else None
                     for e, n in zip(np.cumsum(counts), counts, strict=True)], pa.binary())


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                percent: int = 85, most_rows: int = 500_000, slice_bytes: int = 1 << 19) -> DataFrame:
    """The rows of ``docs``, of each component only the one of the smallest id (any of
    them, if several have it or all ids are null), with all their columns. Rows
    without words are in no component and stay."""
    store = Store(docs.sparkSession, "op3-kept")
    placed = placed_rows(docs, id_col, text_col, width=width, percent=percent, most_rows=most_rows, slice_bytes=slice_bytes)
    placed = store.put(placed.where("key is not null"), "placed")
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("x"))
    kept = placed.join(first.select("root", F.col("x.row").alias("first")), "root")
    # A row is known by id and set. One that goes is among those of which none stays;
    # where one of several equal rows stays, the others go by their number.
    known = kept.groupBy("id", "key").agg(F.count("*").alias("n"), F.max((F.col("row") == F.col("first")).cast("int")).alias("stays"))
    known = store.put(known.where("stays = 0 or n > 1"), "known")
    store.drop("placed")

    @F.arrow_udf("binary")
    @trimmed
    def key(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            slices = byte_slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text", slice_bytes)
            yield pa.concat_arrays([pa.array([], pa.binary()), *(fingerprints(b.column("text"), width) for b in slices)])

    key_name = "_key"
    while key_name in docs.columns:
        key_name += "_"
    keyed = docs.withColumn(key_name, key(F.col(text_col)))

    def without(rows: DataFrame, of: DataFrame, how: str) -> DataFrame:
        of = sized(of, most_rows).select(F.col("id").alias("_i"), F.col("key").alias("_k"))
        return rows.join(of, rows[id_col].eqNullSafe(F.col("_i")) & (rows[key_name] == F.col("_k")), how)

    rest = without(keyed, store.put(known.where("stays = 0"), "gone"), "left_anti")
    several = store.put(known.where("stays = 1"), "several")
    if several.limit(1).count():
        rest = without(rest, several, "left_anti").unionByName(
            without(rest, several, "left_semi").dropDuplicates([id_col, key_name]))
    return rest.drop(key_name)
