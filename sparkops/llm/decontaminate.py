"""Benchmark decontamination with a distributed positional inverted index.

The index holds the postings (term, document row, position) of every training
token whose term occurs in the benchmark. It is written once, in segments: each
task sorts its postings by term, so a term's list is contiguous in every
segment, and no posting is shuffled. A test window is looked up from its rarest
terms: the lists of the two rarest are intersected after adjusting their
offsets, and what is left is checked against the lists of all other terms.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ._common import Store, sized

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters a-z and non-ASCII characters, after lower-casing A-Z."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAKS), "")


def item_table(store: Store, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per benchmark row that has words."""
    one = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
                       words(F.col(text_col)).alias("words"))
    return store.put(one.where(F.size("words") > 0).distinct()
                  .withColumn("item", F.monotonically_increasing_id()), "items")


def build_index(store: Store, docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str, most_terms: int) -> DataFrame:
    """Postings (row, tid, pos) of ``docs``, stored. A document's last posting has the
    term -1 and its number of words as position, so the index also lists the
    documents; only these have id and mark, a hash of the text."""
    kept = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("words"),
                       F.xxhash64(text_col).alias("mark"), F.monotonically_increasing_id().alias("row"))
    each = kept.select("row", "id", "mark", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "term"))
    terms = store.put(vocabulary.select("term", "tid").unionByName(
        docs.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(-1).cast("bigint").alias("tid"))), "terms")
    last = F.col("tid") < 0
    return store.put(each.join(sized(terms, most_terms), "term")
                  .select("row", F.when(last, F.col("id")).alias("id"), F.when(last, F.col("mark")).alias("mark"), "tid", "pos")
                  .sortWithinPartitions("tid", "row", "pos"), "index")


def window_table(store: Store, items: DataFrame, vocabulary: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """A row per window of an item: its start, width, and offset and term of its
    two rarest words by the number of postings (of one, twice the same)."""
    counts = index.where("tid >= 0").groupBy("tid").agg(F.count("*").alias("df"))
    each = items.select("item", F.posexplode("words").alias("off", "term"))
    known = (each.join(vocabulary, "term").join(counts, "tid", "left")
             .groupBy("item").agg(F.sort_array(F.collect_list(F.struct(
                 "off", F.coalesce("df", F.lit(0)).alias("df"), "tid"))).alias("at")))
    w = F.least(F.size("at"), F.lit(width))
    cut = known.select("item", "at", w.alias("w"), F.explode(F.sequence(F.lit(0), F.size("at") - w)).alias("s"))
    rare = F.array_sort(F.transform(F.slice("at", F.col("s") + 1, F.col("w")),
                                    lambda x: F.struct(x["df"].alias("df"), x["off"].alias("off"), x["tid"].alias("tid"))))
    two = cut.withColumn("rare", rare).withColumn("r1", F.col("rare")[0]).withColumn(
        "r2", F.coalesce(F.try_element_at("rare", F.lit(2)), F.col("r1")))
    return store.put(two.where("r1.df > 0").select(
        "item", "s", "w", F.col("r1.off").alias("off1"), F.col("r1.tid").alias("tid1"), F.col("r2.off").alias("off2"),
        F.col("r2.tid").alias("tid2"), F.array_distinct(F.transform("rare", lambda x: x["tid"])).alias("tids")),
        "windows")


def matches(store: Store, index: DataFrame, items: DataFrame, vocabulary: DataFrame, *, width: int, slack: int,
            most_terms: int) -> tuple[DataFrame, DataFrame]:
    """Exact matches (row, item, pos, w: the window starts at pos) and proximity
    matches (row, item): no exact one, but all words of one window of the item
    within ``width - 1 + slack`` positions of its rarest word."""
    windows = window_table(store, items, vocabulary, index, width)
    reach = width - 1 + slack
    few = sized(windows.drop("tids"), most_terms)
    post = index.where("tid >= 0").select("row", "tid", "pos")
    # One list per distinct anchor: windows that share both rarest terms share it.
    anchors = few.select("item", "tid1", "off1", "tid2", "off2").distinct()
    anchors = store.put(anchors.withColumn("a", F.monotonically_increasing_id()), "anchors")
    near_by = sized(anchors, most_terms)
    first = post.join(near_by.select("a", F.col("tid1").alias("tid")), "tid").select(
        "a", "row", F.col("pos").alias("pos1"))
    second = post.join(near_by.select("a", F.col("tid2").alias("tid")), "tid").select(
        "a", "row", F.col("pos").alias("pos2"))
    b1, b2 = F.floor(F.col("pos1") / reach), F.floor(F.col("pos2") / reach)
    second = second.withColumn("b", F.explode(F.array(b2 - 1, b2, b2 + 1)))
    pairs = store.put(first.withColumn("b", b1).join(second, ["a", "row", "b"])
                   .where(F.abs(F.col("pos2") - F.col("pos1")) <= reach)
                   .join(near_by, "a").select("item", "row", "tid1", "off1", "tid2", "off2", "pos1", "pos2"),
                   "pairs")
    lines = (pairs.where("pos2 - pos1 = off2 - off1")
             .select("item", "row", (F.col("pos1") - F.col("off1")).alias("diag")).distinct())
    wanted = (items.select("item", F.posexplode("words").alias("off", "term")).join(vocabulary, "term")
              .select("item", "off", "tid"))
    there = store.put(pairs.select("row").distinct(), "rows")
    post = post.join(sized(there, 4 * most_terms), "row", "left_semi")
    expected = lines.join(wanted, "item").select("item", "row", "diag", "off", "tid",
                                                 (F.col("diag") + F.col("off")).alias("pos"))
    met = (post.join(expected, ["row", "pos", "tid"]).groupBy("item", "row", "diag")
           .agg(F.sort_array(F.collect_list("off")).alias("offs")))
    w = F.least(F.size("words"), F.lit(width)).alias("w")
    met = met.join(items.select("item", w), "item").where("size(offs) >= w")
    starts = F.filter(F.sequence(F.lit(0), F.size("offs") - F.col("w")),
                      lambda i: F.get("offs", i + F.col("w") - 1) - F.get("offs", i) == F.col("w") - 1)
    exact = store.put(met.select("item", "row", "diag", "w", "offs", F.explode(starts).alias("i"))
                   .select("item", "row", "w", (F.get("offs", F.col("i")) + F.col("diag")).alias("pos")), "exact")
    # Proximity: only where the item has no exact match in the document.
    rest = pairs.join(exact.select("item", "row").distinct(), ["item", "row"], "left_anti")
    rest = (rest.join(windows, ["item", "tid1", "off1", "tid2", "off2"])
            .select("item", "row", "s", "pos1", "tids").distinct())
    b = F.floor(F.col("pos1") / reach)
    spread = rest.select("*", F.explode(F.array(b - 1, b, b + 1)).alias("b"), ).select(
        "item", "row", "s", "pos1", "b", F.size("tids").alias("need"), F.explode("tids").alias("tid"))
    close = (spread.join(post.withColumn("b", F.floor(F.col("pos") / reach)), ["row", "b", "tid"])
             .where(F.abs(F.col("pos") - F.col("pos1")) <= reach)
             .groupBy("item", "row", "s", "pos1", "need").agg(F.count_distinct("tid").alias("have"))
             .where("have = need").select("item", "row").distinct())
    return exact, close


def judged(docs: DataFrame, benchmark: DataFrame, *, id_col: str, text_col: str, item_id_col: str, item_text_col: str,
           width: int, slack: int, share: int, most_terms: int) -> DataFrame:
    """``decontaminate`` with the columns id and ``mark`` (a hash of the text)."""
    store = Store(docs.sparkSession, "op6")
    items = item_table(store, benchmark, item_id_col, item_text_col)
    vocabulary = store.put(items.select(F.explode("words").alias("term")).distinct()
                           .withColumn("tid", F.monotonically_increasing_id()), "vocabulary")
    index = build_index(store, docs, vocabulary, id_col, text_col, most_terms)
    exact, close = matches(store, index, items, vocabulary, width=width, slack=slack, most_terms=most_terms)
    rows = store.put(index.where("tid = -1").select("row", "id", "mark", F.col("pos").cast("bigint").alias("n_words")), "documents")
    close = store.put(close, "close")
    store.drop("index", "pairs", "rows", "anchors", "windows", "terms", "vocabulary")
    hit = (exact.select("row", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("w") - 1)).alias("p"))
           .distinct().groupBy("row").agg(F.count("*").alias("n_hit")))
    ids = (exact.select("row", "item").distinct().join(items.select("item", "item_id"), "item")
           .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("ids")))
    near = close.groupBy("row").agg(F.count("*").alias("n_near"))
    zero = F.lit(0).cast("bigint")
    return (rows.join(hit.join(ids, "row"), "row", "left").join(near, "row", "left")
            .select("id", "mark", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                    F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"),
                    F.coalesce((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")),
                               F.lit(False)).alias("contaminated"),
                    F.coalesce("n_near", zero).alias("n_near")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", width: int = 13, slack: int = 13,
                  share: int = 20, most_terms: int = 200_000) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``n_hit`` (words inside an
    occurrence of a benchmark window of ``width`` words; an item of fewer words
    is one window), ``n_items`` (distinct item ids with occurring windows),
    ``items_sha256`` (of these ids as sorted text), ``contaminated`` (at least one
    word in ``share`` hit) and ``n_near`` (items met by proximity only).

    Null or wordless texts have no words and no hits; wordless items no windows.
    A null item id counts as the empty text; repeated documents are rows of
    their own, repeated items one. Empty tables give no rows, or no hits.
    Tables of at most ``most_terms`` narrow rows, counted first, are broadcast.
    """
    return judged(docs, benchmark, id_col=id_col, text_col=text_col, item_id_col=item_id_col,
                  item_text_col=item_text_col, width=width, slack=slack, share=share, most_terms=most_terms
                  ).drop("mark").withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", width: int = 13, share: int = 20,
          most_terms: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that ``decontaminate`` doesn't find contaminated, with all
    their columns. A row is known by its id and a 64-bit hash of its text."""
    bad = judged(docs, benchmark, id_col=id_col, text_col=text_col, item_id_col=item_id_col,
                 item_text_col=item_text_col, width=width, slack=width, share=share, most_terms=most_terms)
    store = Store(docs.sparkSession, "op6-clean")
    bad = sized(store.put(bad.where("contaminated").select(F.col("id").alias("_i"), F.col("mark").alias("_m")).distinct(),
                          "bad"), 4 * most_terms)
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("_i")) & (F.xxhash64(docs[text_col]) == F.col("_m")), "left_anti")
