"""Language identification by interpolated Kneser-Ney character models.

One model per language, learnt from a bounded sample of labelled rows. A model
is a sorted array of n-gram hashes with the discounted probabilities, and a
sorted array of context hashes with the back-off weights; a lookup is a binary
search. Contexts end at word borders, so a word has the same cost wherever it
stands: each distinct word of a batch is scored once. The language of the
lowest cross-entropy per character wins. For the rejection each part of a text
is taken at its cheapest language, so that texts in several learnt languages
stay; a text is rejected if that costs more than a bound between what held-back
texts cost with their own language's model and what they cost without it.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._common import byte_slices, mix64, trimmed

BASE_SYMBOLS = 1 << 11  # the uniform distribution under order 1
FEW = 30  # foreign texts that a language's own bound asks for
WIDE = 0.4  # nats a symbol


@functools.cache
def letters() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def symbols(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every symbol to predict (each letter, and the end of each run of
    letters): the index of its word, its gram hashes ``[order, n]`` (row k: the
    symbol after k symbols) and its context hashes (row k: the k symbols
    before). Contexts don't reach before the border of a run."""
    text = "\n".join(words).lower() + "\n"
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.cumsum(code == 10) - (code == 10)
    code = np.where(letters()[code], code, 0).astype(np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), code[:-1]])
    at = np.flatnonzero((code != 0) | (before != 0))
    symbol = code[at] + np.uint64(1)
    grams, contexts = np.empty((order, len(at)), np.uint64), np.empty((order, len(at)), np.uint64)
    inside = np.ones(len(at), bool)
    context = np.zeros(len(at), np.uint64)
    for k in range(order):
        if k:
            prev = np.where(inside & (at >= k), code[np.maximum(at - k, 0)], 0)
            inside &= prev != 0
            context = mix64(context * np.uint64(0x9E3779B97F4A7C15) + prev + np.uint64(k << 32))
        contexts[k] = context
        grams[k] = mix64(context ^ (symbol * np.uint64(0xD6E8FEB86659FD93)))
    return own[at], grams, contexts


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the weights of each."""
    if not len(keys):
        return keys, weights
    by = np.argsort(keys, kind="stable")
    keys, weights = keys[by], weights[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first)


def kneser_ney(words: list[str], counts: np.ndarray, order: int) -> list[tuple]:
    """Per order: gram hashes, discounted probabilities, context hashes, back-off
    weights. The highest order counts occurrences, lower ones the distinct
    symbols before; the discount is n1 / (n1 + 2 n2) of the order."""
    own, grams, contexts = symbols(words, order)
    weight, out = counts[own].astype(np.float64), []
    for k in range(order):
        if k == order - 1:
            g, n = summed(grams[k], weight)
            where = np.searchsorted(g, grams[k])
        else:  # a gram counts once for each longer gram that ends in it
            longer, at = np.unique(grams[k + 1], return_index=True)
            g, n = summed(grams[k][at], np.ones(len(at)))
            where = np.searchsorted(g, grams[k])
        context = np.zeros(len(g), np.uint64)
        context[where] = contexts[k]
        n1, n2 = np.sum(n == 1), np.sum(n == 2)
        cut = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
        c, total = summed(context, n)
        _, kinds = summed(context, np.ones(len(n)))
        of = np.searchsorted(c, context)
        out.append((g, np.maximum(n - cut, 0) / total[of], c, cut * kinds / total))
    return out


@dataclasses.dataclass
class Model:
    """Tables over the union of all languages' grams; column l is language l."""

    langs: list[str]
    order: int
    grams: list[np.ndarray]
    probs: list[np.ndarray]
    contexts: list[np.ndarray]
    backs: list[np.ndarray]
    bound: np.ndarray | None = None

    def costs(self, words: list[str]) -> np.ndarray:
        """Per word: the cost in nats under each language, and its symbols."""
        k = len(self.langs)
        own, grams, contexts = symbols(words, self.order)
        p = np.full((len(own), k), 1.0 / BASE_SYMBOLS)
        for n in range(self.order):
            p *= self.backs[n][lookup(self.contexts[n], contexts[n])]
            p += self.probs[n][lookup(self.grams[n], grams[n])]
        cost = -np.log(p)
        out = np.empty((len(words), k + 1))
        for j in range(k):
            out[:, j] = np.bincount(own, cost[:, j], len(words))
        out[:, k] = np.bincount(own, minlength=len(words))
        return out


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Row of each wanted key; the last row, of unknown keys, if there is none."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, len(keys)) if len(keys) else at


def united(parts: dict[str, list[tuple]], order: int) -> Model:
    langs = sorted(parts)
    made: list[list] = [[], [], [], []]
    for n in range(order):
        for keys_at, fill in ((0, 0.0), (2, 1.0)):
            keys = np.unique(np.concatenate([parts[x][n][keys_at] for x in langs]))
            values = np.full((len(keys) + 1, len(langs)), fill, np.float32)
            for j, x in enumerate(langs):
                values[np.searchsorted(keys, parts[x][n][keys_at]), j] = parts[x][n][keys_at + 1]
            made[keys_at].append(keys)
            made[keys_at + 1].append(values)
    return Model(langs, order, *made)


def text_costs(model: Model, texts: pa.Array, cache: dict[str, np.ndarray] | None = None,
               cache_words: int = 100_000, part_words: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: costs under each language and the number of symbols. The same per
    part of ``part_words`` words, those with digits (keys, codes) left out, and the
    text of each part."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    each = np.zeros((len(words), len(model.langs) + 1))
    if cache is not None and len(cache) > cache_words:
        cache.clear()
    known = [cache.get(w) for w in words] if cache else [None] * len(words)
    new = [i for i, x in enumerate(known) if x is None]
    old = [i for i, x in enumerate(known) if x is not None]
    if old:
        each[old] = [known[i] for i in old]
    for at in range(0, len(new), 10_000):  # bounds the memory for their symbols
        part = new[at:at + 10_000]
        each[part] = costs = model.costs([words[i] for i in part])
        if cache is not None:
            cache.update((words[i], c) for i, c in zip(part, costs, strict=True) if len(words[i]) <= 32)
    offsets, index = lists.offsets.to_numpy(), coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
    no_digit = ~pc.match_substring_regex(coded.dictionary, "[0-9]").to_numpy(zero_copy_only=False)[index]
    starts = (np.arange(len(owner)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))) % part_words == 0
    part, of = np.cumsum(starts) - 1, owner[starts]
    parts, out = np.empty((len(of), each.shape[1])), np.empty((len(lists), each.shape[1]))
    for j in range(each.shape[1]):
        one = each[index, j]
        parts[:, j] = np.bincount(part, one * no_digit, len(of))
        out[:, j] = np.bincount(owner, one, len(lists))
    return out, parts, of


def cross_entropy(costs: np.ndarray) -> np.ndarray:
    return costs[:, :-1] / np.maximum(costs[:, -1:], 1)


def strangeness(costs: np.ndarray, parts: np.ndarray, of: np.ndarray, short_slack: float) -> np.ndarray:
    """Per text: nats a symbol with each part at its cheapest language, less
    ``short_slack`` over the root of the number of symbols; of a text that has
    letters only in words with digits, as a whole."""
    count, total = np.bincount(of, parts[:, -1], len(costs)), np.bincount(of, parts[:, :-1].min(axis=1), len(costs))
    total = np.where(count > 0, total, costs[:, :-1].min(axis=1))
    count = np.maximum(np.where(count > 0, count, costs[:, -1]), 1)
    return total / count - short_slack / np.sqrt(count)


def bounds(calibration: np.ndarray, langs: int, slack: float) -> np.ndarray:
    """Per language the strangeness from which a text is rejected. ``calibration``: a
    row per held-back text, of its language, the cheapest one, the strangeness,
    and the cheapest other language and the strangeness without the own model
    (infinite if there is no other)."""
    own, best, usual, other, foreign = calibration.T
    out = np.full(langs, np.inf)
    fits = own == best  # texts cheaper in another language are labelled wrongly
    for j in range(langs):
        mine = usual[fits & (own == j)] if (fits & (own == j)).any() else usual[own == j]
        if not len(mine):
            continue
        strange = foreign[fits & (other == j) & np.isfinite(foreign)]
        if len(strange) < FEW:  # too few are nearest to this language: those of all languages
            strange = foreign[fits & np.isfinite(foreign)]
        high = np.max(mine)
        if not len(strange):  # one language alone: against equal chances for all symbols
            middle = np.median(mine)
            out[j] = max(middle + slack * (np.log(BASE_SYMBOLS) - middle), np.quantile(mine, 0.995))
            continue
        low = np.quantile(strange, 0.02)
        if high >= low:  # a few odd texts don't decide
            high = np.quantile(mine, 0.99)
        gap = low - high
        out[j] = high + max(min(0.65 * gap, max(0.25 * gap, WIDE)), 0.1)
    return out


def word_table(texts: pa.Array) -> tuple[list[str], np.ndarray]:
    found = pc.value_counts(pc.ascii_split_whitespace(texts).flatten())
    return found.field(0).to_pylist(), found.field(1).to_numpy()


def train(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", key: Column, order: int = 4,
          max_docs: int = 500, max_chars: int = 1_500_000, rest_docs: int = 200,
          slack: float = 0.4, short_slack: float = 3.0) -> Model | None:
    """Fit on a bounded sample: of each language the ``max_docs`` rows first by the
    hash of ``key``, whole texts, as far as ``max_chars`` characters in all. The
    next ``rest_docs`` rows calibrate the rejection in the same way: the bound lies
    between their largest cost and what one in 50 texts that are nearest to this
    language without their own model falls below (of all languages' texts, if fewer
    than ``FEW`` are). It lies 0.65 of the way, but where the sides are far apart no
    more than a quarter or ``WIDE``, as languages that nothing was learnt from may
    cost less than the learnt ones do under one another. If the sides overlap, it is
    counted from the cost that one in 100 exceeds, and lies 0.1 over it at least. Of
    a single language it lies ``slack`` of the way from the median cost to that of
    equal chances for all symbols. ``short_slack`` is that of ``identify``.

    Rows of over an eighth of ``max_chars`` are taken last, the shortest first, so
    that a long one doesn't end the sample; a language always has its first row,
    however long. So a language's model has at most ``max_chars`` grams an order,
    or as many as its shortest text has characters, which is what the driver gets.
    Rows of null language or text are left out. No rows: None."""
    kept = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(key).alias("h"),
        F.length(text_col).cast("bigint").alias("n"))
    kept = kept.where("n > 0").withColumn("long", F.when(F.col("n") > max_chars // 8, F.col("n")))
    # Far more rows than needed pass this bound of the hash, but a bounded number, so
    # that no language gathers in one task what it has in all.
    share = F.least(F.lit(1.0), F.lit(8.0 * (max_docs + rest_docs)) / F.col("rows"))
    rows = kept.groupBy("lang").agg(F.count("*").alias("rows"))
    # One row per language, of which the driver gets a whole model below.
    kept = kept.join(F.broadcast(rows), "lang").where(F.col("h") / 2.0**64 + 0.5 <= share).drop("rows")
    by = Window.partitionBy("lang").orderBy(F.asc_nulls_first("long"), "h", "n", F.xxhash64("text"))
    first = kept.withColumn("r", F.row_number().over(by)).where(F.col("r") <= max_docs + rest_docs)
    first = (first.withColumn("rest", F.col("r") > max_docs)
             .withColumn("sum", F.sum("n").over(Window.partitionBy("lang", "rest").orderBy("r")))
             .where((F.col("sum") <= max_chars) | (F.col("r") == 1)))

    def fit(key, part):
        words, counts = word_table(part["text"].combine_chunks())
        got = kneser_ney(words, counts, order)
        rows = [{"lang": key[0].as_py(), "n": n, "g": g.tobytes(), "p": p.astype(np.float32).tobytes(),
                 "c": c.tobytes(), "b": b.astype(np.float32).tobytes()} for n, (g, p, c, b) in enumerate(got)]
        return pa.Table.from_pylist(rows, pa.schema([("lang", pa.string()), ("n", pa.int32())] +
                                                    [(x, pa.binary()) for x in "gpcb"]))

    rows = (first.where(~F.col("rest")).select("lang", "text").groupBy("lang")
            .applyInArrow(fit, "lang string, n int, g binary, p binary, c binary, b binary").collect())
    parts: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.n)):
        parts.setdefault(r.lang, []).append((np.frombuffer(r.g, np.uint64), np.frombuffer(r.p, np.float32),
                                             np.frombuffer(r.c, np.uint64), np.frombuffer(r.b, np.float32)))
    if not parts:
        return None
    model = united(parts, order)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @trimmed
    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            costs, parts, of = text_costs(shared.value, b.column("text"))
            own = np.array([shared.value.langs.index(x) for x in b.column("lang").to_pylist()], np.int64)
            some, each = costs[:, -1] > 0, cross_entropy(costs)
            best, usual = each.argmin(axis=1), strangeness(costs, parts, of, short_slack)
            each[np.arange(len(own)), own] = np.inf
            costs[np.arange(len(own)), own] = parts[np.arange(len(of)), own[of]] = np.inf
            columns = (own, best, usual, each.argmin(axis=1), strangeness(costs, parts, of, short_slack))
            yield pa.RecordBatch.from_arrays([pa.array(x[some].astype(np.float64)) for x in columns],
                                             ["l", "best", "usual", "other", "foreign"])

    spare = (first.withColumn("most", F.max("r").over(Window.partitionBy("lang")))
             .where(F.col("rest") | (F.col("most") <= max_docs)))  # few rows: the fitted ones must do
    rows = spare.select("lang", "text").mapInArrow(
        cost, "l double, best double, usual double, other double, foreign double").collect()
    model.bound = bounds(np.array(rows, np.float64).reshape(-1, 5), len(model.langs), slack)
    return model


class Predictor:
    """Predictions for the texts of Arrow batches, by a model that may be None."""

    def __init__(self, model: Model | None, short_slack: float):
        self.model, self.short_slack, self.cache = model, short_slack, {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, entropy and rejection of each text."""
        n, m = len(texts), self.model
        pred = np.full(n, "und", object)
        if m is None or not n:
            return pred, np.zeros(n), np.zeros(n), np.ones(n, bool)
        costs, parts, of = text_costs(m, pc.fill_null(texts, ""), self.cache)
        each, count = cross_entropy(costs), costs[:, -1]
        best = each.argmin(axis=1)
        h, some = each[np.arange(n), best], count > 0
        share = np.exp(-np.minimum(count, 50)[:, None] * (each - h[:, None]))
        pred[some] = np.array(m.langs, object)[best[some]]
        bad = ~some | (strangeness(costs, parts, of, self.short_slack) > m.bound[best])
        return pred, np.where(some, 1 / share.sum(axis=1), 0.0), np.where(some, h, 0.0), bad


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text",
             short_slack: float = 3.0, slice_bytes: int = 2 << 20) -> DataFrame:
    """Per row of ``docs``: the id, ``lang_pred``, ``score`` (0 to 1: the share of
    the language among all by likelihood, of at most 50 symbols' weight),
    ``entropy`` (nats a symbol) and ``rejected``.

    ``und`` with score 0, rejected: a text that is null or has no letter, and all
    rows if no model could be learnt. Ties go to the first language by name. A
    text is rejected if the cost of its parts, each in its cheapest language,
    exceeds the calibrated bound, which is wider by ``short_slack`` over the root of
    its number of symbols. Repeated rows give repeated results; an empty table none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @trimmed
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value, short_slack)
        for b in byte_slices(batches, "text", slice_bytes):
            pred, score, h, bad = predictor(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(pred, pa.string()), pa.array(score),
                                              pa.array(h), pa.array(bad)],
                                             ["id", "lang_pred", "score", "entropy", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        predict, f"id {kind}, lang_pred string, score double, entropy double, rejected boolean"
    ).withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model | None, *, text_col: str = "text", short_slack: float = 3.0,
             slice_bytes: int = 2 << 20) -> DataFrame:
    """The rows of ``docs`` that ``identify`` doesn't reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Only texts go to Python; the rows wait in the JVM.
    @F.arrow_udf("boolean")
    @trimmed
    def fine(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predictor = Predictor(shared.value, short_slack)
        for texts in batches:
            slices = byte_slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text", slice_bytes)
            yield pa.concat_arrays([pa.array([], pa.bool_()), *(pa.array(~predictor(b.column("text"))[3]) for b in slices)])

    return docs.where(fine(docs[f"`{text_col}`"]))


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the rows, by id, is never learnt from (null ids neither)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def language_id(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that aren't held out and predict all; see ``train`` and
    ``identify`` for the columns and the cases. ``lang_col`` is only learnt from."""
    model = train(docs.where(~held_out(id_col)), lang_col=lang_col, text_col=text_col, key=F.col(id_col))
    return identify(docs, model, id_col=id_col, text_col=text_col).select(
        id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
