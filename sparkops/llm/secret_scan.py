"""Secret scan with corpus-wide ownership frequency.

Every text is searched for credential patterns. The value of each candidate is
hashed, and the hashes are counted over the corpus by distinct repositories,
distinct owners and rows. A value of many owners, repositories or rows is a copied
example; one of few of each, dense enough to be a real key, looks live.
Free-standing keys (no name before them) are too uncertain to be reported by
their shape; they are reported only if the counts are those of a live value.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ._common import byte_slices, stored, trimmed

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
FREE = r"[A-Za-z0-9+/_=-]{%d,}"
# A text without any of these holds no candidate; the linear-time matcher of
# Arrow skips it before Python looks at it. (A free run of 20 with a digit has
# 10 characters before or after that digit.)
MAYBE = (r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"
         r"|[0-9][A-Za-z0-9+/_=-]{10}|[A-Za-z0-9+/_=-]{10}[0-9]")
_SPAN = "kind int, start bigint, stop bigint, value_hash string, dense boolean"


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def candidates(text: str, min_free: int, min_entropy: float) -> list[tuple]:
    """(kind, start, stop, value, dense) by start, then kind."""
    found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    found.sort(key=lambda x: (x[1], x[0]))
    stops, starts, far = [], [], -1
    for _, a, b, _ in found:  # union of the base spans, to keep free ones off them
        if a < far:
            far = max(far, b)
            stops[-1] = far
        else:
            starts.append(a)
            stops.append(b)
            far = b
    free, k = [], 0
    for m in re.finditer(FREE % min_free, text):
        a, b = m.span()
        while k < len(stops) and stops[k] <= a:
            k += 1
        if k < len(stops) and starts[k] < b:
            continue
        v = m[0]
        if re.search("[0-9]", v) and re.search("[A-Z]", v) and re.search("[a-z]", v) and entropy(v) >= min_entropy:
            free.append((3, a, b, v))
    return sorted(((k, a, b, v, entropy(v) >= min(min_entropy, 3.0)) for k, a, b, v in found + free),
                  key=lambda x: (x[1], x[0]))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, *_ in spans)


def scan(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column, min_free: int,
         min_entropy: float, slice_bytes: int) -> DataFrame:
    """A row per document: base digest and counts, and all candidates."""
    @trimmed
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for b in byte_slices(batches, "text", slice_bytes):
            hit = pc.fill_null(pc.match_substring_regex(b.column("text"), MAYBE), False)
            at = pc.indices_nonzero(hit)
            n = b.num_rows
            counts = [[0] * n for _ in range(3)]
            digest, spans = [nothing] * n, [[] for _ in range(n)]
            for i, text in zip(at.to_pylist(), b.column("text").take(at).to_pylist(), strict=True):
                found = candidates(text, min_free, min_entropy)
                base = [x for x in found if x[0] < 3]
                for x in base:
                    counts[x[0]][i] += 1
                digest[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                spans[i] = [{"kind": k, "start": s, "stop": e, "dense": d,
                             "value_hash": hashlib.sha256(v.encode()).hexdigest()} for k, s, e, v, d in found]
            made = pa.array(spans, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()),
                                                       ("stop", pa.int64()), ("value_hash", pa.string()),
                                                       ("dense", pa.bool_())])))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("repo"), b.column("owner"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digest), made],
                ["id", "repo", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), repo.cast("string").alias("repo"),
                       owner.cast("string").alias("owner"))
    return read.mapInArrow(search, f"id {kind}, repo string, owner string, n_assign bigint, n_access bigint, "
                                   f"n_hex bigint, base_sha256 string, found array<struct<{_fields()}>>")


def _fields() -> str:
    return ", ".join(f"{f.split()[0]}:{f.split()[1]}" for f in _SPAN.split(", "))


def ownership(scanned: DataFrame) -> DataFrame:
    """Per value hash: rows, distinct repositories and distinct owners. Null
    repositories and owners count as one, unnamed, each. Pairs are made distinct
    map-side first, so a value copied to a third of the corpus shuffles as the
    number of its repositories and owners, not of its copies."""
    one = scanned.select(F.explode(F.array_distinct("found.value_hash")).alias("value_hash"),
                         F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner"))
    pairs = one.groupBy("value_hash", "repo", "owner").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("value_hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos_of_owner"))
    repos = pairs.select("value_hash", "repo").distinct().groupBy("value_hash").agg(F.count("*").alias("n_repos"))
    return (owners.groupBy("value_hash").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_owners"))
            .join(repos, "value_hash"))


def with_verdicts(each: DataFrame, verdicts: DataFrame, parts: int = 1000) -> DataFrame:
    """Candidates with the verdict on their value. Values that hold more than one in
    ``parts`` of all (row, value) pairs, of which there are fewer than ``parts``, are
    broadcast, so that no task gets all copies of a value; the others are joined."""
    bound = (verdicts.agg(F.sum("n_rows")).first()[0] or 0) // parts
    often = F.broadcast(verdicts.where(F.col("n_rows") > bound))
    hot = each.join(often, "value_hash")
    cold = each.join(often.select("value_hash"), "value_hash", "left_anti")
    return hot.unionByName(cold.join(verdicts.where(F.col("n_rows") <= bound), "value_hash"))


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source",
                owner_col: str = "source", min_free: int = 20, min_entropy: float = 3.5, live_owners: int = 1,
                live_repos: int = 2, live_rows: int = 8, example_owners: int = 3, example_repos: int = 3,
                example_rows: int = 32, slice_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``docs``: the id, counts of the three base kinds, the sha256 of
    the base spans, ``spans`` (base ones and the added kind ``owned``, as
    kind:start:end in code points, by start and kind), and of the spans reported:
    ``n_live`` (dense values that look live: of at most ``live_owners`` owners,
    ``live_repos`` repositories and ``live_rows`` rows) and ``n_example`` (of at
    least ``example_owners`` owners, ``example_repos`` repositories or
    ``example_rows`` rows). A row counts once, however often it holds the value.

    A base span is the whole match. ``owned`` spans are runs of ``min_free`` or
    more key characters with both letter cases and a digit, off the base spans,
    of ``min_entropy`` bits a character, whose value looks live. Null and empty
    texts have no spans. Repeated rows count as rows of one repository and owner;
    they are returned a row each.
    """
    if min_free < 20:
        raise ValueError("min_free must be 20 or more")
    # Both branches below must see the same row numbers, so they are stored.
    found = stored(scan(docs, id_col, text_col, F.col(repo_col), F.col(owner_col), min_free, min_entropy,
                        slice_bytes).withColumn("row", F.monotonically_increasing_id()), "op1-scan")
    each = found.select("row", F.explode("found").alias("x")).select("row", "x.*")
    live = ((F.col("n_owners") <= live_owners) & (F.col("n_repos") <= live_repos) & (F.col("n_rows") <= live_rows))
    example = ((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
               | (F.col("n_rows") >= example_rows))
    verdicts = stored(ownership(found).select("value_hash", "n_rows", live.alias("live"), example.alias("example")),
                      "op1-verdicts")
    judged = with_verdicts(each, verdicts).where("kind < 3 or live")
    text = F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1), "start", "stop")
    per_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", text.alias("t")))).alias("s"),
        F.count_if(F.col("live") & F.col("dense")).alias("n_live"), F.count_if("example").alias("n_example"))
    zero = F.lit(0).cast("bigint")
    return (found.drop("found", "repo", "owner").join(per_row, "row", "left")
            .select(F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256",
                    F.coalesce(F.concat_ws(",", "s.t"), F.lit("")).alias("spans"),
                    F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example")))
