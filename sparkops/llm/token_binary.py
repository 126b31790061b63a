"""Token ids in a compressed binary format.

A file row is a block: some consecutive documents (ids and lengths), the number
of tokens, the crc32 of these, and the code of a range coder. A block resets
the model, so any block is read alone and a damaged one is found by its
checksum and harms no other.

The model predicts an id from order 2 (the two ids before), order 1 (the one
before) and order 0 (how often the block holds each id: a table before the
code). The chances of the three are mixed by adaptive weights, which depend on
how well the two contexts predicted so far; where both predict the same id,
their weights add up. The mixture drives a carry-propagating range coder with a
low end of 60 bits, one step an id. Blocks are coded side by side, one token of
each at a time, with array operations.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.taskcontext import TaskContext

from ._common import byte_slices, list_array, scratch_path, stored, trimmed
from .token_counts import encoder, spread

MAGIC = b"tcm2"
HEAD = len(MAGIC) + 4  # with the checksum of the code
TABLE = 11  # bits of the hash table of the order-2 contexts
LEVELS = 4  # how often a context's prediction has come true, at most 3
TOTAL = 22  # bits of the chances of one step
STEP = 124  # of 2**TOTAL for a weight of 1: orders 2 and 1 get at most 31 of 32
LOW, WORD = 60, 32  # bits of the coder's low end and of a word of code
LEAST = 1 << (LOW - WORD)
MOST_IDS = 1 << 15  # of a block


class Tables:
    """Order 0 of several blocks (lanes): which ids a block holds and how often. A
    block's ids are numbered in ascending order (ranks), and the chance of a rank is
    its share of the block, in units of ``1 << bits`` of its lane."""

    def __init__(self, counts: list[np.ndarray], sizes: np.ndarray):
        distinct = np.fromiter(map(len, counts), np.int64, len(counts))
        self.base = np.cumsum(distinct) - distinct
        flat = np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64)
        self.bits = np.frexp(np.maximum(sizes - 1, 0).astype(np.float64))[1].astype(np.int32)
        self.shares = np.int64(1) << self.bits.astype(np.int64)
        n, bits = np.repeat(np.maximum(sizes, 1), distinct), np.repeat(self.bits.astype(np.int64), distinct)
        ends = np.cumsum(flat)
        ends -= np.repeat(np.cumsum(sizes) - sizes, distinct)
        begin, end = ((ends - flat) << bits) // n, (ends << bits) // n
        self.packed = (begin << 15 | (end - begin - 1)).astype(np.int32)
        self.ranks = np.arange(len(flat)) - np.repeat(self.base, distinct)
        self.widths = end - begin


class Model:
    """State of the predictions of several blocks (lanes) at once. Orders 2 and 1 keep
    for each context the rank that they expect and how sure they are of it."""

    def __init__(self, tables: Tables):
        lanes = len(tables.base)
        self.tables = tables
        kind = np.uint16 if tables.ranks.max(initial=0) < 1 << 14 else np.int32
        self.known1 = np.zeros(len(tables.packed) + 1, kind)  # rank times LEVELS, plus the level
        self.known2 = np.zeros(lanes << TABLE, kind)
        self.weight2 = np.full(lanes * LEVELS**2, 1 << 14, np.int32)
        self.weight1 = self.weight2.copy()
        self.slot1 = tables.base.copy()  # as if rank 0 had come before
        self.hashed = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self.lane2 = np.arange(lanes) << TABLE
        self.lane_context = np.arange(lanes) * LEVELS**2

    def predict(self, n: int) -> None:
        """Set guesses and chances for the first ``n`` lanes: order 2 takes the chances
        below ``end2``, order 1 those below ``end1``, and of the rest a rank of order 0
        takes ``unit`` times its share."""
        self.slot2 = ((self.hashed[:n] ^ self.before[:n]) >> 20 & ((1 << TABLE) - 1)) + self.lane2[:n]
        self.k1, self.k2 = self.known1.take(self.slot1[:n]), self.known2.take(self.slot2)
        self.g1, self.g2 = self.k1 >> 2, self.k2 >> 2
        self.context = self.lane_context[:n] + ((self.k2 & 3) << 2 | self.k1 & 3)
        self.w1, self.w2 = self.weight1.take(self.context), self.weight2.take(self.context)
        end2 = (self.w2 + 1) * STEP
        end1 = end2 + (((STEP << 15) - end2 >> 6) * self.w1 >> 9) + STEP
        bits = self.tables.bits[:n]
        self.unit = (1 << TOTAL) - end1 >> bits
        self.end1 = (1 << TOTAL) - (self.unit << bits)
        self.end2 = np.where(self.g1 == self.g2, self.end1, end2)

    def interval(self, at: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of what came, which lies at place ``at`` of the tables."""
        packed = self.tables.packed.take(at)
        start = np.where(hit1, self.end2, self.end1 + self.unit * (packed >> 15))
        size = np.where(hit1, self.end1 - self.end2, self.unit * ((packed & 0x7FFF) + 1))
        return np.where(hit2, 0, start), np.where(hit2, self.end2, size)

    def update(self, ranks: np.ndarray, at: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit1``: order 1 was right, whether or not order 2 was, too."""
        n = len(ranks)
        anew = ranks << 2
        for known, slot, k, hit in ((self.known2, self.slot2, self.k2, hit2), (self.known1, self.slot1[:n], self.k1, hit1)):
            full = k | 3
            # A miss halves a level of 2 or 3, and else the guess is replaced.
            known[slot] = np.where(hit, np.minimum(k + 1, full), np.where(k & 2, full - 2, anew))
        self.weight2[self.context] = self.w2 + ((hit2 * np.int32(32767)) - self.w2 >> 5)
        # Order 1 is asked only if order 2 has failed.
        moved = self.w1 + ((hit1 * np.int32(32767)) - self.w1 >> 5)
        self.weight1[self.context] = np.where(hit2, self.w1, moved)
        self.before[:n] = self.hashed[:n] * 0x2545F491 & 0xFFFFFFFF
        self.hashed[:n] = ranks * np.int64(0x9E3779B1) & 0xFFFFFFFF
        self.slot1[:n] = at


def packed_numbers(numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers below 2**35, 7 bits a byte, the lowest first (the high bit says that one
    goes on), and where each ends."""
    more = [numbers >> 7 * k for k in range(5)]
    rows = np.stack([m & 127 | ((m > 127) << 7) for m in more], axis=1).astype(np.uint8)
    taken = np.stack([m > 0 if k else m >= 0 for k, m in enumerate(more)], axis=1)
    return rows[taken].tobytes(), np.cumsum(taken.sum(axis=1))


def unpacked_numbers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    last = np.flatnonzero(raw < 128)
    if not len(last):
        return raw[:0], raw[:0]
    first = np.concatenate([[0], last[:-1] + 1])
    nth = np.arange(len(raw)) - np.repeat(first, last + 1 - first)
    return np.add.reduceat((raw & 127) << 7 * nth[:len(raw)], first), last + 1


def packed_tables(ids: list[np.ndarray], counts: list[np.ndarray]) -> list[bytes]:
    """For each block, its ascending ids as gaps, and their counts, deflated."""
    numbers = [x for i, c in zip(ids, counts, strict=True) for x in (np.diff(i.astype(np.int64), prepend=-1) - 1, c - 1)]
    raw, ends = packed_numbers(np.concatenate([*numbers, np.zeros(0, np.int64)]))
    ends = np.concatenate([[0], ends])[np.cumsum([0] + [2 * len(i) for i in ids])].tolist()
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        made = zlib.compressobj(6, zlib.DEFLATED, -10, 4)
        out.append(made.compress(raw[a:b]) + made.flush())
    return out


def unpacked_tables(coded: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, bytes]]:
    """For each block, ids, counts, and what follows the table."""
    raw, rest = [], []
    for c in coded:
        made = zlib.decompressobj(-15)
        raw.append(made.decompress(c))
        rest.append(made.unused_data)
    numbers, ends = unpacked_numbers(b"".join(raw))
    cuts = np.searchsorted(ends, np.cumsum([0] + [len(r) for r in raw]), side="right").tolist()
    out = []
    for a, b, r in zip(cuts[:-1], cuts[1:], rest, strict=True):
        half = (a + b) // 2
        out.append(((np.cumsum(numbers[a:half] + 1) - 1).astype(np.uint32), numbers[half:b] + 1, r))
    return out


def longest_first(sizes: list[int]) -> tuple[list[int], np.ndarray, list[int]]:
    """An order of blocks in which those that still run are the leading ones, their
    sizes, and how many run at each step."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    ranked = np.array([sizes[i] for i in order], np.int64)
    most = int(ranked[0]) if len(ranked) else 0
    return order, ranked, np.cumsum(np.bincount(ranked, minlength=most + 1)[::-1])[::-1][1:].tolist()


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of at most ``MOST_IDS`` ids."""
    order, sizes, steps = longest_first([len(b) for b in blocks])
    lanes = len(order)
    if lanes and sizes[0] > MOST_IDS:
        raise ValueError(f"a block holds at most {MOST_IDS} ids")
    ranks = np.zeros((len(steps), lanes), np.int32)
    rank_of = np.zeros(max((int(b.max()) + 1 for b in blocks if len(b)), default=0), np.int32)
    held, counts = [], []
    for j, i in enumerate(order):
        ids, count = np.unique(blocks[i], return_counts=True)
        rank_of[ids] = np.arange(len(ids))
        ranks[:len(blocks[i]), j] = rank_of[blocks[i]]
        held.append(ids)
        counts.append(count)
    heads = packed_tables(held, counts)
    tables = Tables(counts, sizes)
    model = Model(tables)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << LOW, np.int64)
    out = np.zeros((lanes, len(steps) * TOTAL // WORD + 3), np.uint32)
    used = np.zeros(lanes, np.int64)

    def put_word(at: np.ndarray) -> None:
        here = low[at]
        over = np.flatnonzero(here >> LOW)
        lane, word = at[over], used[at[over]]
        while len(lane):  # a carry goes on over words of ones
            word = word - 1
            out[lane, word] += 1
            on = out[lane, word] == 0
            lane, word = lane[on], word[on]
        out[at, used[at]] = (here >> LOW - WORD) & 0xFFFFFFFF
        used[at] += 1
        low[at] = (here & LEAST - 1) << WORD

    for t, n in enumerate(steps):
        model.predict(n)
        x = ranks[t, :n]
        at = tables.base[:n] + x
        hit2, hit1 = x == model.g2, x == model.g1
        start, size = model.interval(at, hit2, hit1)
        unit = span[:n] >> TOTAL
        low[:n] += unit * start
        unit *= size
        span[:n] = unit
        short = np.flatnonzero(unit < LEAST)
        if len(short):
            put_word(short)
            span[short] <<= WORD
        model.update(x, at, hit2, hit1)
    for _ in range(2):  # the low end itself closes the code
        put_word(np.arange(lanes))
    coded: list[bytes] = [b""] * lanes
    for j, i in enumerate(order):
        if len(blocks[i]):
            coded[i] = heads[j] + out[j, :used[j]].astype("<u4").tobytes()
    return coded


def decode_blocks(coded: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, from its code and number of ids."""
    order, ranked, steps = longest_first(sizes)
    lanes = len(order)
    parsed = unpacked_tables([coded[i] for i in order])
    tables = Tables([p[1] for p in parsed], ranked)
    model = Model(tables)
    longest = max((len(p[2]) for p in parsed), default=0) // 4 + 2
    words = np.zeros((lanes, longest), np.int64)
    for j, p in enumerate(parsed):
        words[j, 1:1 + len(p[2]) // 4] = np.frombuffer(p[2], "<u4")
    # The coder's low end has 4 bits less than two words.
    words = (words[:, :-1] << 28 | words[:, 1:] >> 4) & 0xFFFFFFFF
    code = words[:, 0] << WORD | words[:, 1] if lanes else np.zeros(0, np.int64)
    span, used = np.full(lanes, 1 << LOW, np.int64), np.full(lanes, 2, np.int64)
    ranks = np.zeros((len(steps), lanes), np.int32)
    shares = np.where(ranked > 0, tables.shares, 0)
    by_share = np.repeat(tables.ranks.astype(np.int16), tables.widths)
    share_base = np.cumsum(shares) - shares
    for t, n in enumerate(steps):
        model.predict(n)
        unit = span[:n] >> TOTAL
        v = code[:n] // unit
        share = share_base[:n] + ((v - model.end1) / model.unit).astype(np.int64)
        hit2, hit1 = v < model.end2, v < model.end1
        x = by_share.take(share, mode="clip").astype(np.int32)
        x = np.where(hit2, model.g2, np.where(hit1, model.g1, x))
        at = tables.base[:n] + x
        hit1 = x == model.g1
        start, size = model.interval(at, hit2, hit1)
        code[:n] -= unit * start
        unit *= size
        span[:n] = unit
        short = np.flatnonzero(unit < LEAST)
        if len(short):
            code[short] = code[short] << WORD | words[short, np.minimum(used[short], longest - 2)]
            used[short] += 1
            span[short] <<= WORD
        ranks[t, :n] = x
        model.update(x, at, hit2, hit1)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * lanes
    for j, i in enumerate(order):
        if sizes[i]:
            out[i] = parsed[j][0][ranks[:sizes[i], j]]
    return out


def _moved(operator: tuple[int, ...], v: int) -> int:
    out = 0
    for row in operator:
        if v & 1:
            out ^= row
        v >>= 1
    return out


@functools.cache
def _zero_bytes(k: int) -> tuple[int, ...]:
    """What 2**k zero bytes do to a crc32, by its bits."""
    if k < 0:  # -3: one zero bit
        half = (0xEDB88320, *(1 << i for i in range(31))) if k == -3 else _zero_bytes(k - 1)
        return half if k == -3 else tuple(_moved(half, row) for row in half)
    half = _zero_bytes(k - 1)
    return tuple(_moved(half, row) for row in half)


@functools.cache
def _zero_tables(k: int) -> np.ndarray:
    """``_zero_bytes(k)`` of each value of each of the four bytes of a crc32."""
    return np.array([[_moved(_zero_bytes(k), v << 8 * j) for v in range(256)] for j in range(4)], np.int64)


def crc_moved(crcs: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What so many zero bytes after each do to crc32s: a sequence's crc32 is those of
    its parts, each moved on by the bytes after it, joined by exclusive or."""
    crcs = crcs.astype(np.int64)
    for k in range(int(zeros.max(initial=0)).bit_length()):
        at = np.flatnonzero(zeros >> k & 1)
        v, t = crcs[at], _zero_tables(k)
        crcs[at] = t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
    return crcs


def crc_joined(first: int, second: int, length: int) -> int:
    """crc32 of a sequence of bytes from those of its two parts and the length of the
    second."""
    return int(crc_moved(np.array([first]), np.array([length]))[0]) ^ second


def token_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per text (with the end id), and all ids."""
    enc = encoder(path)
    texts = pc.fill_null(texts, "")
    if enc.words_apart:
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        units, places = enc.units(coded.dictionary)
        each = enc.values(units)
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        start = (np.cumsum(size) - size)[places].ravel()
        flat = np.frombuffer(b"".join(each), np.uint32)[spread(start, size[places].ravel())]
        size = size[places].sum(axis=1)
        start = np.cumsum(size) - size
        index, offsets = coded.indices.to_numpy(), lists.offsets.to_numpy()
        n = size[index]
        counts = np.diff(np.concatenate([[0], np.cumsum(n)])[offsets])
        ids = flat[spread(start[index], n)]
    else:
        made = enc.encode(texts.to_pylist())
        counts = np.fromiter(map(len, made), np.int64, len(made))
        ids = np.fromiter((i for m in made for i in m), np.uint32, int(counts.sum()))
    return counts + 1, np.insert(ids, np.cumsum(counts), end_id)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 1, block_ids: int = 2048, lanes: int = 2048,
              slice_bytes: int = 4 << 20) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of
    ``id_col`` (null ids first; equal ids in any order), as blocks of at most
    ``block_ids`` ids. A block holds whole documents, but a document of more ids
    than that, which goes on in blocks of its own. Rows of a file: part and block (the order), docs, lens (of the document's ids here),
    goes_on (the last document continues), n, crc (of the ids), code (whose first
    bytes are a mark and the crc32 of the rest)."""
    kind = docs.schema[id_col].dataType

    @trimmed
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        waiting: list[tuple[list, list, bool, np.ndarray]] = []
        arrow_kind = None

        def flush() -> pa.RecordBatch:
            nonlocal block
            coded = encode_blocks([w[3] for w in waiting])
            rows = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(waiting), pa.int32()), pa.array(range(block, block + len(waiting)), pa.int64()),
                 pa.array([w[0] for w in waiting], pa.list_(arrow_kind)), pa.array([w[1] for w in waiting], pa.list_(pa.int64())),
                 pa.array([w[2] for w in waiting]), pa.array([len(w[3]) for w in waiting], pa.int64()),
                 pa.array([zlib.crc32(w[3].astype("<u4").tobytes()) for w in waiting], pa.int64()),
                 pa.array([MAGIC + struct.pack("<I", zlib.crc32(c)) + c for c in coded], pa.binary())],
                ["part", "block", "docs", "lens", "goes_on", "n", "crc", "code"])
            block += len(waiting)
            waiting.clear()
            return rows

        names, lens, parts, room = [], [], [], block_ids
        for b in byte_slices(batches, "text", slice_bytes):
            arrow_kind = b.schema.field("id").type
            counts, ids = token_ids(b.column("text"), tokenizer_path, end_id)
            at = 0
            for name, n in zip(b.column("id").to_pylist(), counts.tolist(), strict=True):
                if n > room and room < block_ids:
                    waiting.append((names, lens, False, np.concatenate(parts)))
                    names, lens, parts, room = [], [], [], block_ids
                    if len(waiting) == lanes:
                        yield flush()
                while n:
                    here = min(n, room)
                    names.append(name)
                    lens.append(here)
                    parts.append(ids[at:at + here])
                    at, n, room = at + here, n - here, room - here
                    if not room:
                        waiting.append((names, lens, n > 0, np.concatenate(parts)))
                        names, lens, parts, room = [], [], [], block_ids
                        if len(waiting) == lanes:
                            yield flush()
        if names:
            waiting.append((names, lens, False, np.concatenate(parts)))
        encoder(tokenizer_path).cache.clear()
        if waiting:
            yield flush()

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name = kind.simpleString()
    (read.repartitionByRange(F.col("id")).sortWithinPartitions("id")
     .mapInArrow(write, f"part int, block bigint, docs array<{name}>, lens array<bigint>, goes_on boolean, n bigint, "
                        "crc bigint, code binary").write.option("compression", "none").parquet(path))


def read_ids(spark, path: str, *, id_col: str = "doc_id", lanes: int = 2048,
             keep_ids: bool = False) -> DataFrame:
    """Decode the blocks of ``path``, check their checksums, and return per document
    its id, ``start`` (the ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian 32-bit numbers) and with
    ``keep_ids`` the ids. A damaged block ends the job with its place."""
    files = spark.read.parquet(path)
    kind = files.schema["docs"].dataType.elementType.simpleString()

    @trimmed
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for from_row in range(0, b.num_rows, lanes):
                s = b.slice(from_row, lanes)
                sizes, code = s.column("n").to_pylist(), s.column("code").to_pylist()
                place = [f"part {p}, block {k}" for p, k in zip(s.column("part").to_pylist(), s.column("block").to_pylist(), strict=True)]
                for c, at in zip(code, place, strict=True):
                    if not c.startswith(MAGIC):
                        raise ValueError(f"not a block of token ids: {at}")
                    if struct.pack("<I", zlib.crc32(memoryview(c)[HEAD:])) != c[len(MAGIC):HEAD]:
                        raise ValueError(f"damaged block: {at}")
                blocks = decode_blocks([c[HEAD:] for c in code], sizes)
                for i, (ids, crc) in enumerate(zip(blocks, s.column("crc").to_pylist(), strict=True)):
                    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                        raise ValueError(f"damaged block: {place[i]}")
                per = np.array([len(x) for x in s.column("lens")], np.int64)
                lens = s.column("lens").flatten().to_numpy()
                ids = np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)
                ends = np.cumsum(lens)
                first = np.cumsum(per) - per
                before = ends - lens - np.repeat((ends - lens)[first] if len(first) else first, per)
                nth = np.arange(len(lens)) - np.repeat(first, per)
                # The last piece of a block goes on if the block says so.
                goes_on = (nth == np.repeat(per, per) - 1) & np.repeat(s.column("goes_on").to_numpy(zero_copy_only=False), per)
                crcs = [zlib.crc32(ids[e - n:e].astype("<u4").tobytes()) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [s.column("docs").flatten(), pa.array(np.repeat(s.column("part").to_numpy(), per), pa.int32()),
                     pa.array(np.repeat(s.column("block").to_numpy(), per)), pa.array(nth), pa.array(before),
                     pa.array(lens), pa.array(goes_on), pa.array(crcs, pa.int64()),
                     list_array(ids.astype(np.int64) if keep_ids else np.zeros(0, np.int64), lens if keep_ids else lens * 0)],
                    ["id", "part", "block", "nth", "before", "n", "goes_on", "crc", "ids"])

    # Stored, as two branches below read it: decoding is done once.
    pieces = stored(files.mapInArrow(read, f"id {kind}, part int, block bigint, nth bigint, before bigint, n bigint, "
                                    "goes_on boolean, crc bigint, ids array<bigint>"), "op4-pieces")
    # The ids before a block: of the parts before, and of the part's blocks before.
    heads = files.select("part", "block", "n", "goes_on")
    in_part = Window.partitionBy("part").orderBy("block")
    heads = heads.withColumn("sum", F.sum("n").over(in_part) - F.col("n")).withColumn(
        "lead", F.coalesce(F.lag("goes_on").over(in_part), F.lit(False)))
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    heads = heads.join(parts, "part").select("part", "block", (F.col("sum") + F.col("offset")).alias("base"), "lead")
    placed = pieces.join(heads, ["part", "block"]).withColumn("continues", (F.col("nth") == 0) & F.col("lead"))
    alone = placed.where(~F.col("continues") & ~F.col("goes_on")).select(
        "id", (F.col("base") + F.col("before")).alias("start"), F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"), "ids")
    # Documents over several blocks: their pieces (part, block) follow one another.
    rest = placed.where(F.col("continues") | F.col("goes_on"))
    by_place = Window.partitionBy("part").orderBy("block", "nth")
    rest = rest.withColumn("doc", F.sum((~F.col("continues")).cast("long")).over(by_place))
    behind = Window.partitionBy("part", "doc").orderBy("block", "nth").rowsBetween(1, Window.unboundedFollowing)
    rest = rest.select("part", "doc", "block", "nth", "id", (F.col("base") + F.col("before")).alias("start"), "n", "crc",
                       F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("behind"), *(["ids"] if keep_ids else []))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            moved = crc_moved(b.column("crc").to_numpy(), 4 * b.column("behind").to_numpy())
            yield b.set_column(b.schema.get_field_index("crc"), "crc", pa.array(moved))

    of_doc = [F.first("id").alias("id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
              F.bit_xor("crc").alias("ids_crc32")]
    if keep_ids:
        ordered = F.sort_array(F.collect_list(F.struct("block", "nth", "ids")))
        of_doc.append(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
    else:
        alone = alone.drop("ids")
    long = rest.mapInArrow(move, rest.schema).groupBy("part", "doc").agg(*of_doc).drop("part", "doc")
    return alone.unionByName(long).withColumnRenamed("id", id_col)


def token_binary(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """Write the ids of ``docs`` to a fresh folder in the shared scratch space and
    return what reading it back gives; see ``write_ids`` and ``read_ids``. A null
    text is empty: its document has the end id only. Repeated rows are documents
    of their own. An empty table gives no rows."""
    path = scratch_path(docs.sparkSession, "op4-ids")
    write_ids(docs, path, tokenizer_path, id_col=id_col, text_col=text_col, **options)
    return read_ids(docs.sparkSession, path, id_col=id_col)
