"""Removal of repeated byte strings by merged Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, text_of, tidy, written

GRAM = 16
#: A window's anchor has this many bytes of the window on one side at least.
SIDE = 17
LEAST_BITS, MOST_BITS, PARTS = 1 << 22, 1 << 30, 64
SLOTS = 1 << 20
#: Anchors with more distinct pieces than these are dealt out by the longer strings at their sides.
HOT = 2000
#: Chunks are small enough for their arrays to stay in a core's cache; a group is whole in its chunk, however large.
CHUNK_BYTES, SHARD_BYTES, BLOCK = 1 << 17, 1 << 16, 1 << 20
#: Texts are looked through so many bytes at once, longer ones in blocks of their own.
STRETCH = 1 << 17
#: Text bytes for which hashes of strings are counted in one part; these take about 1.3 times as many.
PART_BYTES = 12 << 20
LAST = (1 << 63) - 1
#: Values of bytes, an odd base and its inverse modulo 2^64, for hashes of all strings of a size by differences of prefix sums.
VALUES = np.random.default_rng(50).integers(0, 1 << 64, 256, np.uint64)
BASE = 0x9E3779B97F4A7C15
POWERS = np.cumprod(np.append(np.uint64(1), np.full(BLOCK + 256, BASE, np.uint64)))
DOWN = np.arange(BLOCK + 256, 0, -1).astype(np.uint64)
INVERSES = np.cumprod(np.append(np.uint64(1), np.full(BLOCK + 256, pow(BASE, -1, 1 << 64), np.uint64)))


def sums_of(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes' values times powers of the base; ``hashes_at`` turns them into hashes of strings."""
    return np.append(np.uint64(0), np.cumsum(VALUES[data] * POWERS[: len(data)]))


def hashes_at(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the strings from ``begin`` to ``end``: equal strings have equal ones, wherever they are."""
    h = (sums[end] - sums[begin]) * INVERSES[begin]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def blocks(data: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where each block begins, and its bytes; every ``window``-byte string lies in one block."""
    for at in range(0, max(1, len(data) - window + 1), BLOCK):
        yield at, data[at : at + BLOCK + window - 1]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a binary column without nulls, and where in them each begins, and the last ends."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, edges, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(edges, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def stretches(column: pa.Array, window: int) -> Iterator[tuple[slice, np.ndarray, int, np.ndarray]]:
    """Which rows, where each begins, bytes of the first row before these, and bytes: many texts in a row, or a block of a long one."""
    data, edges = texts_of(column)
    lo = 0
    while lo < len(column):
        if edges[lo + 1] - edges[lo] > STRETCH:
            for begin, part in blocks(data[edges[lo] : edges[lo + 1]], window):
                yield slice(lo, lo + 1), np.zeros(1, np.int64), begin, part
            lo += 1
        else:
            hi = int(np.searchsorted(edges, edges[lo] + STRETCH, side="right")) - 1
            yield slice(lo, hi), edges[lo:hi] - edges[lo], 0, data[edges[lo] : edges[hi]]
            lo = hi


def anchors(data: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each ``window``-byte string inside one of the texts that begin at ``starts``: where it is, where its anchor is; hashes of all anchors; the sums.

    The anchor is the ``GRAM``-byte string inside it with the smallest 32-bit hash
    (the last of equal ones); equal windows have equal anchors.
    """
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(1, np.uint64)
    sums = sums_of(data)
    h = sums[GRAM:] - sums[:-GRAM]
    h *= INVERSES[: len(h)]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h >>= np.uint64(32)
    wide = window - GRAM + 1
    low = h << np.uint64(31)
    low |= DOWN[-len(h) :]
    span = 1
    while 2 * span <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[wide - span : wide - span + n])
    inside = np.ones(n, bool)
    across = (starts[1:, None] - np.arange(1, window)).ravel()  # windows that begin before a text and end in it
    inside[across[(across >= 0) & (across < n)]] = False
    at = np.flatnonzero(inside)
    return at, len(h) - (low[at] & np.uint64((1 << 31) - 1)).astype(np.int64), h, sums


def sides(sums: np.ndarray, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchors ``at`` with ``SIDE`` bytes of their text before them, and with as many after; which have so many; and their texts.

    A window whose anchor is the one at hand holds one of the two strings. So if
    another document has the window, it has that string too.
    """
    text = np.searchsorted(starts, at, side="right") - 1
    before = at - SIDE >= starts[text]
    after = at + GRAM + SIDE <= np.append(starts[1:], len(sums) - 1)[text]
    left = hashes_at(sums, at[before] - SIDE, at[before] + GRAM)
    right = hashes_at(sums, at[after], at[after] + GRAM + SIDE)
    return left, right, before, after, text


def runs(anchor: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of kept windows that share an anchor."""
    if not len(anchor):
        return anchor, anchor
    new = np.append(True, (anchor[1:] != anchor[:-1]) | ~keep[:-1])
    end = np.append((anchor[1:] != anchor[:-1]) | ~keep[1:], True)
    return np.flatnonzero(new & keep), np.flatnonzero(end & keep)


def shard_transform(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The transform of sorted, distinct pieces, and the suffixes in order, as places in the pieces put one after the other.

    Each piece ends in a mark (symbol 0) of its own; marks sort before bytes and
    like their pieces.
    """
    code = np.frombuffer(b"\x00".join(pieces) + b"\x00" + bytes(8), np.uint8)
    sizes = np.fromiter((len(x) + 1 for x in pieces), np.int64, len(pieces))
    mark = np.cumsum(sizes) - 1
    n = len(code) - 8
    symbol = code[:n].astype(np.int64) + 1
    symbol[mark] = 0
    word, k = np.zeros(n, np.uint64), 8  # the first eight bytes; what lies past a mark does not count
    left = np.repeat(mark, sizes) - np.arange(n)
    for i in range(8):
        word = (word << np.uint64(8)) | np.where(left > i, code[i : i + n], 0).astype(np.uint64)
    order = np.argsort(word)
    rank = np.empty(n, np.int64)
    rank[order] = np.append(False, word[order][1:] != word[order][:-1]).cumsum()
    # Of equal words those that end inside come first, the shorter before the longer, then by piece.
    few = 8 * len(pieces)
    rank = rank * (few + 1) + np.where(left < 8, left * len(pieces) + np.repeat(np.arange(len(pieces)), sizes), few)
    order = np.argsort(rank)
    key, own, places = rank[order], order, np.arange(n)
    while len(own):  # suffixes alone in their place have found it; a rank is the first place of those that are still alike
        new = np.append(True, key[1:] != key[:-1])
        rank[own] = np.maximum.accumulate(np.where(new, places, 0))
        alike = ~(new & np.append(new[1:], True))
        own, places = own[alike], places[alike]
        key = rank[own] * n + rank[own + k] if len(own) else own
        by = np.argsort(key)
        key, own = key[by], own[by]
        order[places] = own
        k *= 2
    first = np.append(0, mark[:-1] + 1)
    before = np.append(0, symbol[:-1])
    before[first] = 0
    return before[order].astype(np.uint8), order


def intervals(shards: list[tuple[np.ndarray, np.ndarray]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all shards whose first ``depth`` symbols another suffix shares, by these symbols; and where each such interval begins.

    The shards' transforms are merged by refining their interleave: a round
    sorts the suffixes, in the order of the round before, by the symbol that
    stands before them, which the transforms tell, and each moves on to the suffix
    that begins there. Blocks of suffixes that share a prefix follow their symbols
    through the same rounds, and a suffix alone in its block is settled: nothing
    that begins before it can share more. No suffix is sorted anew. A mark shares
    nothing.
    """
    sizes = [len(bwt) for bwt, _ in shards]
    at = np.cumsum([0, *sizes])
    symbols = np.concatenate([bwt for bwt, _ in shards])
    onward = np.empty(at[-1], np.int64)  # the suffix that is longer by one symbol
    for lo, (bwt, _) in zip(at, shards, strict=False):
        onward[lo + np.argsort(bwt, kind="stable")] = lo + np.arange(len(bwt))
    now, block = np.arange(at[-1]), np.zeros(at[-1], np.int32)
    new = np.zeros(at[-1], bool)
    several = new
    for _ in range(depth):
        symbol = symbols[now]
        order = np.argsort(symbol, kind="stable")
        symbol, block = symbol[order], block[order]
        new = np.append(True, (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1]) | (symbol[1:] == 0)) if len(order) else new[:0]
        several = ~(new & np.append(new[1:], True)) if len(order) else new
        if 8 * np.count_nonzero(several) < 7 * len(several):  # settled ones leave once they are many
            order, new = order[several], new[several]
            several = several[several]
        now = onward[now[order]]
        block = np.cumsum(new, dtype=np.int32)
    suffix = np.concatenate([suffixes for _, suffixes in shards])
    return suffix[now[several]], new[several]


def early_windows(pieces: list[bytes], docs: np.ndarray, window: int) -> list[list[int]]:
    """For each distinct piece, the runs (first, last, ...) of its windows that another piece holds in a smaller document."""
    sizes = np.fromiter((len(x) + 1 for x in pieces), np.int64, len(pieces))
    starts = np.cumsum(sizes) - sizes
    shards: list[tuple[np.ndarray, np.ndarray]] = []
    lo = 0
    while lo < len(pieces):
        hi, size = lo, 0
        while hi < len(pieces) and (hi == lo or size < SHARD_BYTES):
            size += len(pieces[hi])
            hi += 1
        bwt, order = shard_transform(pieces[lo:hi])
        shards.append((bwt, order + starts[lo]))
        lo = hi
    out: list[list[int]] = [[] for _ in pieces]
    suffix, new = intervals(shards, window)
    if not len(suffix):
        return out
    begin = np.flatnonzero(new)
    piece = np.searchsorted(starts, suffix, side="right") - 1
    least = np.repeat(np.minimum.reduceat(docs[piece], begin), np.diff(np.append(begin, len(suffix))))
    early = np.sort(suffix[least < docs[piece]])
    own = np.searchsorted(starts, early, side="right") - 1
    edge = np.flatnonzero(np.append(True, (early[1:] != early[:-1] + 1) | (own[1:] != own[:-1]))) if len(early) else early
    for i, first, last in zip(own[edge].tolist(), (early[edge] - starts[own[edge]]).tolist(), (early[np.append(edge[1:], len(early)) - 1] - starts[own[edge]]).tolist() if len(early) else [], strict=True):
        out[i] += [first, last]
    return out


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _order, _hash, _bytes): the id, its place in the order (null last), and the text as bytes."""
    text = text_of(docs, text_col)
    order = F.coalesce(docs[id_col].cast("long"), F.lit(LAST))
    return docs.select(docs[id_col].alias("_id"), order.alias("_order"), F.hash(text).alias("_hash"), F.encode(text, "UTF-8").alias("_bytes"))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per row of ``docs``: which bytes repeat a string of a document with a smaller id.

    A byte goes if some ``window``-byte string over it also starts in a document
    with a smaller id; strings are judged on the input and never cross
    documents. Texts are UTF-8, null counts as empty. Ids are integers; a null
    id comes after all others, and rows that repeat an id do not precede each
    other. An empty table gives no rows. ``removed`` lists first and end byte of
    each maximal run. Bytes that stay may not be valid UTF-8 on their own.

    Equal windows share their anchor, the string of ``GRAM`` bytes with the smallest
    hash inside them, and the ``SIDE`` bytes before or after it. Strings of an
    anchor and a side that only one document holds cannot belong to a repeated
    window; the others are marked in a table of bits (sixteen or more a mark, up
    to ``MOST_BITS``; marks met by chance only add work) that is sent to all tasks.
    What is left of a document is cut into pieces, runs of windows with the same
    anchor, of at most ``2 * window - GRAM`` bytes; they are told apart by a hash of
    64 bits and their anchor's of 32, and each distinct one gets its smallest id.
    Where all pieces of an anchor are alike that settles all their windows. The
    pieces of other anchors, combined within each batch, are dealt out by anchor,
    and those of anchors with more than ``HOT`` pieces by the strings at the
    anchor's sides, so a passage with very many copies is one piece there and a
    frequent anchor many groups.

    Within a task, pieces are taken in chunks of whole groups; shards of a chunk
    get their Burrows-Wheeler transforms, whose interleave is refined round by
    round; common prefixes of ``window`` bytes follow in the same rounds. Each
    interval of equal windows yields its smallest id.
    """
    spark = docs.sparkSession
    base = scanned(docs, id_col, text_col).select("_order", "_hash", "_bytes")

    def bit_table(hashes: DataFrame):
        """A broadcast table of bits with those of column ``h`` set, sixteen bits or more for each as far as ``MOST_BITS`` goes.

        It is filled in ``PARTS`` parts by tasks; only the parts reach the driver.
        """
        hashes = written(hashes.select("h"))
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * hashes.count()).bit_length()))
        size = bits // PARTS

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, np.ndarray] = {}
            for batch in batches:
                slot = batch.column(0).to_numpy()
                for part in np.unique(slot // size).tolist():
                    own = slot[slot // size == part] % size
                    parts.setdefault(part, np.zeros(size, bool))[own] = True
            packed = [zlib.compress(np.packbits(x, bitorder="little").tobytes(), 1) for x in parts.values()]
            yield pa.RecordBatch.from_arrays([pa.array([*parts], pa.int32()), pa.array(packed, pa.binary())], ["part", "bits"])

        slots = hashes.select(F.pmod("h", F.lit(bits)).cast("long").alias("s"))
        table = np.zeros(bits // 8, np.uint8)
        with tidy(spark):
            for row in slots.repartition(PARTS, F.expr(f"s div {size}")).mapInArrow(fill, "part int, bits binary").toLocalIterator():
                table[row["part"] * size // 8 : (row["part"] + 1) * size // 8] |= np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
        discard(hashes)
        return spark.sparkContext.broadcast(table)

    def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(np.int64) % (8 * len(table))
        return (table[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)).astype(bool)

    # Hashes are dealt out by their first bits, many a row; of equal ones in a batch two are enough.
    bits = max(6, ((base.agg(F.sum(F.octet_length("_bytes"))).first()[0] or 0) // PART_BYTES).bit_length())
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, starts, _, part in stretches(batch.column(2), window):
                _, where, _, sums = anchors(part, starts, window)
                found += sides(sums, where[np.append(True, where[1:] != where[:-1])] if len(where) else where, starts)[:2]
            h = np.sort(np.concatenate(found))
            h = h[np.append(np.ones(min(2, len(h)), bool), h[2:] != h[:-2])]
            edges = np.append(np.searchsorted(h, firsts), len(h))
            some = np.flatnonzero(edges[1:] > edges[:-1])
            of = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(np.append(8 * edges[some], 8 * len(h)).astype(np.int32)), pa.py_buffer(h)])
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), of], ["part", "hashes"])

    def recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(own: list[bytes]) -> pa.RecordBatch:
            h = np.sort(np.frombuffer(b"".join(own), np.int64))
            h = h[1:][h[1:] == h[:-1]]
            return pa.RecordBatch.from_arrays([pa.array(h[np.append(True, h[1:] != h[:-1])] if len(h) else h)], ["h"])

        now, own = -1, []
        for batch in batches:
            for part, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now and own:
                    yield finished(own)
                    own = []
                now = part
                own.append(hashes)
        if own:
            yield finished(own)

    with small_batches(spark):
        dealt = base.mapInArrow(seen, "part int, hashes binary").repartition("part").sortWithinPartitions("part")
        repeated = bit_table(dealt.mapInArrow(recurring, "h long"))

    def cut(batch: pa.RecordBatch) -> Iterator[tuple]:
        """(order, hash, place in the text) of each piece, bytes, its first and last window in these, its anchor, its hash, the hashes of its sides, 0 for none."""
        orders, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for rows, starts, begin, part in stretches(batch.column(2), window):
            at, where, h, sums = anchors(part, starts, window)
            if not len(at):
                continue
            new = np.append(True, where[1:] != where[:-1])
            anchor, own = where[new], np.cumsum(new) - 1
            left, right, before, after, text = sides(sums, anchor, starts)
            both = np.zeros((2, len(anchor)), np.int64)
            both[0, before], both[1, after] = left.view(np.int64), right.view(np.int64)
            both[~marked(repeated.value, both)] = 0
            # A window with more than SIDE bytes before its anchor holds the string on that side, one with fewer the other, else both.
            ahead = where - at
            left, right = both.astype(bool)[:, own]
            lo, hi = runs(where, (left | (ahead < SIDE)) & (right | (ahead > SIDE)))
            if len(lo):
                own, lo, hi = own[lo], at[lo], at[hi]
                text = text[own]
                keys = hashes_at(sums, lo, hi + window).view(np.int64)
                yield orders[rows][text], hashes[rows][text], lo - starts[text] + begin, part, lo, hi, h[anchor[own]].astype(np.uint32).view(np.int32), keys, both[:, own]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, h, at, _, lo, hi, anchor, keys, _ in cut(batch):
                columns = [order, h, at.astype(np.int32), (hi - lo + window).astype(np.int16), anchor, keys]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["_order", "_hash", "at", "size", "h", "p"])

    plain = {f"parquet.enable.dictionary#{x}": "false" for x in ("at", "h", "p")}  # hardly a value repeats
    occurrences = written(base.mapInArrow(places, "_order long, _hash int, at int, size short, h int, p long"), **plain)
    known = written(occurrences.groupBy("h", "p").agg(F.min("_order").alias("first"), F.max("_order").alias("last")))
    counts = written(known.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    mixed, hot = bit_table(counts), bit_table(counts.where(F.col("n") > HOT))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[tuple[int, int, int], tuple[int, bytes]] = {}
            for order, _, _, part, lo, hi, anchor, keys, both in cut(batch):
                some = np.flatnonzero(marked(mixed.value, anchor))
                heavy = marked(hot.value, anchor[some]).tolist()
                data = part.tobytes()
                told = zip(order[some].tolist(), lo[some].tolist(), (hi[some] + window).tolist(), anchor[some].tolist(), keys[some].tolist(), both[:, some].T.tolist(), heavy, strict=True)
                for first, a, b, own, p, groups, much in told:
                    for g in groups if much else (own,):
                        if not g and much:
                            continue
                        key = g, own, p
                        if key not in least:
                            least[key] = (first, data[a:b])
                        elif first < least[key][0]:
                            least[key] = (first, least[key][1])
            own = [pa.array([k[0] for k in least], pa.int64()), pa.array([k[1] for k in least], pa.int32()), pa.array([k[2] for k in least], pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, pa.array([x[1] for x in least.values()], pa.binary()), pa.array([x[0] for x in least.values()], pa.int64())], ["g", "h", "p", "piece", "d"])

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(rows: list[tuple]) -> pa.RecordBatch:
            rows = sorted({r[3]: r for r in rows}.values(), key=lambda r: r[3])
            early = early_windows([r[3] for r in rows], np.array([r[4] for r in rows], np.int64), window)
            hit = [i for i, own in enumerate(early) if own]
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[i][1] for i in hit], pa.int32()), pa.array([rows[i][2] for i in hit], pa.int64()), pa.array([early[i] for i in hit], pa.list_(pa.int16()))], ["h", "p", "early"]
            )

        def groups() -> Iterator[list[tuple]]:
            own: list[tuple] = []
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if own and row[0] != own[-1][0]:
                        yield own
                        own = []
                    own.append(row)
            if own:
                yield own

        rows, size = [], 0
        for own in groups():
            if len(own) > 1:  # a lone piece has nothing to share
                rows += own
                size += sum(len(r[3]) for r in own)
            if size >= CHUNK_BYTES:
                yield finished(rows)
                rows, size = [], 0
        if rows:
            yield finished(rows)

    dealt = base.mapInArrow(pieces, "g long, h int, p long, piece binary, d long").repartition("g")
    distinct = dealt.groupBy("g", "h", "p", "piece").agg(F.min("d").alias("d")).sortWithinPartitions("g")
    early = distinct.mapInArrow(refine, "h int, p long, early array<short>")

    # A piece that another document holds first goes as a whole, else only its windows that other pieces hold earlier.
    verdict = known.join(early, ["h", "p"], "left").where("last > first or early is not null").select("h", "p", "first", "early")
    judged = occurrences.join(verdict, ["h", "p"])
    whole = F.array(F.struct(F.col("at").alias("lo"), (F.col("at") + F.col("size")).cast("int").alias("hi")))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("early") / 2).cast("int") - 1), lambda i: F.struct(
        (F.col("at") + F.element_at("early", 2 * i + 1)).cast("int").alias("lo"), (F.col("at") + F.element_at("early", 2 * i + 2) + window).cast("int").alias("hi")))
    spans = judged.where("_order > first or early is not null").select(
        "_order", "_hash", F.when(F.col("_order") > F.col("first"), whole).otherwise(pairs).alias("spans")
    )
    gone = written(spans.groupBy("_order", "_hash").agg(F.flatten(F.collect_list("spans")).alias("spans")))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            data, edges = texts_of(batch.column(1))
            spans = batch.column(2)
            upto = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))).tolist()
            flat = spans.flatten()
            los, his = pc.struct_field(flat, 0).to_numpy(), pc.struct_field(flat, 1).to_numpy()
            view, edges = memoryview(data), edges.tolist()
            for a, b, i, j in zip(edges[:-1], edges[1:], upto[:-1], upto[1:], strict=True):
                joined: list[list[int]] = []
                for lo, hi in sorted(zip(los[i:j].tolist(), his[i:j].tolist(), strict=True)):
                    if joined and lo <= joined[-1][1]:
                        joined[-1][1] = max(hi, joined[-1][1])
                    else:
                        joined.append([lo, hi])
                at, kept = a, hashlib.sha256()
                for lo, hi in joined:
                    kept.update(view[at : a + lo])
                    at = a + hi
                kept.update(view[at:b])
                rows.append((b - a, sum(hi - lo for lo, hi in joined), len(joined), kept.hexdigest(), [x for s in joined for x in s]))
            n, removed, n_spans, sha, every = zip(*rows, strict=True) if rows else ((),) * 5
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(every, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    kind = docs.schema[id_col].dataType.simpleString()
    # Only rows that may lose something meet their spans; the slots are at most SLOTS integers.
    slot = F.pmod(F.xxhash64("_order", "_hash"), F.lit(SLOTS))
    slots = F.broadcast(gone.select(slot.alias("_slot")).distinct())
    every = scanned(docs, id_col, text_col).withColumn("_slot", slot)
    some = every.join(slots, "_slot", "left_semi").join(gone, ["_order", "_hash"], "left").select("_id", "_bytes", "spans")
    rest = every.join(slots, "_slot", "left_anti").select("_id", "_bytes", F.lit(None).cast(gone.schema["spans"].dataType).alias("spans"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = some.unionByName(rest).mapInArrow(strip, f"_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>")
    return out.withColumnRenamed("_id", id_col)
