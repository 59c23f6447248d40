"""Sum-of-squares packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

#: Texts of these alone need no more than lower case before they are cut into words: Latin letters as one character
#: each (but the dotted capital I), and common marks, which have one normal form.
PLAIN = regex.compile("[\t\n\v\f\r -~\u00a0-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e]*")
CHARS_AT_ONCE = 4_000_000
#: Places of items that are held at once before they are counted by gap; the plan does not depend on it.
ITEMS_AT_ONCE = 1 << 20


class ChunkEncoder:
    """Token ids of texts; words are encoded once, many at a time, and remembered.

    The tokenizer cuts a text into words and encodes each for itself, so a
    text's ids are its words' ids in a row; each word ends in one token that
    closes a word. At most ``limit`` words are remembered.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.word = regex.compile(told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        close = told["model"]["end_of_word_suffix"]
        self.closes = np.zeros(max(told["model"]["vocab"].values()) + 1, bool)
        self.closes[[i for t, i in told["model"]["vocab"].items() if t.endswith(close)]] = True
        self.special = [t["content"] for t in told["added_tokens"]]
        self.words_only = Tokenizer.from_file(path)  # for words that are cut and lower-cased already
        self.words_only.normalizer = None
        self.words_only.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        starts, ids, last = [self.starts], [self.ids], int(self.starts[-1])
        for lo in range(0, len(words), 2000):
            part = words[lo : lo + 2000]
            got = np.array(self.words_only.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.closes[got]) + 1
            if len(ends) != len(part):
                own = [self.words_only.encode(w, add_special_tokens=False).ids for w in part]
                got, ends = np.array([i for x in own for i in x], np.uint32), np.cumsum([len(x) for x in own])
            starts.append(ends + last)
            ids.append(got)
            last += len(got)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.starts, self.ids = np.concatenate(starts), np.concatenate(ids)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts, one text after the other, and how many each text has."""
        texts = texts.to_pylist()
        plain = [PLAIN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts]
        split = [self.word.findall(t.lower()) if p else [] for t, p in zip(texts, plain, strict=True)]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        coded = pa.array([w for ws in split for w in ws], pa.string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > self.limit:
            self.clear()
            fresh = words
        if fresh:
            self.learn(fresh)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        begin, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        upto = np.append(0, np.cumsum(size))
        ids = self.ids[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        ends = upto[np.cumsum(counts)]
        sizes = np.diff(np.append(0, ends))
        if not all(plain):
            parts = np.split(ids, ends[:-1])
            for i in np.flatnonzero(~np.array(plain)):
                parts[i] = np.array(self.whole(texts[i]), np.uint32)
            ids, sizes = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, sizes


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def slices(texts: pa.Array, most: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes each, or of one text."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy())
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def pieces_of(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, capacity: int) -> DataFrame:
    """One row per piece: id, piece, start, length and CRC-32 of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                ids, sizes = enc.encode_all(part.column(1))
                ends = np.cumsum(sizes + 1)
                every = np.zeros(int(ends[-1]), "<u4")  # each text's ids and the closing 0
                every[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
                n = -(-(sizes + 1) // capacity)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, (sizes + 1)[row] - start)
                at = (ends - sizes - 1)[row] + start
                data = memoryview(every).cast("B")
                crc = np.fromiter((zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)), np.int64, len(row))
                columns = [part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("_text")).mapInArrow(
        cut, f"_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def placements(size: int, total: int, held: list[int], capacity: int, together: int) -> Iterator[np.ndarray]:
    """The gaps into which ``total`` items of ``size`` go one after the other, ``together`` of them an array; ``held`` (open bins by gap) follows.

    A heap has each gap's cost, then the gap, as one number; a placement changes the
    costs of at most three gaps, so a step takes the same time whatever the number of bins.
    """
    wide = capacity + 1

    def priced(gap: int) -> int:
        if gap == capacity:  # a new bin
            return (0 if size == capacity else 2 * held[capacity - size] + 1) * wide + gap
        return (1 - 2 * held[gap] if gap == size else 2 * (held[gap - size] - held[gap]) + 2) * wide + gap

    def afresh() -> list[int]:
        return sorted([price[g] for g in range(size, capacity + 1) if g == capacity or held[g]])

    price = [priced(g) if g >= size else 0 for g in range(wide)]
    heap = afresh()
    for lo in range(0, total, together):
        n = min(together, total - lo)
        if 2 * size > capacity and len(heap) == 1:  # only a new bin has room, and what it leaves has none
            held[capacity - size] += n if size < capacity else 0
            yield np.full(n, capacity, np.int64)
            continue
        gaps = []
        for _ in range(n):
            top = heappop(heap)
            gap = top % wide
            while top != price[gap] or (gap < capacity and not held[gap]):  # it has changed since
                top = heappop(heap)
                gap = top % wide
            gaps.append(gap)
            left = gap - size
            if gap < capacity:
                held[gap] -= 1
            if left:
                held[left] += 1
            if gap == capacity or held[gap]:
                price[gap] = priced(gap)
                heappush(heap, price[gap])
            if left >= size:
                price[left] = priced(left)
                heappush(heap, price[left])
            above = gap + size
            if above <= capacity:
                price[above] = priced(above)
                if above == capacity or held[above]:
                    heappush(heap, price[above])
        yield np.array(gaps, np.int64)
        if len(heap) > 100 * wide:
            heap = afresh()


def plan_bins(counts: np.ndarray, capacity: int, together: int | None = 1) -> np.ndarray:
    """Places for ``counts[s]`` items of each size ``s``: rows (size, first rank, end rank, first bin, offset), sorted by size and rank.

    Sizes are taken from the largest down, items one by one, however many there
    are. An item goes where the sum, over the
    residual gaps of open bins, of the squared number of bins with that gap
    becomes smallest (a full bin has no gap and counts nothing). Of equal
    choices the smallest gap wins, an open bin before a new one.

    Items of one size are alike, and so are bins of one gap: only how many items
    go into which gap decides the packing. So of ``together`` items of one size
    in a row (None: of all, however many), those of one gap are told together, largest gap first (a bin that
    takes two of them is then told the first one first); a gap's bins are
    kept as runs of bin numbers. Rows then grow in number with the pairs of size and gap, not with the items.
    """
    held = [0] * (capacity + 1)  # open bins by gap; gaps 0 and capacity stay 0
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins) of each gap
    bins, slots = 0, array("q")
    for size in range(len(counts) - 1, 0, -1):
        done = 0
        taken = (np.bincount(gaps, minlength=capacity + 1) for gaps in placements(size, int(counts[size]), held, capacity, together or ITEMS_AT_ONCE))
        for own in taken if together else [sum(taken, np.zeros(capacity + 1, np.int64))]:
            for gap in np.flatnonzero(own)[::-1].tolist():
                n = int(own[gap])
                if gap == capacity:
                    runs[gap].append((bins, n))
                    bins += n
                while n:
                    first, there = runs[gap].pop()
                    m = min(n, there)
                    if there > m:
                        runs[gap].append((first, there - m))
                        first += there - m
                    slots.extend((size, done, done + m, first, capacity - gap))
                    if gap > size:
                        last = runs[gap - size]
                        if last and last[-1][0] == first + m:  # its bins go on where these end
                            last[-1] = (first, m + last[-1][1])
                        else:
                            last.append((first, m))
                    done, n = done + m, n - m
    out = np.array(slots, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
) -> DataFrame:
    """One row per piece of every document, with its place in a sequence.

    A document is its tokens and a closing id 0; null counts as empty (one
    piece that holds the closing id). Only documents longer than ``capacity``
    are cut, into as many pieces as it takes, however long they are. Repeated
    rows are packed each for itself; an empty table gives no rows; other columns
    of ``docs``, whatever their names, are not touched. Equal costs go to the
    smallest gap. Sequence ids are not consecutive in any order of the documents.

    The tokenised lengths make a histogram of at most ``capacity`` entries; the
    packing is planned on it (``plan_bins``), item by item at every size, so neither the driver nor a task
    ever holds all pieces. Pieces are numbered within their length in chunks
    whose sizes are summed first; a length has more chunks the more pieces share
    it, so that a chunk holds about a million at most. The plan's slots, which grow
    with the pairs of size and gap, are broadcast, and each piece finds its slot by binary search.
    """
    spark = docs.sparkSession
    pieces = written(pieces_of(docs, id_col, text_col, tokenizer_path, capacity))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count("*").alias("n")).toLocalIterator():  # at most capacity rows
        counts[length] = n
    salts = np.maximum(np.minimum(64, counts // 1000 + 1), counts // 1_000_000 + 1)
    of_length = F.element_at(F.lit(salts.tolist()), (F.col("length") + 1).cast("int"))
    pieces = pieces.withColumn("_salt", F.pmod(F.xxhash64("_id", "piece", "ids_crc32"), of_length))
    first = np.cumsum(salts) - salts  # of each length's chunks, in one row
    held = np.zeros(int(salts.sum()), np.int64)
    for length, salt, n in pieces.groupBy("length", "_salt").agg(F.count("*").alias("n")).toLocalIterator():  # as many rows as chunks
        held[first[length] + salt] = n
    before = np.cumsum(held) - held
    before -= np.repeat(before[np.minimum(first, len(held) - 1)], salts)
    plan = spark.sparkContext.broadcast((plan_bins(counts, capacity, None), before, first))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, before, first = plan.value
        width = int(slots[:, 2].max()) + 1 if len(slots) else 1
        keys = slots[:, 0] * width + slots[:, 1]
        for batch in batches:
            got = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "_salt", "_rank")}
            rank = before[first[got["length"]] + got["_salt"]] + got["_rank"]
            at = np.searchsorted(keys, got["length"] * width + rank, side="right") - 1
            own = [batch.column(x) for x in ("_id", "piece", "start", "length", "ids_crc32")]
            place = [pa.array(slots[at, 3] + rank - slots[at, 1]), pa.array(slots[at, 4])]
            yield pa.RecordBatch.from_arrays(own + place, [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    own = Window.partitionBy("length", "_salt").orderBy("_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("_rank", F.row_number().over(own).cast("long") - 1)
    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
