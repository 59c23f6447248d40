"""Near-duplicate groups by ProbMinHash signatures, banding and exact verification."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, text_of, written
from .components import connected_components

WORD = re.compile(r"\w+")
SHINGLE = 5
CHARS_AT_ONCE = 4_000_000
GOLDEN, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of the SplitMix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def weighted_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The distinct shingles of texts, by text: owner, 44-bit hash (sorted in each text), weight; and a digest of each text's words.

    A shingle is five consecutive words (lower-cased runs of letters, digits
    and underscores); fewer words, but not none, are one shingle. A shingle
    that occurs n times weighs 1 + ln n.
    """
    split = [WORD.findall(t.lower()) for t in texts]
    number: dict[str, int] = {}
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64, int(sizes.sum()))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
    spoken = hashes[flat]
    ends = np.cumsum(sizes)
    digests = [xxhash.xxh3_128_digest(spoken[e - n : e].tobytes()) for e, n in zip(ends, sizes, strict=True)]

    wide = np.where(sizes > 0, np.maximum(sizes, SHINGLE), 0)
    padded = np.zeros(int(wide.sum()), np.uint64)
    starts = np.cumsum(wide) - wide
    padded[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(spoken))] = spoken
    count = np.maximum(wide - SHINGLE + 1, 0)
    owner = np.repeat(np.arange(len(texts)), count)
    at = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    h = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        h = mixed(h * np.uint64(31) + padded[at + k] + GOLDEN)
    key = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1), 1 + np.log(times), digests


def prob_min_hash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures of ``n`` weighted sets: the element that holds each register.

    Every element is a Poisson process with its weight as rate, driven by a
    generator seeded with the element; each arrival goes to a random register,
    which keeps its earliest one. An element stops as soon as its next arrival
    is later than every register of its set, so most elements stop at once. Two
    sets agree in a register with the probability that is their probability
    Jaccard similarity.
    """
    time = np.full(n * registers, np.inf)
    held = np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    state, arrival = mixed(element + GOLDEN), np.zeros(len(element))
    while len(owner):
        state = state + GOLDEN
        draw = mixed(state)
        arrival = arrival - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight
        going = arrival <= latest[owner]
        owner, element, weight, state, arrival = (x[going] for x in (owner, element, weight, state, arrival))
        at = owner * registers + (mixed(state ^ MIX2) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(time, at, arrival)
        won = time[at] == arrival
        held[at[won]] = element[won]
        active = np.unique(owner)
        latest[active] = time.reshape(n, registers)[active].max(1)
    return held.reshape(n, registers)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets with sorted, distinct elements."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    alone_a, alone_b = wa.sum() - wa[ia].sum(), wb.sum() - wb[ib].sum()
    ca, cb = wa[ia], wb[ib]
    ratio, which = np.unique(ca / cb, return_inverse=True)
    total = np.array([alone_a + r * alone_b + np.maximum(ca, r * cb).sum() for r in ratio])
    return float((ca / total[which]).sum())


def shingled(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Owner, element and weight of the shingles of texts, a few texts at once; each of them has words."""
    texts, lo = texts.to_pylist(), 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars + len(texts[hi]) < CHARS_AT_ONCE):
            chars += len(texts[hi])
            hi += 1
        yield weighted_shingles(texts[lo:hi])[:3]
        lo = hi


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(_id, _key, _bands) of each row; no key and no bands for a text without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN)
        for batch in batches:
            texts, lo = batch.column(1).to_pylist(), 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars + len(texts[hi]) < CHARS_AT_ONCE):
                    chars += len(texts[hi])
                    hi += 1
                owner, element, weight, digests = weighted_shingles(texts[lo:hi])
                some = np.bincount(owner, minlength=hi - lo) > 0
                held = prob_min_hash(owner, element, weight, hi - lo, bands * rows).reshape(hi - lo, bands, rows)
                band = np.broadcast_to(salt, (hi - lo, bands))
                for k in range(rows):
                    band = mixed(band * np.uint64(31) + held[:, :, k])
                wide = pa.array(band.astype(np.int64).ravel())
                mask = pa.array(~some)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * bands), wide, mask=mask)
                keys = pa.array([d if s else None for d, s in zip(digests, some, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), keys, lists], ["_id", "_key", "_bands"])
                lo = hi

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("_text")).mapInArrow(
        sign, f"_id {kind}, _key binary, _bands array<long>"
    )


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts have an exact probability Jaccard of ``threshold`` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            ta, tb, keep = batch.column(2).to_pylist(), batch.column(3).to_pylist(), np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(ta, tb, strict=True)):
                if x != last:
                    last, left = x, weighted_shingles([x])
                right = weighted_shingles([y])
                n, m = sorted((len(left[1]), len(right[1])))
                keep[i] = n and (n + 1e-9 >= threshold * m or left[2].max() + right[2].max() > 2) and probability_jaccard(left[1], left[2], right[1], right[2]) >= threshold - 1e-12
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    kind = texts.schema["_id"].dataType.simpleString()
    both = (
        pairs.join(texts.select(F.col("_id").alias("b"), F.col("_text").alias("tb")), "b")
        .join(texts.select(F.col("_id").alias("a"), F.col("_text").alias("ta")), "a")
    )
    return written(both.select("a", "b", "ta", "tb").mapInArrow(check, f"a {kind}, b {kind}"))


#: Parts into which a text's shingles are counted by their hash.
PARTS = 64


def may_reach(a: Column | np.ndarray, b: Column | np.ndarray, threshold: float) -> Column | np.ndarray:
    """Whether two texts that share ``a`` of the weight of the one and ``b`` of the other, at most, can have a probability Jaccard of ``threshold``.

    It is at most ab/(a+b-ab): a common shingle of weights p and q counts at most
    pq/(q+(1-b)p), which is concave, and sums to that.
    """
    return (a > 0) & (b > 0) & (a * b >= (threshold - 1e-6) * (a + b - a * b))


#: Texts of one block of a shingle's texts, about, and pairs whose counts are compared at once.
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 16


def reaching(x: np.ndarray, y: np.ndarray, of: dict[str, np.ndarray], threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows ``x`` and ``y`` of different classes that may match, if the shingle at hand is the first that they share.

    What stands before it is not in common. Nor are shingles in excess of the other's
    in one of the ``PARTS``, each of which weighs ``least`` or more. Rows are in the
    order of their class; if both are the ``same``, each pair is told once.
    """
    code, before, counts, total = of["own"], of["before"], of["counts"], of["total"]
    step = max(1, PAIRS_AT_ONCE // max(1, len(y)))
    for lo in range(0, len(x), step):
        tile, other = x[lo : lo + step], y[lo:] if same else y
        if code[tile[0]] == code[tile[-1]]:
            other = other[code[other] != code[tile[0]]]
        can = (code[tile][:, None] != code[other]) & may_reach(1 - before[tile][:, None], 1 - before[other], threshold)
        i, j = np.nonzero(can)
        i, j = tile[i], other[j]
        if same:  # in the order of classes, so of two classes the lesser comes first
            i, j = i[code[i] < code[j]], j[code[i] < code[j]]
        excess = np.maximum(counts[i] - counts[j], 0).sum(1, dtype=np.int64)
        a = np.minimum(1 - before[i], 1 - of["alone"][i] - excess * of["least"][i])
        b = np.minimum(1 - before[j], 1 - of["alone"][j] - (excess - total[i] + total[j]) * of["least"][j])
        keep = may_reach(a, b, threshold)
        if keep.any():
            yield i[keep], j[keep]


def close(firsts: DataFrame, threshold: float) -> DataFrame:
    """The distinct pairs (a, b) of texts of other classes whose prefix shingles (``prefixes``, with ``own`` as it is now) let them match, written.

    Pairs of texts that share a shingle are looked at in numpy and only those that
    may match become rows. A shingle's texts are cut into blocks of about ``BLOCK``,
    and each two blocks meet in a row of their own, so that no task has all texts
    of a shingle, however many there are.
    """
    kind = firsts.schema["rep"].dataType.simpleString()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends, flat = np.cumsum(np.diff(lists.offsets.to_numpy())), lists.flatten()
            of = {c: flat.field(c).to_numpy() for c in ("block", "before", "alone", "least")}
            of["own"] = flat.field("own").dictionary_encode().indices.to_numpy()
            of["counts"] = flat.field("counts").flatten().to_numpy().reshape(-1, PARTS)
            of["total"] = of["counts"].sum(1, dtype=np.int64)
            left, right, made = [], [], 0
            for i, j, lo, hi in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.append(0, ends), ends, strict=False):
                rows = lo + np.argsort(of["own"][lo:hi], kind="stable")
                at = of["block"][rows]
                for x, y in reaching(rows[at == i], rows[at == j], of, threshold, i == j):
                    left.append(x)
                    right.append(y)
                    made += len(x)
                    if made >= 16 * PAIRS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([flat.field("rep").take(pa.array(np.concatenate(z))) for z in (left, right)], ["x", "y"])
                        left, right, made = [], [], 0
            if made:
                yield pa.RecordBatch.from_arrays([flat.field("rep").take(pa.array(np.concatenate(z))) for z in (left, right)], ["x", "y"])

    mixed = firsts.groupBy("element").agg(F.min("own").alias("_a"), F.max("own").alias("_z"), F.count("*").alias("_n")).where("_a <> _z")
    side = F.ceil(F.col("_n") / BLOCK).cast("int")
    rows = firsts.join(mixed.select("element", side.alias("side")), "element").withColumn("block", F.pmod(F.xxhash64("rep"), "side").cast("int"))
    cells = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("side") - 1)))
    held = F.struct("rep", "own", "block", "before", "alone", "counts", "least")
    met = cells.groupBy("element", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j")).agg(F.collect_list(held).alias("texts"))
    pairs = met.select("i", "j", "texts").mapInArrow(meet, f"x {kind}, y {kind}")
    with small_batches(firsts.sparkSession):
        return written(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def prefixes(members: DataFrame, threshold: float) -> DataFrame:
    """(element, rep, before, alone, counts, least): the prefix shingles of each text (_id, _text, own), by which texts of other classes may still match it.

    A probability Jaccard is at most the sum of the lesser of the two weights of
    each shingle, weights being shares of their text. So if all texts order
    their shingles alike and leave out a tail that weighs less than
    ``threshold``, two texts without a common shingle before the tail are below
    it. Shingles that no other class holds come first, they match nothing; then
    those that few texts hold. ``before`` is what comes before a shingle: if it
    is the first that two texts share, neither shares that part with the other.
    ``alone`` is the weight of shingles that no other class holds, ``counts`` are
    the numbers of the others by part of their hash, 127 at most, and ``least`` is
    the smallest weight of one.
    Shingles whose smallest part before them is too large already are left out.
    """
    kind = members.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for owner, element, weight in shingled(batch.column(1)):
                total = np.bincount(owner, weight)
                at = pa.array(lo + owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(element.astype(np.int64)), batch.column(0).take(at), batch.column(2).take(at), pa.array(weight / total[owner])], ["element", "rep", "own", "share"]
                )
                lo += len(total)

    rows = written(members.select("_id", "_text", "own").mapInArrow(cut, f"element long, rep {kind}, own {kind}, share double"), compression="zstd")
    classes_of = lambda df, *more: df.groupBy("element").agg(F.min("own").alias("_a"), F.max("own").alias("_z"), *more).where("_a <> _z").drop("_a", "_z")
    met = classes_of(rows, F.count("*").alias("n"))
    lists = rows.join(met, "element").groupBy("rep").agg(F.first("own").alias("own"), F.sort_array(F.collect_list(F.struct("n", "element", "share"))).alias("list"))

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            flat = batch.column(2).flatten()
            share, owner = flat.field("share").to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
            upto = np.cumsum(share)
            total = np.bincount(owner, share, len(sizes))
            before = 1 - total[owner] + upto - share - (np.cumsum(total) - total)[owner]
            counts = np.zeros((len(sizes), PARTS), np.int64)
            np.add.at(counts, (owner, flat.field("element").to_numpy() % PARTS), 1)
            least = np.full(len(sizes), np.inf)
            np.minimum.at(least, owner, share)
            keep = np.flatnonzero(1 - before >= threshold - 1e-6)
            own = owner[keep]
            held = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * PARTS), pa.array(np.minimum(counts, 127)[own].astype(np.int8).ravel()))
            columns = [flat.field("element").take(pa.array(keep)), batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), pa.array(before[keep]), pa.array(1 - total[own]), held, pa.array(least[own])]
            yield pa.RecordBatch.from_arrays(columns, ["element", "rep", "own", "before", "alone", "counts", "least"])

    firsts = written(lists.select("rep", "own", "list").mapInArrow(head, f"element long, rep {kind}, own {kind}, before double, alone double, counts array<tinyint>, least double"))
    first = classes_of(firsts, F.min("before").alias("_first"))
    out = written(firsts.join(first, "element").where(may_reach(1 - F.col("before"), 1 - F.col("_first"), threshold)).drop("_first", "own"))
    discard(rows, firsts)
    return out


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    bands: int = 32,
    rows: int = 4,
    rounds: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: the class of near copies it belongs to.

    Two texts are linked if the probability Jaccard of their weighted word
    shingles is ``threshold`` or more; a class is a connected component, named
    by its smallest id; ``kept`` marks the row with that id. Texts without words
    (null and empty ones too) are linked to none. Rows with a null id are in no
    class (null) and kept. Rows that repeat an id share a class. An empty table
    gives no rows.

    Texts with the same words in the same order are one node. Nodes that agree
    in a band share a bucket. A bucket's members are compared with its smallest
    and largest one. Members of buckets that are of several classes still are
    told apart by prefix shingles: those that can match no other class leave.
    For at most ``rounds`` rounds, as long as they join anything, a random member of
    each bucket, the head, is compared with those of other classes, which joins
    most of what belongs together; then
    every pair of other classes is compared whose prefix shingles let it match, so
    no link between classes is lost. With 32 bands of 4 registers a pair at 0.8
    shares no bucket with probability 5e-8. Every pair is verified exactly on
    the two whole texts, however long; ties of weights do not matter to that.
    Columns of ``docs`` other than the two named ones are not touched.
    """
    signed = written(signatures(docs, id_col, text_col, bands, rows))
    nodes = written(
        signed.where("_key is not null and _id is not null").groupBy("_key").agg(F.min("_id").alias("rep"), F.first("_bands").alias("_bands"))
    )
    banded = nodes.select("rep", F.explode("_bands").alias("bucket"))
    ends = banded.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    shared = written(banded.join(ends, "bucket").select("bucket", "rep", "lo", "hi"))
    ids = shared.select(F.col("rep").alias("_id")).distinct()
    texts = written(docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("_text")).join(ids, "_id", "left_semi"))

    pairs = written(
        shared.select("rep", F.explode(F.array("lo", "hi")).alias("other")).where("rep <> other")
        .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()
    )
    tried, edges = pairs, verified(pairs, texts, threshold)
    classes = connected_components(edges)

    def placed(rows: DataFrame) -> DataFrame:
        """``rows`` with the class of each ``rep``."""
        return rows.join(classes, rows.rep == classes.node, "left").select(rows["*"], F.coalesce("component", "rep").alias("own"))

    def split(rows: DataFrame) -> DataFrame:
        """The rows of buckets that hold several classes."""
        mixed = rows.groupBy("bucket").agg(F.min("own").alias("_a"), F.max("own").alias("_z")).where("_a <> _z").select("bucket")
        return rows.join(mixed, "bucket")

    def compared(found: DataFrame) -> bool:
        """Verifies the pairs that have not been tried, and joins classes; whether it joined any."""
        nonlocal tried, edges, classes
        more = written(found.join(tried, ["a", "b"], "left_anti"))
        if more.isEmpty():
            return False
        good = verified(more, texts, threshold)
        tried = tried.unionByName(more)
        if good.isEmpty():
            return False
        edges = edges.unionByName(good)
        classes = connected_components(edges)
        return True

    pair = (F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b"))
    left = written(split(placed(shared.where("rep <> lo and rep <> hi").select("bucket", "rep"))))
    if not left.isEmpty():
        members = left.select(F.col("rep").alias("_id"), "own").distinct()
        firsts = prefixes(texts.join(members, "_id"), threshold)
        left = written(left.join(firsts.select("rep").distinct(), "rep", "left_semi").select("bucket", "rep"))
        for step in range(rounds):
            now = split(placed(left)).withColumn("draw", F.xxhash64("rep", F.lit(step)))
            heads = now.groupBy("bucket").agg(F.min_by("rep", "draw").alias("head"), F.min_by("own", "draw").alias("of"))
            if not compared(now.join(heads, "bucket").where("own <> of").select(*pair).distinct()):
                break
        compared(close(placed(firsts), threshold))
    named = written(
        nodes.join(classes, nodes.rep == classes.node, "left").select(F.col("_key"), F.coalesce("component", "rep").alias("_class"))
    )
    out = signed.select("_id", "_key").join(named, "_key", "left")
    label = F.coalesce("_class", "_id")
    return out.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_id").isNotNull(), label).alias("class_id"),
        (F.col("_id").isNull() | (F.col("_id") == label)).alias("kept"),
    )
