"""Importance resampling towards a target corpus, over postings dealt out by bucket."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, small_batches, text_of, written

#: Fixed by the contract: words, after A-Z are lower-cased, and the number of buckets.
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BUCKETS = 10_000
#: Buckets in one part of the postings, and what a chunk of documents holds at most (unless one text is longer).
WIDTH = 128
PARTS = -(-BUCKETS // WIDTH)
CHUNK_BYTES, CHUNK_DOCS = 4 << 20, 4096
#: Bytes of postings that one salt of a part holds, about.
SALT_BYTES = 32 << 20
#: Of the files of chunks: row groups and pages that hold few blocks, since a group is written and a page read as a whole.
SMALL_GROUPS = {"parquet.block.size": str(2 << 20)} | {f"parquet.{x}.size.row.check.{k}": n for x in ("block", "page") for k, n in (("min", "4"), ("max", "16"))}


def features(text: str) -> tuple[int, list[int]]:
    """The number of words, and the bucket of each word and of each pair of neighbours."""
    words = WORD.findall(text.encode().lower())  # of bytes, lower() changes A-Z only
    singles = [crc32(w) for w in words]
    pairs = [crc32(b, crc32(b" ", a)) for a, b in zip(singles, words[1:], strict=False)]  # the sum of a, a space and b goes on from a's
    return len(words), [x % BUCKETS for x in singles + pairs]


def chunk_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of (_id, _text) as chunks of documents with their postings, sorted by bucket and document.

    A chunk has a row without a part, which holds the documents' ids, words and features, how many
    features fall in each bucket and the bytes of all postings, and a row for each part of the
    buckets with its postings (bucket, document, count) as packed integers.
    """
    first, made = TaskContext.get().partitionId() << 32, 0
    ids: list = []
    words: list[int] = []
    found: list[np.ndarray] = []
    size = 0

    def chunk() -> pd.DataFrame:
        nonlocal made, ids, words, found, size
        made += 1
        lengths = np.array([len(x) for x in found], np.int64)
        every = np.concatenate(found) if found else np.zeros(0, np.int64)
        posting, count = np.unique(every * len(ids) + np.repeat(np.arange(len(ids)), lengths), return_counts=True)
        bucket, doc = np.divmod(posting, max(len(ids), 1))
        cuts = np.searchsorted(bucket, np.arange(PARTS + 1) * WIDTH)
        parts, blocks = [], []
        for part, (lo, hi) in enumerate(pairwise(cuts)):
            if hi > lo:
                parts.append(part)
                blocks.append(packed(bucket[lo:hi] % WIDTH, doc[lo:hi], count[lo:hi]))
        at, n = np.unique(every, return_counts=True)
        none = [None] * len(parts)
        out = pd.DataFrame({
            "chunk": first + made, "part": pd.array([None, *parts], "Int32"), "block": [None, *blocks], "bytes": pd.array([sum(map(len, blocks)), *none], "Int64"),
            "ids": [ids, *none], "words": [words, *none], "features": [lengths.tolist(), *none], "buckets": [at.tolist(), *none], "counts": [n.tolist(), *none],
        })
        ids, words, found, size = [], [], [], 0
        return out

    for batch in batches:
        for i, text in zip(batch["_id"], batch["_text"], strict=True):
            n, at = features(text)
            ids.append({"v": i["v"]})
            words.append(n)
            found.append(np.array(at, np.int64))
            size += len(text)
            if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                yield chunk()
    if ids:
        yield chunk()


def packed(bucket: np.ndarray, doc: np.ndarray, count: np.ndarray) -> bytes:
    """A block of postings: how many, and three columns of integers."""
    return np.int32(len(bucket)).tobytes() + bucket.astype(np.uint8).tobytes() + doc.astype(np.uint16).tobytes() + count.astype(np.int32).tobytes()


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(block, np.int32, 1)[0])
    return np.frombuffer(block, np.uint8, n, 4), np.frombuffer(block, np.uint16, n, 4 + n), np.frombuffer(block, np.int32, n, 4 + 3 * n)


def gain(s: int, t: int, whole_s: int, whole_t: int) -> int:
    """By how much a bucket speaks for the target, in thousandths of a nat."""
    return math.floor(1000 * math.log((t + 1) * (whole_s + BUCKETS) / ((s + 1) * (whole_t + BUCKETS))))


def contributions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of postings, each beside its buckets' counts in both corpora, as the sum of gains of each document in them."""
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            s, t = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
            at = row.buckets % WIDTH
            s[at], t[at] = row.s, row.t
            bucket, doc, count = unpacked(row.block)
            used = np.unique(bucket)
            gains = np.zeros(WIDTH, np.int64)
            gains[used] = [gain(int(s[b]), int(t[b]), row.whole_s, row.whole_t) for b in used]
            sums = np.zeros(int(doc.max()) + 1, np.int64)
            np.add.at(sums, doc, gains[bucket] * count)
            out.append((row.chunk, sums.tobytes()))
        yield pd.DataFrame(out, columns=["chunk", "sums"])


def weighed(key: tuple, members: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
    """The documents of one chunk with the floored mean of their gains."""
    rows = members.iloc[0]
    total, n = np.zeros(len(rows["words"]), np.int64), np.array(rows["features"], np.int64)
    for raw in parts["sums"]:
        sums = np.frombuffer(raw, np.int64)
        total[: len(sums)] += sums
    weight = np.floor_divide(total, np.maximum(n, 1))
    return pd.DataFrame({"_id": pd.Series([i["v"] for i in rows["ids"]], dtype=object), "_n_words": rows["words"], "n_features": n, "weight": weight})


def gumbel(seed: int, name: Column) -> Column:
    """The draw of a name in thousandths, settled by the seed."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def chunked(docs: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    """``docs`` as chunks with their postings, written."""
    own = docs[id_col] if id_col else F.lit(None).cast("string")
    kind = docs.schema[id_col].dataType.simpleString() if id_col else "string"
    rows = docs.select(F.struct(own.alias("v")).alias("_id"), text_of(docs, text_col).alias("_text"))
    made = rows.mapInPandas(chunk_rows, f"chunk long, part int, block binary, bytes long, ids array<struct<v: {kind}>>, words array<int>, features array<long>, buckets array<int>, counts array<long>")
    with small_batches(docs.sparkSession):
        return written(made, **SMALL_GROUPS)


def bucket_counts(chunks: DataFrame, name: str) -> DataFrame:
    """(bucket, name): features of a corpus in each bucket that has any, chunks' counts combined before the shuffle."""
    cells = chunks.select(F.explode(F.arrays_zip("buckets", "counts")).alias("c"))
    return cells.groupBy("c.buckets").agg(F.sum("c.counts").alias(name)).withColumnRenamed("buckets", "bucket")


def ranked(rows: DataFrame, order: list, share: int) -> DataFrame:
    """``rows`` with their ``rank`` in ``order``, null beyond ``share`` of a hundred.

    Rows are ranged over partitions in that order; their numbers within a range
    and the sums of the ranges before it give the rank, so no task holds more than a range.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_whole"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    out = ranged.join(F.broadcast(parts), "_part").withColumn("_at", at)
    return out.withColumn("rank", F.when(F.col("_at") <= F.expr(f"_whole * {share} div 100"), F.col("_at")).cast("long")).drop("_part", "_before", "_whole", "_at")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", seed: int = 7, share: int = 25, least_words: int = 20
) -> DataFrame:
    """Per row of ``docs``: n_features, weight, score, and the rank of those drawn.

    Features are words and pairs of neighbours, hashed into 10,000 buckets. A
    bucket's gain is the logarithm of its share in ``target`` over its share in
    ``docs``, both plus one; a document's weight is the mean of its features'
    gains. To the weight comes a Gumbel draw that ``seed`` and the id settle, so the
    ``share`` of a hundred highest scores are a sample without replacement by
    weight, the same every time. Only documents of ``least_words`` words or more are drawn.

    1. Tasks cut texts into postings (bucket, document, count), packed for a
       chunk of documents and a part of the buckets.
    2. Postings go to their part, salted by chunk so that no part is one task's
       however many documents share a bucket, where they meet the counts of
       both corpora in the part's buckets and become sums of gains.
    3. Sums go back to their chunk and are added for each document.

    Null texts count as empty: no features, weight 0, never drawn. A null id
    is drawn as ``null`` and comes last among ties; rows that repeat an id have a row and a rank
    each. An empty target, or empty documents, leave the ones that smooth the
    counts; an empty table gives no rows. Texts of any length are taken whole; other columns, whatever
    their names, are not touched.
    """
    spark = docs.sparkSession
    chunks, other = chunked(docs, id_col, text_col), chunked(target, None, target_text_col)
    corpora = bucket_counts(chunks, "s").join(bucket_counts(other, "t"), "bucket", "full_outer").na.fill(0)
    corpora = written(corpora.select("bucket", "s", "t"))  # at most as many rows as buckets
    whole = corpora.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("whole_s"), F.coalesce(F.sum("t"), F.lit(0)).alias("whole_t"))

    held = chunks.select(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    salts = max(1, -(-held // (SALT_BYTES * PARTS)), int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTS + 1)
    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int")
    postings = chunks.where("part is not null").select("chunk", "part", "block", salt.alias("salt"))
    by_part = corpora.groupBy(F.expr(f"bucket div {WIDTH}").cast("int").alias("part")).agg(F.collect_list(F.struct("bucket", "s", "t")).alias("corpora"))
    by_part = by_part.select("part", *(F.col(f"corpora.{c}").alias(c + "s" * (c == "bucket")) for c in ("bucket", "s", "t"))).crossJoin(F.broadcast(whole)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))  # one row
    met = postings.join(by_part.hint("shuffle_hash"), ["part", "salt"])
    sums = met.select("chunk", "block", "buckets", "s", "t", "whole_s", "whole_t").mapInPandas(contributions, "chunk long, sums binary")

    kind = docs.schema[id_col].dataType.simpleString()
    members = chunks.where("part is null").select("chunk", "ids", "words", "features")
    found = members.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInPandas(weighed, f"_id {kind}, _n_words int, n_features long, weight long")
    name = F.coalesce(F.col("_id").cast("string"), F.lit("null"))
    with small_batches(spark):
        scored = written(found.withColumn("score", F.col("weight") + gumbel(seed, name)))

    order = [F.desc("score"), F.asc_nulls_last("_id")]
    drawn = ranked(scored.where(F.col("_n_words") >= least_words), order, share)
    rest = scored.where(F.col("_n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    discard(other)
    return drawn.unionByName(rest).select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")
