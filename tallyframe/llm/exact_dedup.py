"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

#: Fixed by the contract: characters that do not count when texts are compared.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, "")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 64,
    filter_slots: int = 1 << 20,
    digest_all: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: who stays of each group of equal texts.

    Texts are equal if they are identical without white space; null counts as
    empty. Of equal texts the one with the most code points stays, then the one
    with the smallest id (a null id comes last). Rows that repeat an id with an
    equal text of the same length share its decision. Texts may be of any length. An empty table
    gives no rows, and columns of ``docs`` other than the two named ones are never touched.

    Three refinements, each over what the one before left over:

    1. and 2. rows are counted by normalised length and, within a length, by the
       hash of the first ``prefix_chars`` characters; a length or prefix that occurs
       once is settled. Both are one grouping, combined before the shuffle, so that
       a length with very many rows is no key of a join;
    3. only rows that may still have an equal (their pair of length and prefix
       hash fell in a slot that holds a repeated pair) get the full SHA-256 and
       are grouped by it.

    The slots between 2 and 3 are at most ``filter_slots`` integers, so they are
    broadcast whatever the input's size; a slot shared by chance only adds a row
    to step 3. Counts are combined before each shuffle; the last join is a plain
    equi-join of two shuffled sides, whose hot groups Spark can split.

    ``digest_all`` computes the digest of every row, for callers that want it;
    otherwise ``text_sha256`` is null where step 3 was not needed.
    """
    text = text_of(docs, text_col)
    norm = normalised(text)
    slot = F.pmod(F.xxhash64("_len", "_prefix"), F.lit(filter_slots))

    keyed = docs.select(F.length(norm).alias("_len"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("_prefix"))
    # One pass counts by length and prefix hash; a pair that occurs again has a length that does, so lengths need no join.
    by_prefix = keyed.groupBy("_len", "_prefix").agg(F.count("*").alias("_n")).where("_n > 1")
    slots = by_prefix.select(slot.alias("_slot")).distinct().withColumn("_again", F.lit(True))

    rows = (
        docs.select(docs[id_col].alias("_id"), F.length(text).alias("_chars"), norm.alias("_norm"))
        .withColumn("_len", F.length("_norm"))
        .withColumn("_prefix", F.xxhash64(F.substring("_norm", 1, prefix_chars)))
        .withColumn("_slot", slot)
        .join(F.broadcast(slots), "_slot", "left")
    )
    full = F.sha2("_norm", 256)
    digest = full if digest_all else F.when(F.col("_again"), full)
    rows = rows.select("_id", "_chars", F.coalesce("_again", F.lit(False)).alias("_again"), digest.alias("_sha"))
    rows = written(rows)

    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("e"), F.col("_id").alias("k")))
    groups = written(
        rows.where("_again").groupBy("_sha").agg(F.count("*").alias("_size"), best.alias("_best")).where("_size > 1")
        .select(F.col("_sha").alias("_key"), "_size", F.col("_best.k").alias("_keep"), F.col("_best.c").alias("_c"))
    )
    # A row of no group gets a key of its own, so that no null piles up in one partition.
    key = F.when(F.col("_again"), F.col("_sha")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    joined = rows.withColumn("_key", key).join(groups, "_key", "left")
    grouped = F.col("_size").isNotNull()
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(grouped, F.col("_keep")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (~grouped | (F.col("_id").eqNullSafe(F.col("_keep")) & (-F.col("_chars") == F.col("_c")))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
