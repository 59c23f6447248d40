"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Fixed by the contract: what separates words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Every window of ``window`` consecutive words of an item; a shorter item is one window."""
    w = items.select(items[item_col].cast("string").alias("_item"), words_of(items[text_col]).alias("_ws")).where("size(_ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("_ws") - window + 1, F.lit(1)))
    return w.select("_item", "_ws", F.explode(starts).alias("_s")).select("_item", F.slice("_ws", F.col("_s"), window).alias("_window"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    share: int = 20,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """One row per row of ``docs``: how much of it occurs in benchmark items.

    A document word is hit if it lies inside an occurrence of an item window
    (``window`` consecutive item words; a shorter, non-empty item is one
    window). ``contaminated``: ``n_hit > 0`` and ``share * n_hit >= n_words``.
    Null or wordless texts have no words and no hits, null or wordless items
    have no windows, repeated rows count each for itself, items that repeat an
    id count once, an item with a null id marks hits but is not counted.

    A prefix-filtered set join: the words of a window are ordered by rarity in
    the whole corpus. Containment of the whole window is asked for, so the
    necessary prefix is the single rarest word. Documents' words join the
    windows on it, the position of the word in the window bounds where the
    window can begin and whether it fits in the document's length, and what is
    left is verified by comparing the slice with the window.

    Of equally rare words of a window the first decides. Texts may be of any
    length; other columns of ``docs``, whatever their names, are not touched.

    The windows, and the counts of their words, are broadcast only if the windows
    are at most ``broadcast_rows`` (counted first); otherwise the join shuffles words and positions, and
    candidates meet their document again by its row number.
    """
    windows = written(
        item_windows(items, item_col, item_text_col, window)
        .groupBy("_window").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    )
    small = windows.count() <= broadcast_rows
    maybe_broadcast = F.broadcast if small else (lambda df: df)

    doc_words = docs.select(docs[id_col].alias("_id"), F.monotonically_increasing_id().alias("_row"), words_of(docs[text_col]).alias("_ws"))

    vocabulary = windows.select(F.explode("_window").alias("_w")).distinct()
    spoken = doc_words.select(F.explode("_ws").alias("_w")).join(maybe_broadcast(vocabulary), "_w", "left_semi")
    frequency = spoken.groupBy("_w").agg(F.count("*").alias("_df"))
    rare = (
        windows.select("_window", "_items", F.posexplode("_window").alias("_at", "_w"))
        .join(maybe_broadcast(frequency), "_w", "left")
        .groupBy("_window", "_items")
        .agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("df"), "_at", "_w")).alias("_r"))
        .select("_window", "_items", F.col("_r._w").alias("_w"), F.col("_r._at").alias("_at"))
    )
    # One row with an empty word stands for each document, so that those without hits are counted in the same pass.
    sentinel = rare.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("_window"), F.array().cast("array<string>").alias("_items"), F.lit("").alias("_w"), F.lit(0).alias("_at")
    )
    prefixes = written(rare.unionByName(sentinel))

    said = doc_words.withColumn("_n", F.size("_ws"))
    said = said if small else written(said)  # row numbers are joined on, so they are settled first
    begins = F.col("_pos") - F.col("_at") + 1
    size = F.size("_window")
    fits = (begins >= 1) & (begins + size - 1 <= F.col("_n"))
    if small:
        tokens = said.select("_id", "_row", "_n", "_ws", F.posexplode(F.array_append("_ws", F.lit(""))).alias("_pos", "_w"))
        found = tokens.join(F.broadcast(prefixes), "_w").where(
            (F.col("_w") == "") | (fits & (F.slice("_ws", F.greatest(begins, F.lit(1)), size) == F.col("_window")))
        )
    else:
        tokens = said.select("_row", "_n", F.posexplode("_ws").alias("_pos", "_w"))
        near = tokens.join(prefixes, "_w").where(fits).select("_row", "_pos", "_at", "_window", "_items")
        whole = said.select("_id", "_row", "_n", "_ws")
        hits = near.join(whole, "_row").where(F.slice("_ws", F.greatest(begins, F.lit(1)), size) == F.col("_window"))
        none = whole.select("_id", "_row", "_n", F.lit(0).alias("_pos"), F.lit("").alias("_w"), F.lit(0).alias("_at"), F.array().cast("array<string>").alias("_window"), F.array().cast("array<string>").alias("_items"))
        found = hits.withColumn("_w", F.lit("+")).select(none.columns).unionByName(none)
    spans = found.select(
        "_id", "_row", "_n",
        F.when(F.col("_w") != "", F.sequence(begins, begins + size - 1)).alias("_hit"),
        "_items",
    )
    per_doc = spans.groupBy("_row", "_id").agg(
        F.max("_n").alias("_n"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_hit")))).alias("_n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_found"),
    )
    return per_doc.select(
        F.col("_id").alias(id_col),
        F.col("_n").cast("long").alias("n_words"),
        F.col("_n_hit").cast("long").alias("n_hit"),
        F.size("_found").cast("long").alias("n_items"),
        F.sha2(F.array_join("_found", ","), 256).alias("items_sha256"),
        ((F.col("_n_hit") > 0) & (share * F.col("_n_hit") >= F.col("_n"))).alias("contaminated"),
    )
