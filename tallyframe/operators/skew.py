"""Full outer joins whose hot keys are dealt over many tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows are first counted in so many slots of key hashes, whose counts the driver reads.
SLOTS = 1 << 16
#: At most so many keys are hot: a key is, if it has more than its share of the rows.
MOST_HOT = 10_000
#: Inputs that Spark estimates to be smaller, both together, are joined without counting: no key of theirs is too large for a task.
COUNTED_BYTES = 32 << 20
#: Rows of a hot key that both sides have are repeated so often at most, on average: beyond that its cells become larger, not more.
MOST_COPIES = 16


def estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def hot_keys(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], rows: int) -> DataFrame | None:
    """(_h0.., n_left, n_right) of the keys with more than ``rows`` rows, and more than a ``MOST_HOT``-th of all; null keys are counted like others. None if there is none.

    Both sides are counted by slots of key hashes, combined before the shuffle;
    only rows of crowded slots are counted by key. Neither count moves the
    rows' other columns, and no more than ``MOST_HOT`` keys come back.
    """
    names = [f"_h{i}" for i in range(len(left_keys))]
    tagged = lambda df, keys, one: df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.lit(one).alias("_left"))
    both = tagged(left, left_keys, 1).unionByName(tagged(right, right_keys, 0))
    slot = F.pmod(F.xxhash64(*names), F.lit(SLOTS)).cast("int")
    counts = both.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect()  # at most a row for each slot
    least = max(rows, sum(r["n"] for r in counts) // MOST_HOT)
    crowded = [r["slot"] for r in counts if r["n"] > least]
    if not crowded:
        return None
    per_key = both.where(slot.isin(crowded)).groupBy(*names).agg(F.sum("_left").alias("n_left"), F.sum(1 - F.col("_left")).alias("n_right"))
    found = per_key.where(F.col("n_left") + F.col("n_right") > least).collect()  # at most MOST_HOT
    return left.sparkSession.createDataFrame(found, per_key.schema) if found else None


def full_outer(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], rows: int | None = None, cell_rows: int = 2_000) -> DataFrame:
    """The full outer join on equal keys, null equal to null; columns of both sides, whose names must differ.

    Spark cannot split a key of a full outer join. So keys with more than
    ``rows`` rows are counted first; of a hot key that both sides have, left
    rows are dealt over salts of about ``cell_rows`` rows and repeated for each salt of the
    right side, and the other way round: each pair of rows meets in one cell of
    that grid, and cells are even. Such a key has no unmatched rows, so rows
    that a cell leaves unmatched are dropped; hot rows of one side alone are
    only dealt out, and told once. All other rows are joined as they are, in the same join.

    ``rows`` of None counts (beyond a million) only if the inputs are large.
    """
    on = reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left_keys, right_keys, strict=True)))
    if rows is None:
        small = estimated_bytes(left) + estimated_bytes(right) <= COUNTED_BYTES
        hot = None if small else hot_keys(left, right, left_keys, right_keys, 1_000_000)
    else:
        hot = hot_keys(left, right, left_keys, right_keys, rows)
    if hot is None:
        return left.join(right, on, "full_outer")

    cell_rows = min(cell_rows, rows or cell_rows)
    l, r = F.col("n_left").cast("double"), F.col("n_right").cast("double")
    cell = F.greatest(F.lit(cell_rows), F.ceil(2 * l * r / (MOST_COPIES * (l + r))))
    salts = lambda n: F.greatest(F.ceil(F.col(n) / cell), F.lit(1)).cast("int")
    hot = hot.withColumns({"_ls": salts("n_left"), "_rs": salts("n_right"), "_both": (F.col("n_left") > 0) & (F.col("n_right") > 0)})

    def dealt(df: DataFrame, keys: list[str], own: str, other: str, tag: str) -> DataFrame:
        """``df`` with the cell of each row: its own salt, and every salt of the other side if that has the key too."""
        at = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)))
        marked = df.join(F.broadcast(hot), at, "left")  # at most MOST_HOT rows
        # Dealt before rows are repeated, so that all copies of a row have its salt.
        marked = marked.withColumn(f"{tag}_own", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col(own)), F.lit(0)).cast("int"))
        every = F.when(F.col("_both"), F.sequence(F.lit(0), F.col(other) - 1)).otherwise(F.array(F.lit(0)))
        return marked.select(*df.columns, f"{tag}_own", F.coalesce("_both", F.lit(False)).alias(f"{tag}_both"), F.explode(every).alias(f"{tag}_other"))

    a, b = dealt(left, left_keys, "_ls", "_rs", "_a"), dealt(right, right_keys, "_rs", "_ls", "_b")
    joined = a.join(b, on & (F.col("_a_own") == F.col("_b_other")) & (F.col("_a_other") == F.col("_b_own")), "full_outer")
    unmatched = F.col("_a_own").isNull() | F.col("_b_own").isNull()
    told = ~(unmatched & F.coalesce("_a_both", "_b_both"))
    return joined.where(told).select(*left.columns, *right.columns)
