"""Duplicate keys of one frame, and of a pair against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..rules import COUNT_MISMATCH, MATCH, ONLY_IN_SOURCE, ONLY_IN_TARGET, TablePair, resolve


def duplicate_keys(df: DataFrame, keys: list[str], at_least: int = 2) -> DataFrame:
    """Keys that occur ``at_least`` times, with their counts; order by ``duplicate_count`` descending to show them."""
    return df.groupBy(*resolve(df.columns, keys)).agg(F.count("*").alias("duplicate_count")).where(F.col("duplicate_count") >= at_least)


def most_duplicated(df: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """Duplicated keys by falling count, then key; the first ``n`` if it is given."""
    found = duplicate_keys(df, keys).orderBy(F.desc("duplicate_count"), *(F.col(f"`{k}`").asc_nulls_last() for k in resolve(df.columns, keys)))
    return found.limit(n) if n else found


def duplicate_reconciliation(pair: TablePair, keys: list[str]) -> DataFrame:
    """Keys duplicated on either side, with both counts (0: not duplicated there) and a status; null keys are keys.

    Both sides are tagged and counted in a single shuffle.
    """
    tagged = [df.select(*(F.col(f"`{c}`").alias(k.lower()) for c, k in zip(resolve(df.columns, keys), keys, strict=True)), F.lit(s).alias("_src")) for df, s in ((pair.source, 1), (pair.target, 0))]
    counts = tagged[0].unionByName(tagged[1]).groupBy(*(k.lower() for k in keys)).agg(F.sum("_src").alias("s"), F.sum(1 - F.col("_src")).alias("t"))
    counts = counts.where("s > 1 or t > 1").withColumns({"source_count": F.when(F.col("s") > 1, F.col("s")).otherwise(0), "target_count": F.when(F.col("t") > 1, F.col("t")).otherwise(0)})
    status = F.when(F.col("target_count") == 0, ONLY_IN_SOURCE).when(F.col("source_count") == 0, ONLY_IN_TARGET).when(F.col("source_count") == F.col("target_count"), MATCH).otherwise(COUNT_MISMATCH)
    return counts.select(*(k.lower() for k in keys), "source_count", "target_count", status.alias("status"))


def duplicate_summary(reconciled: DataFrame) -> DataFrame:
    """One row over ``duplicate_reconciliation``: keys and rows per side, matches, and the overall status."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    rows = reconciled.agg(
        F.count_if(F.col("source_count") > 0).alias("source_duplicate_keys"), F.count_if(F.col("target_count") > 0).alias("target_duplicate_keys"),
        total("source_count").alias("source_duplicate_rows"), total("target_count").alias("target_duplicate_rows"),
        F.count_if(F.col("status") == MATCH).alias("matched_keys"), F.count_if(F.col("status") != MATCH).alias("mismatched_keys"),
    )
    return rows.withColumn("overall_status", F.when(F.col("mismatched_keys") > 0, "MISMATCH").otherwise("MATCH"))
