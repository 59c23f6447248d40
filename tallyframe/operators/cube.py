"""Measures over all combinations of dimensions, by grouping sets."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import date_grains
from ..rules import NULL_TEXT
from .ranks import percentiles_of_counts
from .stats import unioned


def dimension_sets(dims: list[str], depth: int, budget: int = 10_000) -> list[tuple[str, ...]]:
    """All combinations of 1 to ``depth`` dimensions; an error if there are more than ``budget``."""
    count = sum(comb(len(dims), k) for k in range(1, min(depth, len(dims)) + 1))
    if count > budget:
        raise ValueError(f"{count} combinations exceed the budget of {budget}")
    return [c for k in range(1, min(depth, len(dims)) + 1) for c in combinations(dims, k)]


def grouped_sets(df: DataFrame, sets: list[tuple[str, ...]], aggs: list[Column], chunk: int = 60, keep: tuple[str, ...] = ()) -> DataFrame:
    """``aggs`` over each set of text dimensions, with the columns of no set null, ``dims`` and ``dim_values``.

    Null dimensions become ``<NULL>`` before grouping, so they differ from
    dimensions that are not grouped. Sets go in chunks, which bounds the
    expansion of each row. Columns of ``keep`` are in every set.
    """
    used = list(dict.fromkeys(d for s in sets for d in s))
    df = df.withColumns({d: F.coalesce(F.col(f"`{d}`").cast("string"), F.lit(NULL_TEXT)) for d in used})
    out = []
    for lo in range(0, len(sets), chunk):
        part = sets[lo : lo + chunk]
        own = list(dict.fromkeys(d for s in part for d in s))
        out.append(df.groupingSets([[F.col(f"`{c}`") for c in (*keep, *s)] for s in part], *(F.col(f"`{c}`") for c in (*keep, *own))).agg(*aggs))
    every = unioned(out)
    every = every.withColumns({d: F.lit(None).cast("string") for d in used if d not in every.columns})
    dims = F.concat_ws(" | ", *(F.when(F.col(f"`{d}`").isNotNull(), d) for d in used))
    values = F.concat_ws(" | ", *(F.col(f"`{d}`") for d in used))
    return every.withColumns({"dims": dims, "dim_values": values})


def with_medians(groups: DataFrame, df: DataFrame, sets: list[tuple[str, ...]], measure: Column) -> DataFrame:
    """``groups`` of ``sets`` with the exact median of ``measure``.

    Values are counted by (set, group, value), all sets in one expansion and combined before the
    shuffle; the counts of all sets are ranked together (``percentiles_of_counts``), so a group
    that is the whole table is no task's.
    """
    used = list(dict.fromkeys(d for s in sets for d in s))
    counted = grouped_sets(df.withColumn("_measure", measure).where("_measure is not null"), sets, [F.count("*").alias("_often")], keep=("_measure",))
    found = percentiles_of_counts(counted.select(*(F.col(f"`{d}`").alias(f"_d{i}") for i, d in enumerate(used)), "_measure", "_often"), [f"_d{i}" for i in range(len(used))], "_measure", "_often", [0.5]).withColumnRenamed("q", "_median")
    on = reduce(lambda a, b: a & b, (F.col(f"`{d}`").eqNullSafe(F.col(f"_d{i}")) for i, d in enumerate(used)))
    return groups.join(found, on, "left").withColumn("median", F.get("_median", F.lit(0))).drop("_median", *(f"_d{i}" for i in range(len(used))))


def measure_by_dims(df: DataFrame, dims: list[str], measure: str, depth: int = 3, least_rows: int = 1, budget: int = 10_000) -> DataFrame:
    """Group rows, count, sum, mean, median, min, max and standard deviation of a measure over all combinations of dimensions."""
    m = F.col(f"`{measure}`").cast("double")
    aggs = [F.count("*").alias("group_rows"), F.count(m).alias("count"), F.sum(m).alias("sum"), F.avg(m).alias("mean"), F.min(m).alias("min"), F.max(m).alias("max"), F.stddev_samp(m).alias("std")]
    sets = dimension_sets(dims, depth, budget)
    return with_medians(grouped_sets(df, sets, aggs).where(F.col("group_rows") >= least_rows), df, sets, m)


def measure_by_dims_time(df: DataFrame, dims: list[str], measure: str, date_col: str, depth: int = 2, grains: tuple[str, ...] = ("year", "month", "year_week"), budget: int = 10_000) -> DataFrame:
    """The same, by date grain: every set is crossed with each grain, alone included."""
    every = date_grains(F.col(f"`{date_col}`"))
    names = [f"grain_{g}" for g in grains]
    timed = df.withColumns({n: every[g].cast("string") for n, g in zip(names, grains, strict=True)})
    sets = [(n, *s) for n in names for s in [(), *dimension_sets(dims, depth, budget)]]
    if len(sets) > budget:
        raise ValueError(f"{len(sets)} combinations exceed the budget of {budget}")
    m = F.col(f"`{measure}`").cast("double")
    aggs = [F.count("*").alias("group_rows"), F.sum(m).alias("sum"), F.avg(m).alias("mean")]
    return with_medians(grouped_sets(timed, sets, aggs), timed, sets, m)
