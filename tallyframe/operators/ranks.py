"""Running sums, exact percentiles and distinct counts without a group's values in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import discarded, settled

#: Up to so many counted rows a group may be summed in one task; beyond that, groups are ranged over partitions.
ONE_TASK_ROWS = 1_000_000


def cells_of(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., column_name, v): each of ``columns`` of each row as a double."""
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns))
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.column_name", "c.v")


def matched(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner", also_right: list[str] | None = None) -> DataFrame:
    """``left`` joined with ``right`` (its columns ``also_right``, or all) on equal ``names``, null equal to null; the names stay once, as of the left side."""
    own = {n: f"_right_{n}" for n in names}
    right = right if also_right is None else right.select(*names, *also_right)
    on = reduce(lambda x, y: x & y, (F.col(f"`{n}`").eqNullSafe(F.col(f"`{r}`")) for n, r in own.items()))
    return left.join(right.withColumnsRenamed(own), on, how).drop(*own.values())


def running_sums(counted: DataFrame, by: list[str], order: list[Column], sums: list[str], near: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, table to discard): ``counted`` with, for each column c of ``sums``, ``c_before`` (its sum over the rows of the group that come earlier in ``order``) and ``c_total``.

    Rows are settled once. If they are many they are ranged over partitions by
    group and order; the sums of the ranges, of which there are no more than
    groups and partitions together, are added to the sums within a range, so no
    task holds more than a range, however large a group is. ``near`` is a condition over
    ``c_before``, ``c_total`` and ``c`` of a range: only rows of ranges that meet it are given.
    """
    held = settled(counted)
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(earlier(w)), F.lit(0))
    if held.count() <= ONE_TASK_ROWS:
        group = Window.partitionBy(*by)
        return held.withColumns({f"{c}_before": before(c, group.orderBy(*order)) for c in sums} | {f"{c}_total": F.sum(c).over(group) for c in sums}), held
    ranged = settled(held.repartitionByRange(*(F.col(b) for b in by), *order).withColumn("_part", F.spark_partition_id()))
    discarded(held)
    parts = ranged.groupBy(*by, "_part").agg(*(F.sum(c).alias(c) for c in sums))
    group = Window.partitionBy(*by)
    parts = parts.withColumns({f"{c}_before": before(c, group.orderBy("_part")) for c in sums} | {f"{c}_total": F.sum(c).over(group) for c in sums})
    parts = (parts if near is None else parts.where(near)).drop(*sums)
    rows = matched(ranged, parts, [*by, "_part"], also_right=[f"{c}_{x}" for c in sums for x in ("before", "total")])
    own = Window.partitionBy(*by, "_part").orderBy(*order)
    return rows.withColumns({f"{c}_before": F.col(f"{c}_before") + before(c, own) for c in sums}).drop("_part"), ranged


def percentiles_of_counts(counted: DataFrame, by: list[str], value: str, n: str, points: list[float]) -> DataFrame:
    """(by..., q): the linear percentiles at ``points`` of each group, from rows of (by..., value, how often)."""
    asked = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(points)))
    at = lambda a: a["p"] * (F.col("_n_total") - 1)
    inside = lambda rank: (rank >= F.col("_n_before")) & (rank < F.col("_n_before") + F.col("_n"))
    wanted = lambda a: inside(F.floor(at(a))) | inside(F.ceil(at(a)))
    rows, held = running_sums(counted.select(*by, F.col(value).alias("_v"), F.col(n).alias("_n")), by, [F.col("_v")], ["_n"], F.exists(asked, wanted))
    hit = rows.select(*by, "_v", "_n_total", F.explode(F.filter(asked, wanted)).alias("_a"))
    ends = hit.groupBy(*by, F.col("_a.i").alias("_i")).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.max(at(F.col("_a"))).alias("at"))
    between = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    found = settled(ends.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", between.alias("q")))), lambda x: x["q"]).alias("q")))  # points of each group
    discarded(held)
    return found


def exact_percentiles(rows: DataFrame, by: list[str], value: str, points: list[float]) -> DataFrame:
    """(by..., q): the linear percentiles of ``value`` at ``points`` in each group, null values aside; groups without values are absent.

    Equal values are counted first, combined before the shuffle.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    return percentiles_of_counts(counted, by, "_v", "_n", points)


def with_percentiles(out: DataFrame, found: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """``out`` with the percentiles of its group as columns ``names``, null where a group has no values."""
    both = matched(out, found.withColumnRenamed("q", "_q"), by, "left")
    return both.select(*out.columns, *(F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(names)))


def distinct_counts(df: DataFrame, columns: list[str], name: str = "distinct_values") -> DataFrame:
    """(column_name, distinct values) of all columns, from one shuffle of their distinct (column, value) pairs."""
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns))
    pairs = df.select(F.explode(cells).alias("c")).select("c.*").where("v is not null").distinct()
    return pairs.groupBy("column_name").agg(F.count("*").alias(name))
