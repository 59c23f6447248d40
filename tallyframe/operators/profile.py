"""Profiles of a single frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.canonical import zone_normalised
from ..functions.classify import CATEGORICAL, DATE, NUMERICAL, TIMESTAMP_NTZ, TIMESTAMP_TZ, classify
from .ranks import cells_of, distinct_counts, exact_percentiles, with_percentiles
from .stats import category_counts, columns_of, unioned

PERCENTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def long_form(df: DataFrame, measures: dict[str, dict[str, object]], batch: int = 40) -> DataFrame:
    """Aggregates all columns, ``batch`` at a time, and turns the single rows into one row per column."""
    names, out = list(measures), []
    for lo in range(0, len(names), batch):
        part = names[lo : lo + batch]
        row = df.agg(*(F.struct(*(c.alias(k) for k, c in measures[n].items())).alias(f"c{i}") for i, n in enumerate(part)))
        cells = [F.struct(F.lit(n).alias("column_name"), *(F.col(f"c{i}.{k}") for k in measures[n])) for i, n in enumerate(part)]
        out.append(row.select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    return unioned(out)


def profile_columns(df: DataFrame, exact: bool = True, samples: int = 0) -> DataFrame:
    """Per column: class, type, non-null and null rows, null percent, distinct values, and optionally sample values.

    Exact distinct values are counted from one shuffle of distinct (column,
    value) pairs; else they are estimated in the same pass as the rest. Samples
    are the ``samples`` smallest values as text, joined by `` | ``.
    """
    measures = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        measures[f.name] = {
            "data_type": F.lit(f.dataType.simpleString()), "column_class": F.lit(classify(f.dataType)), "total_rows": F.count(F.lit(1)), "non_null_rows": F.count(c),
            "null_rows": F.count_if(c.isNull()), "null_percent": F.when(F.count(F.lit(1)) == 0, 0.0).otherwise(100.0 * F.count_if(c.isNull()) / F.count(F.lit(1))),
        }
        if not exact:
            measures[f.name]["distinct_values"] = F.approx_count_distinct(c.cast("string"))
    out = long_form(df, measures)
    if exact:
        out = out.join(distinct_counts(df, df.columns), "column_name", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
    return out.join(sample_values(df, samples), "column_name", "left") if samples else out


def sample_values(df: DataFrame, k: int = 5) -> DataFrame:
    """(column_name, sample_values): the ``k`` smallest distinct values of each column as text.

    Each of the partitions of distinct pairs keeps its ``k`` smallest before they meet.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in df.columns))
    pairs = df.select(F.explode(cells).alias("c")).select("c.*").where("v is not null").distinct().withColumn("_slot", F.pmod(F.xxhash64("v"), F.lit(1024)))
    small = Window.partitionBy("column_name", "_slot").orderBy("v")
    few = pairs.withColumn("_i", F.row_number().over(small)).where(F.col("_i") <= k)
    return few.groupBy("column_name").agg(F.array_join(F.slice(F.sort_array(F.collect_list("v")), 1, k), " | ").alias("sample_values"))


def profile_numeric(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Per numeric column: counts, min, max, sum, mean, standard deviation, median."""
    measures = {}
    for n in columns or columns_of(df, NUMERICAL):
        c = F.col(f"`{n}`").cast("double")
        measures[n] = {"non_null_rows": F.count(c), "null_rows": F.count_if(c.isNull()), "min": F.min(c), "max": F.max(c), "sum": F.sum(c), "mean": F.avg(c), "stddev": F.stddev_samp(c)}
        if not exact:
            measures[n]["median"] = F.percentile_approx(c, 0.5, 10_000)
    out = long_form(df, measures)
    return with_percentiles(out, exact_percentiles(cells_of(df, list(measures)), ["column_name"], "v", [0.5]), ["column_name"], ["median"]) if exact else out


def profile_categorical(df: DataFrame, columns: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Rows and share of every category of every categorical column."""
    columns = columns or columns_of(df, CATEGORICAL)
    counts = category_counts(df, columns, most)
    total = df.agg(F.count("*").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select("column_name", "category_value", "n_rows", (100.0 * F.col("n_rows") / F.col("_total")).alias("percent"))  # one row


def profile_datetime(df: DataFrame, columns: list[str] | None = None, zone: str = "UTC") -> DataFrame:
    """Per date or timestamp column: counts, min and max (zone-normalised), and their distance in days."""
    kinds = {f.name: f.dataType for f in df.schema}
    measures = {}
    for n in columns or columns_of(df, DATE, TIMESTAMP_NTZ, TIMESTAMP_TZ):
        c = zone_normalised(F.col(f"`{n}`"), kinds[n], zone).cast("timestamp")
        measures[n] = {"non_null_rows": F.count(c), "null_rows": F.count_if(c.isNull()), "min": F.min(c), "max": F.max(c), "days": F.datediff(F.max(c), F.min(c))}
    return long_form(df, measures)


def describe_percentiles(df: DataFrame, columns: list[str], points: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact (linear) percentiles of numeric columns."""
    measures = {}
    for n in columns:
        c = F.col(f"`{n}`").cast("double")
        measures[n] = {"count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)}
    found = exact_percentiles(cells_of(df, columns), ["column_name"], "v", list(points))
    return with_percentiles(long_form(df, measures), found, ["column_name"], [f"p{round(100 * p)}" for p in points])


def present_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and value as text, nulls left out."""
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("category_value")) for c in columns))
    return df.select(F.explode(cells).alias("c")).select("c.*").where("category_value is not null").groupBy("column_name", "category_value").agg(F.count("*").alias("n_rows"))


def top_values(df: DataFrame, columns: list[str], k: int = 5, nulls: bool = True, separator: str = ", ") -> DataFrame:
    """Per column the ``k`` most frequent values as ``value:count`` text, ties by value; null is a value, or left out."""
    w = Window.partitionBy("column_name").orderBy(F.desc("n_rows"), "category_value")
    counts = category_counts(df, columns) if nulls else present_counts(df, columns)
    best = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    entry = F.struct("rank", F.concat_ws(":", "category_value", "n_rows").alias("v"))
    return best.groupBy("column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["v"]), separator).alias("top_values"))


def top_categories(df: DataFrame, column: str, k: int = 10, other: str = "OTHER", unknown: str = "UNKNOWN") -> DataFrame:
    """``df`` with ``<column>_top``: the value if it is among the ``k`` most frequent, else ``other``; null is ``unknown``.

    Frequencies are ranked with a limit, so only ``k`` values are broadcast.
    """
    text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(unknown))
    best = df.groupBy(text.alias("_v")).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_v").limit(k)
    return df.join(F.broadcast(best.select("_v")), text == F.col("_v"), "left").withColumn(f"{column}_top", F.coalesce("_v", F.lit(other))).drop("_v")


def full_profile(df: DataFrame) -> DataFrame:
    """Nulls and approximate distinct counts of all columns in one pass."""
    return profile_columns(df, exact=False)
