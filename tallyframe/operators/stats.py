"""Statistics of two frames side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import category_text, zone_normalised
from ..functions.classify import CATEGORICAL, DATE, NUMERICAL, TIMESTAMP_NTZ, TIMESTAMP_TZ, classify
from ..functions.equality import difference_seconds
from ..rules import ReconRule, TablePair
from .ranks import cells_of, exact_percentiles, with_percentiles

STATS = ("min", "max", "sum", "median")


def columns_of(df: DataFrame, *classes: str) -> list[str]:
    return [f.name for f in df.schema if classify(f.dataType) in classes]


def unioned(frames: list[DataFrame]) -> DataFrame:
    """All frames by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def count_compare(pair: TablePair) -> DataFrame:
    """One row: rows of both sides, target minus source, status."""
    n = lambda df, c: df.agg(F.count("*").alias(c))
    both = n(pair.source, "source_count").crossJoin(n(pair.target, "target_count"))  # one row each
    diff = F.col("target_count") - F.col("source_count")
    return both.select(F.lit(pair.name).alias("table_name"), "source_count", "target_count", diff.alias("difference"), F.when(diff == 0, "MATCH").otherwise("MISMATCH").alias("status"))


def category_counts(df: DataFrame, columns: list[str], most: int | None = None) -> DataFrame:
    """Rows per column and category text, all columns in one shuffle."""
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), category_text(F.col(f"`{c}`"), most).alias("category_value")) for c in columns))
    return df.select(F.explode(cells).alias("c")).groupBy("c.column_name", "c.category_value").agg(F.count("*").alias("n_rows"))


def category_counts_compare(pair: TablePair, columns: list[str]) -> DataFrame:
    """Counts of every category on both sides: both are tagged and counted in one shuffle, without a join."""
    def tagged(df: DataFrame, source: int) -> DataFrame:
        cells = F.array(*(F.struct(F.lit(c).alias("column_name"), category_text(F.col(f"`{c}`")).alias("category_value")) for c in columns))
        return df.select(F.explode(cells).alias("c"), F.lit(source).alias("s"))

    rows = tagged(pair.source, 1).unionByName(tagged(pair.target, 0))
    out = rows.groupBy("c.column_name", "c.category_value").agg(F.sum("s").alias("source_count"), F.sum(1 - F.col("s")).alias("target_count"))
    return out.withColumns({"difference": F.col("target_count") - F.col("source_count"), "status": F.when(F.col("source_count") == F.col("target_count"), "PASS").otherwise("FAIL")})


def category_summary(compared: DataFrame) -> DataFrame:
    """Per column: distinct categories (null counts as one), mismatched categories, PASS if both agree."""
    out = compared.groupBy("column_name").agg(
        F.count_if(F.col("source_count") > 0).alias("source_distinct"), F.count_if(F.col("target_count") > 0).alias("target_distinct"),
        F.count_if(F.col("status") == "FAIL").alias("mismatched_categories"),
    )
    good = (F.col("source_distinct") == F.col("target_distinct")) & (F.col("mismatched_categories") == 0)
    return out.withColumns({"distinct_difference": F.col("target_distinct") - F.col("source_distinct"), "status": F.when(good, "PASS").otherwise("FAIL")})


def moments(df: DataFrame, columns: list[str], kind: str, accuracy: int | None) -> DataFrame:
    """Long rows (column_name, stat, value) in one aggregation; the median is approximate, or null without an accuracy."""
    aggs = []
    for c in columns:
        v = F.col(f"`{c}`").cast(kind)
        middle = F.percentile_approx(v, 0.5, accuracy) if accuracy else F.lit(None).cast(kind)
        aggs.append(F.struct(F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).cast(kind).alias("sum"), middle.alias("median")).alias(c))
    row = df.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("stat"), F.col(f"`{c}`.`{s}`").alias("value")) for c in columns for s in STATS]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def numeric_stats(df: DataFrame, columns: list[str], exact: bool = True, accuracy: int = 10_000, decimal: bool = False) -> DataFrame:
    """Long rows (column_name, stat, value) of all columns.

    Values are doubles, or ``decimal(38,18)`` with ``decimal``, which keeps all
    digits and takes the approximate median; else the median is exact unless
    told otherwise (``exact_percentiles``).
    """
    if decimal or not exact:
        return moments(df, columns, "decimal(38,18)" if decimal else "double", accuracy)
    found = exact_percentiles(cells_of(df, columns), ["column_name"], "v", [0.5])
    both = with_percentiles(moments(df, columns, "double", None), found, ["column_name"], ["_median"])
    return both.select("column_name", "stat", F.when(F.col("stat") == "median", F.col("_median")).otherwise(F.col("value")).alias("value"))


def numeric_stats_compare(pair: TablePair, columns: list[str], rule: ReconRule, exact: bool = True, decimal: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Each statistic on both sides: differences, and PASS within max(abs, rel * max(|s|, |t|, 1)); two nulls pass.

    Exact medians of both sides come from one ranking of values tagged with their side.
    """
    ranked = exact and not decimal
    kind = "decimal(38,18)" if decimal else "double"
    sides = {"source": pair.source, "target": pair.target}
    both = None
    for name, df in sides.items():
        one = moments(df, columns, kind, None if ranked else accuracy).withColumnRenamed("value", f"{name}_value")
        both = one if both is None else both.join(one, ["column_name", "stat"], "full_outer")
    if ranked:
        tagged = unioned([cells_of(df, columns).withColumn("side", F.lit(name)) for name, df in sides.items()])
        found = exact_percentiles(tagged, ["side", "column_name"], "v", [0.5])
        middle = found.groupBy("column_name").agg(*(F.max(F.when(F.col("side") == n, F.get("q", F.lit(0)))).alias(f"_{n}") for n in sides))
        both = both.join(middle, "column_name", "left").withColumns({f"{n}_value": F.when(F.col("stat") == "median", F.col(f"_{n}")).otherwise(F.col(f"{n}_value")) for n in sides}).drop(*(f"_{n}" for n in sides))
    a, b = F.col("source_value"), F.col("target_value")
    limit = F.greatest(F.lit(float(rule.numeric_abs)), F.lit(float(rule.numeric_rel)) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0)))
    good = F.coalesce(F.abs(b - a) <= limit, a.isNull() & b.isNull())
    return both.withColumns({
        "abs_difference": F.abs(b - a), "rel_difference": F.try_divide(F.abs(b - a), F.greatest(F.abs(a), F.lit(1.0))), "status": F.when(good, "PASS").otherwise("FAIL"),
    })


def datetime_stats(df: DataFrame, columns: list[str], zone: str = "UTC", comparison: str = "UTC") -> DataFrame:
    """Long rows (column_name, stat, value timestamp) of min and max after zone normalisation."""
    kinds = {f.name: f.dataType for f in df.schema}
    row = df.agg(*(f(zone_normalised(F.col(f"`{c}`"), kinds[c], zone, comparison).cast("timestamp")).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("min", F.min), ("max", F.max))))
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("stat"), F.col(f"{n}_{i}").alias("value")) for i, c in enumerate(columns) for n in ("min", "max")]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def datetime_stats_compare(pair: TablePair, columns: list[str], rule: ReconRule, target_zone: str | None = None) -> DataFrame:
    s = datetime_stats(pair.source, columns, rule.zone).withColumnRenamed("value", "source_value")
    t = datetime_stats(pair.target, columns, target_zone or rule.zone).withColumnRenamed("value", "target_value")
    diff = difference_seconds(F.col("source_value"), F.col("target_value"), T.TimestampType())
    good = F.coalesce(F.abs(diff) <= rule.timestamp_seconds, F.col("source_value").isNull() & F.col("target_value").isNull())
    return s.join(t, ["column_name", "stat"], "full_outer").withColumns({"difference_seconds": diff, "status": F.when(good, "PASS").otherwise("FAIL")})


def overall_verdict(reports: dict[str, DataFrame]) -> DataFrame:
    """Failures per report, and PASS or FAIL over all of them."""
    bad = F.count_if(~F.col("status").isin("PASS", "MATCH"))
    rows = unioned([df.agg(F.lit(name).alias("report"), F.count("*").alias("checks"), bad.alias("failures")) for name, df in reports.items()])
    total = rows.agg(F.lit("overall").alias("report"), F.sum("checks").alias("checks"), F.sum("failures").alias("failures"))
    return rows.unionByName(total).withColumn("status", F.when(F.col("failures") > 0, "FAIL").otherwise("PASS"))


def compare_statistics(pair: TablePair, rule: ReconRule) -> dict[str, DataFrame]:
    """All statistical reports of the columns that both sides have with the same type, and the verdict."""
    pair = pair.filtered(rule)
    target = {f.name.lower(): f.dataType for f in pair.target.schema}
    shared = [f.name for f in pair.source.schema if target.get(f.name.lower()) == f.dataType and f.name.lower() not in {x.lower() for x in rule.exclude}]
    pair = TablePair(pair.source.select(*shared), pair.target.select(*shared), pair.name)
    pick = lambda *k: columns_of(pair.source, *k)
    reports = {"counts": count_compare(pair)}
    if pick(CATEGORICAL):
        reports["categories"] = category_summary(category_counts_compare(pair, pick(CATEGORICAL)))
    if pick(NUMERICAL):
        reports["numeric"] = numeric_stats_compare(pair, pick(NUMERICAL), rule)
    if pick(DATE, TIMESTAMP_NTZ, TIMESTAMP_TZ):
        reports["datetime"] = datetime_stats_compare(pair, pick(DATE, TIMESTAMP_NTZ, TIMESTAMP_TZ), rule)
    return {**reports, "overall": overall_verdict(reports)}
