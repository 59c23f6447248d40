"""Keyed reconciliation of two frames: row status, cell differences, per-column statistics, buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import bucket, canonical, json_hash, portable_hash
from ..functions.equality import absolute_difference, equal, percent, relative_difference, seconds
from ..rules import CHANGED, MATCH, SOURCE_NULL, SOURCE_ONLY, TARGET_NULL, TARGET_ONLY, VALUE_MISMATCH, ReconRule, TablePair, common_columns, resolve
from ..tables import Watch, settled
from .ranks import exact_percentiles, with_percentiles
from .skew import full_outer


def canonical_sides(pair: TablePair, rule: ReconRule, same_type: bool = False, scale: int = 18) -> tuple[DataFrame, DataFrame]:
    """Source (sk_0.., s_<col>, s_hash) and target (tk_0.., t_<col>, t_hash): canonical key texts, shared values, hash of their texts."""
    pair = pair.filtered(rule)
    shared = common_columns(pair, rule, same_type)
    n_keys = len(rule.keys)

    def side(df: DataFrame, at: int, tag: str) -> DataFrame:
        kinds = {f.name: f.dataType for f in df.schema}
        texts = [(c[0].lower(), canonical(df[f"`{c[at]}`"], kinds[c[at]], rule, scale)) for c in shared]
        keys = [t.alias(f"{tag}k_{i}") for i, (_, t) in enumerate(texts[:n_keys])]
        values = [df[f"`{c[at]}`"].alias(f"{tag}_{c[0].lower()}") for c in shared]
        return df.select(*keys, *values, json_hash(texts).alias(f"{tag}_hash"))

    return side(pair.source, 0, "s"), side(pair.target, 1, "t")


def join_rows(pair: TablePair, rule: ReconRule, same_type: bool = False, scale: int = 18, hot_rows: int | None = None) -> DataFrame:
    """Both sides joined on canonical keys, null keys equal: k_0.., s_<col>, t_<col>, s_hash, t_hash, row_status.

    The join is a null-safe full outer equi-join, so duplicate keys multiply;
    run ``key_quality`` first. A row is CHANGED if the hash of its shared
    columns differs, whether or not a tolerance would forgive it. Keys with more than
    ``hot_rows`` rows, null ones too, are dealt over tasks (``skew.full_outer``).
    """
    return join_sides(*canonical_sides(pair, rule, same_type, scale), len(rule.keys), hot_rows)


def join_sides(s: DataFrame, t: DataFrame, n_keys: int, hot_rows: int | None = None) -> DataFrame:
    """The sides of ``canonical_sides`` joined, with the status of each row."""
    status = (
        F.when(F.col("t_hash").isNull(), SOURCE_ONLY).when(F.col("s_hash").isNull(), TARGET_ONLY)
        .when(F.col("s_hash") == F.col("t_hash"), MATCH).otherwise(CHANGED)
    )
    joined = full_outer(s, t, [f"sk_{i}" for i in range(n_keys)], [f"tk_{i}" for i in range(n_keys)], hot_rows)
    return joined.withColumn("row_status", status)


def status_counts(pair: TablePair, rule: ReconRule, same_type: bool = False, scale: int = 18) -> DataFrame:
    """(k_0.., row_status, n_rows): how many rows ``join_rows`` has of each key and status, told without joining.

    Rows that agree in key and hash are counted for each side, then added up by
    key: of a key that both sides have, each pair of rows with one hash is a
    match and each other pair a change. So a key, null or not, of any number of
    rows on both sides costs as much as its rows, not its pairs.
    """
    s, t = canonical_sides(pair, rule, same_type, scale)
    keys = [f"k_{i}" for i in range(len(rule.keys))]
    tagged = lambda df, tag: df.select(*(F.col(f"{tag}{k}").alias(k) for k in keys), F.unhex(f"{tag}_hash").alias("_hash"), F.lit(int(tag == "s")).alias("_s"))
    alike = tagged(s, "s").unionByName(tagged(t, "t")).groupBy(*keys, "_hash").agg(F.sum("_s").alias("_s"), F.sum(1 - F.col("_s")).alias("_t"))
    of_key = alike.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"), F.sum(F.col("_s") * F.col("_t")).alias("_m"))
    count = lambda status, n: F.struct(F.lit(status).alias("row_status"), n.alias("n_rows"))
    own, other, same = F.col("_s"), F.col("_t"), F.col("_m")
    counts = F.when(other == 0, F.array(count(SOURCE_ONLY, own))).when(own == 0, F.array(count(TARGET_ONLY, other))).otherwise(F.array(count(MATCH, same), count(CHANGED, own * other - same)))
    return of_key.select(*keys, F.inline(counts)).where(F.col("n_rows") > 0)


def key_json(pair: TablePair, rule: ReconRule) -> Column:
    """The key of a joined row as JSON text, from whichever side has it, nulls kept."""
    names = [k.lower() for k in resolve(pair.source.columns, rule.keys)]
    return F.to_json(F.struct(*(F.coalesce(f"sk_{i}", f"tk_{i}").alias(n) for i, n in enumerate(names))), {"ignoreNullFields": "false"})


def value_fields(pair: TablePair, rule: ReconRule, same_type: bool = False) -> list[T.StructField]:
    """Shared columns that are not keys, named in lower case."""
    kinds = {f.name: f for f in pair.source.schema}
    return [T.StructField(c[0].lower(), kinds[c[0]].dataType) for c in common_columns(pair, rule, same_type)[len(rule.keys) :]]


def tolerantly_equal(pair: TablePair, rule: ReconRule) -> Column:
    """Whether all shared columns of a joined row are equal within the tolerances."""
    cells = [equal(F.col(f"s_{f.name}"), F.col(f"t_{f.name}"), f.dataType, rule) for f in value_fields(pair, rule)]
    return reduce(lambda a, b: a & b, cells, F.lit(True))


def row_status_summary(joined: DataFrame) -> DataFrame:
    """Rows by status."""
    return joined.groupBy("row_status").agg(F.count("*").alias("n_rows"))


def row_status_detail(joined: DataFrame, pair: TablePair, rule: ReconRule, only_different: bool = True) -> DataFrame:
    rows = joined.where(F.col("row_status") != MATCH) if only_different else joined
    return rows.select(key_json(pair, rule).alias("key_json"), "row_status")


def table_summary(joined: DataFrame, pair: TablePair, rule: ReconRule) -> DataFrame:
    """One row: counts by status, match percent, and the verdict.

    ``status`` follows the hashes; ``tolerant_match_rows`` counts the changed
    rows whose cells are all equal within the tolerances.
    """
    count = lambda s: F.count_if(F.col("row_status") == s)
    rows = joined.agg(
        (F.count("*") - count(TARGET_ONLY)).alias("source_rows"), (F.count("*") - count(SOURCE_ONLY)).alias("target_rows"),
        count(MATCH).alias("match_rows"), count(CHANGED).alias("changed_rows"), count(SOURCE_ONLY).alias("source_only_rows"), count(TARGET_ONLY).alias("target_only_rows"),
        F.count_if((F.col("row_status") == CHANGED) & tolerantly_equal(pair, rule)).alias("tolerant_match_rows"),
    )
    whole = F.greatest("source_rows", "target_rows", F.lit(1))
    bad = F.col("changed_rows") + F.col("source_only_rows") + F.col("target_only_rows")
    return rows.withColumns({"match_percent": percent(F.col("match_rows"), whole), "status": F.when(bad > 0, "FAIL").otherwise("PASS")})


def cell_rows(joined: DataFrame, pair: TablePair, rule: ReconRule) -> DataFrame:
    """One row per shared column of every changed row: key, column, both texts, difference, equality.

    A single unpivot of the joined rows; samples, statistics and summaries all
    start from it.
    """
    cells = []
    for f in value_fields(pair, rule):
        s, t = F.col(f"s_{f.name}"), F.col(f"t_{f.name}")
        if isinstance(f.dataType, T.NumericType):
            a, b = s.cast("double"), t.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            a, b = seconds(s), seconds(t)
        else:
            a = b = F.lit(None).cast("double")
        cells.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            canonical(s, f.dataType, rule).alias("source_text"), canonical(t, f.dataType, rule).alias("target_text"),
            s.isNull().alias("source_is_null"), t.isNull().alias("target_is_null"), (b - a).alias("signed_difference"),
            absolute_difference(a, b).alias("abs_difference"), relative_difference(a, b).alias("rel_difference"),
            equal(s, t, f.dataType, rule).alias("is_equal"),
        ))
    changed = joined.where(F.col("row_status") == CHANGED).select(key_json(pair, rule).alias("key_json"), "s_hash", "t_hash", F.explode(F.array(*cells)).alias("c"))
    return changed.select("key_json", "s_hash", "t_hash", "c.*")


def mismatch_type() -> Column:
    return F.when(F.col("source_is_null"), SOURCE_NULL).when(F.col("target_is_null"), TARGET_NULL).otherwise(VALUE_MISMATCH)


def changed_cells(cells: DataFrame, limit: int | None = None, per_column: int | None = None) -> DataFrame:
    """The cells that differ, with the kind of mismatch; limits follow key and column, so they repeat."""
    bad = cells.where(~F.col("is_equal")).withColumn("mismatch_type", mismatch_type())
    if per_column:
        w = Window.partitionBy("column_name").orderBy("key_json")
        bad = bad.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_column).drop("_n")
    return bad.orderBy("key_json", "column_name").limit(limit) if limit else bad


def mismatch_report(joined: DataFrame, pair: TablePair, rule: ReconRule) -> tuple[DataFrame, DataFrame]:
    """(cells, ``column_mismatch_stats``) of joined rows that are gone through once: rows on both sides are counted while the changed cells are written."""
    watch = Watch(joined, n=F.count_if(F.col("row_status").isin(MATCH, CHANGED)))
    cells = settled(cell_rows(watch.rows, pair, rule))
    return cells, column_mismatch_stats(cells, joined.sparkSession.range(1).select(F.lit(watch.values()["n"]).alias("n")))


def column_mismatch_stats(cells: DataFrame, joined_rows: DataFrame) -> DataFrame:
    """Per column over the changed rows: mismatches, nulls, distinct values, and the spread of differences.

    ``joined_rows`` is one row with ``n`` = rows present on both sides. ``cells``
    are read three times: settle them first (``mismatch_report``).
    """
    bad = ~F.col("is_equal")
    when = lambda c: F.when(bad, F.col(c))
    wrong = cells.where(bad)
    found = exact_percentiles(wrong, ["column_name"], "abs_difference", [0.5, 0.95])
    # Distinct texts of both sides in one shuffle of distinct (column, side, text).
    sides = F.array(F.struct(F.lit(1).alias("s"), F.col("source_text").alias("v")), F.struct(F.lit(0).alias("s"), F.col("target_text").alias("v")))
    texts = wrong.select("column_name", F.explode(sides).alias("x")).select("column_name", "x.s", "x.v").where("v is not null").distinct()
    distinct = texts.groupBy("column_name").agg(F.sum("s").alias("source_distinct"), F.sum(1 - F.col("s")).alias("target_distinct"))
    stats = cells.groupBy("column_name", "data_type").agg(
        F.count("*").alias("candidate_rows"), F.count_if(bad).alias("mismatch_rows"),
        F.count_if("source_is_null").alias("source_nulls"), F.count_if("target_is_null").alias("target_nulls"),
        F.count_if(F.col("source_is_null") & ~F.col("target_is_null")).alias("source_null_target_value"),
        F.count_if(~F.col("source_is_null") & F.col("target_is_null")).alias("source_value_target_null"),
        F.avg(when("signed_difference")).alias("mean_signed_difference"), F.avg(when("abs_difference")).alias("mean_abs_difference"),
        F.max(when("abs_difference")).alias("max_abs_difference"),
    )
    stats = with_percentiles(stats, found, ["column_name"], ["median_abs_difference", "p95_abs_difference"])
    none = {c: F.coalesce(c, F.lit(0)) for c in ("source_distinct", "target_distinct")}
    stats = stats.join(distinct, "column_name", "left").withColumns(none)
    return stats.crossJoin(F.broadcast(joined_rows)).withColumn("mismatch_percent", percent(F.col("mismatch_rows"), F.col("n"))).drop("n")


def key_quality(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """One row: rows, rows with a null in the key, distinct keys, duplicated keys, surplus rows."""
    names = resolve(df.columns, keys)
    a_null = reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in names))
    per_key = df.groupBy(*(F.col(f"`{k}`") for k in names)).agg(F.count("*").alias("n"), F.max(a_null).alias("a_null"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_key.agg(
        total(F.col("n")).alias("total_rows"), total(F.when(F.col("a_null"), F.col("n"))).alias("null_key_rows"), F.count("*").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_key_groups"), total(F.when(F.col("n") > 1, F.col("n") - 1)).alias("duplicate_surplus_rows"),
    )


def full_reports(pair: TablePair, rule: ReconRule, detail_limit: int = 100_000) -> dict[str, DataFrame]:
    """All row reports of one table: counts, source_keys, target_keys, buckets, summary, rows, columns, cells.

    Each side is scanned once: its canonical rows are written, and counted with
    their null keys on the way (``DataFrame.observe``). The join, whose rows
    are written once too while those on both sides are counted, the key groups and the bucket
    sums all read those tables. Keys are compared as canonical texts, as the join does.
    """
    n_keys = len(rule.keys)
    names = [c[0].lower() for c in common_columns(pair.filtered(rule), rule)][n_keys:]
    sides, seen = [], []
    for df, tag in zip(canonical_sides(pair, rule), "st", strict=True):
        a_null = reduce(lambda a, b: a | b, (F.col(f"{tag}k_{i}").isNull() for i in range(n_keys)))
        watch = Watch(df, n=F.count(F.lit(1)), null_keys=F.count_if(a_null))
        sides.append(settled(watch.rows))
        seen.append(watch.values())
    watch = Watch(join_sides(*sides, n_keys), both=F.count_if(F.col("row_status").isin(MATCH, CHANGED)))
    joined = settled(watch.rows)
    cells = settled(cell_rows(joined, pair, rule))
    one = joined.sparkSession.range(1)
    counts = [F.lit(x["n"]).cast("long") for x in seen]
    diff = counts[1] - counts[0]

    def keys_of(i: int) -> DataFrame:
        per_key = sides[i].groupBy(*(f"{'st'[i]}k_{k}" for k in range(n_keys))).agg(F.count("*").alias("n"))
        found = per_key.agg(F.count("*").alias("distinct_keys"), F.count_if(F.col("n") > 1).alias("duplicate_key_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("duplicate_surplus_rows"))
        return found.select(counts[i].alias("total_rows"), F.lit(seen[i]["null_keys"]).cast("long").alias("null_key_rows"), *found.columns)

    return {
        "counts": one.select(F.lit(pair.name).alias("table_name"), counts[0].alias("source_count"), counts[1].alias("target_count"), diff.alias("difference"), F.when(diff == 0, "MATCH").otherwise("MISMATCH").alias("status")),
        "source_keys": keys_of(0), "target_keys": keys_of(1), "buckets": bucket_sums(*sides, names, rule), "summary": table_summary(joined, pair, rule), "rows": row_status_detail(joined, pair, rule),
        "columns": column_mismatch_stats(cells, one.select(F.lit(watch.values()["both"]).alias("n"))), "cells": changed_cells(cells, detail_limit),
    }


def null_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in resolve(df.columns, keys))))


def hashed_side(side: DataFrame, tag: str, names: list[str], n_keys: int, buckets: int, rule: ReconRule, scale: int = 18) -> DataFrame:
    """(bucket_id, h) of a side of ``canonical_sides``: the bucket of its key texts and the hash of all its texts, both portable."""
    keys = [F.col(f"{tag}k_{i}") for i in range(n_keys)]
    kinds = {f.name: f.dataType for f in side.schema}
    texts = [canonical(F.col(f"`{tag}_{n}`"), kinds[f"{tag}_{n}"], rule, scale) for n in names]
    return side.select(bucket(keys, buckets).alias("bucket_id"), portable_hash([*keys, *texts]).alias("h"))


def bucket_summary(pair: TablePair, rule: ReconRule) -> DataFrame:
    """Per bucket of the key space: counts and checksums of both sides, and whether they agree.

    Both sides are tagged and summed in one shuffle; checksums are decimal sums of
    portable hashes, which cannot overflow, so they can be compared with sums that another system made.
    """
    return bucket_sums(*canonical_sides(pair, rule), [c[0].lower() for c in common_columns(pair.filtered(rule), rule)][len(rule.keys) :], rule)


def bucket_sums(s: DataFrame, t: DataFrame, names: list[str], rule: ReconRule) -> DataFrame:
    """``bucket_summary`` of the sides of ``canonical_sides``, whose other columns are ``names``."""
    side = lambda df, tag, src: hashed_side(df, tag, names, len(rule.keys), rule.hash_buckets, rule).withColumn("src", F.lit(src))
    rows = side(s, "s", True).unionByName(side(t, "t", False))
    measures = []
    for tag, own in (("source", F.col("src")), ("target", ~F.col("src"))):
        h = F.when(own, F.col("h"))
        measures += [
            F.count(h).alias(f"{tag}_rows"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).alias(f"{tag}_hash_sum"),
            F.min(h).alias(f"{tag}_hash_min"), F.max(h).alias(f"{tag}_hash_max"), F.approx_count_distinct(h).alias(f"{tag}_distinct"),
        ]
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("source_hash_sum") == F.col("target_hash_sum")) & F.col("source_hash_min").eqNullSafe(F.col("target_hash_min")) & F.col("source_hash_max").eqNullSafe(F.col("target_hash_max"))
    return rows.groupBy("bucket_id").agg(*measures).withColumn("bucket_match", same)


def checksum_tree(buckets: DataFrame, roots: int) -> DataFrame:
    """Sums of ``bucket_summary`` at three levels: all (level 0), ``roots`` groups of buckets (1), buckets (2); and whether both sides agree there.

    A reader goes down from the top and stops where sums agree; the rows are summed once, upper levels from the sums below.
    """
    sums = ["source_rows", "target_rows", "source_hash_sum", "target_hash_sum"]
    tagged = buckets.select(F.pmod("bucket_id", F.lit(roots)).alias("root_id"), "bucket_id", *sums)
    tree = tagged.rollup("root_id", "bucket_id").agg(F.grouping("root_id").alias("_g0"), F.grouping("bucket_id").alias("_g1"), *(F.sum(c).cast("decimal(38,0)").alias(c) for c in sums))
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("source_hash_sum") == F.col("target_hash_sum"))
    return tree.select((2 - F.col("_g0") - F.col("_g1")).cast("int").alias("level"), "root_id", "bucket_id", *(F.col(c).cast("long").alias(c) if c.endswith("rows") else c for c in sums), same.alias("node_match"))


def differing_rows(pair: TablePair, rule: ReconRule, roots: int = 64, hot_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(joined rows that are no match, ``checksum_tree``): only rows of buckets whose sums differ are joined.

    Buckets are summed from hashes alone; the differing ones, at most
    ``rule.hash_buckets``, go to both sides' scans, and full rows of no other bucket are moved.
    """
    s, t = canonical_sides(pair, rule)
    names = [c[0].lower() for c in common_columns(pair.filtered(rule), rule)][len(rule.keys) :]
    sums = settled(bucket_sums(s, t, names, rule))
    tree = checksum_tree(sums, roots)
    differing = sums.where(~F.col("bucket_match")).select("bucket_id")
    keys = lambda tag: [F.col(f"{tag}k_{i}") for i in range(len(rule.keys))]
    kept = lambda df, tag: df.withColumn("bucket_id", bucket(keys(tag), rule.hash_buckets)).join(F.broadcast(differing), "bucket_id", "left_semi").drop("bucket_id")
    joined = join_sides(kept(s, "s"), kept(t, "t"), len(rule.keys), hot_rows)
    return joined.where(F.col("row_status") != MATCH), tree
