"""Sampled reconciliation: latest rows of the source, probed in the target by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import normalised, pair_hash
from ..functions.equality import semantic_class
from ..rules import EXACT_MATCH, FALSE_MISMATCH, HASH_MISMATCH, MATCH, MISSING_IN_SOURCE, MISSING_IN_TARGET, TRUE_MISMATCH, TablePair, resolve


def latest_n(df: DataFrame, date_col: str, keys: list[str], n: int) -> DataFrame:
    """The ``n`` latest rows: date descending, then keys ascending, nulls last."""
    order = [F.col(f"`{date_col}`").desc_nulls_last(), *(F.col(f"`{k}`").asc_nulls_last() for k in resolve(df.columns, keys))]
    return df.orderBy(*order).limit(n)


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``; 0 keeps all."""
    return df.orderBy(*resolve(df.columns, order)).limit(n) if n else df


def typed_keys(sample: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The sample's distinct keys, cast to the target's types (null where that fails)."""
    kinds = {f.name.lower(): f.dataType for f in target.schema}
    return sample.select(*(F.col(f"`{k}`").try_cast(kinds[k.lower()]).alias(k) for k in resolve(sample.columns, keys))).distinct()


def probe(target: DataFrame, key_rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target rows that have one of the keys, null equal to null.

    How the keys reach the target is left to Spark, which knows their size: a small sample is broadcast.
    """
    names = resolve(target.columns, keys)
    wanted = key_rows.toDF(*(f"_p{i}" for i in range(len(keys))))
    on = reduce(lambda a, b: a & b, (target[f"`{k}`"].eqNullSafe(wanted[f"_p{i}"]) for i, k in enumerate(names)))
    return target.join(wanted, on, "left_semi")


def shared_columns(pair: TablePair, ignore: list[str] = ()) -> list[str]:
    """Source columns that the target has too (ignoring case), without the ignored ones."""
    target, skip = {c.lower() for c in pair.target.columns}, {x.lower() for x in ignore}
    return [c for c in pair.source.columns if c.lower() in target and c.lower() not in skip]


def sample_reconciliation(pair: TablePair, keys: list[str], date_col: str, n: int = 1000, ignore: list[str] = ()) -> DataFrame:
    """One row per sampled key: both row hashes over the shared columns, both rows, and a status.

    Both sides use one normaliser. A key that repeats within the sample pairs
    with every target row of that key.
    """
    columns = shared_columns(pair, ignore)
    lower = [k.lower() for k in keys]
    sample = latest_n(pair.source, date_col, keys, n)
    found = probe(pair.target, typed_keys(sample, pair.target, keys), keys)

    def side(df: DataFrame, tag: str) -> DataFrame:
        df = df.select(*(F.col(f"`{a}`").alias(b) for a, b in zip(resolve(df.columns, [*columns, *ignored(df)]), [*columns, *ignored(df)], strict=True)))
        kinds = {f.name: f.dataType for f in df.schema}
        texts = F.struct(*(normalised(F.col(f"`{c}`"), kinds[c]).alias(c.lower()) for c in [*columns, *ignored(df)]))
        return df.select(*(F.col(f"`{k}`").alias(f"{tag}k_{k.lower()}") for k in resolve(columns, keys)), texts.alias(f"{tag}_row"), pair_hash(df, columns).alias(f"{tag}_hash"))

    def ignored(df: DataFrame) -> list[str]:
        have = {c.lower(): c for c in df.columns}
        return [have[x.lower()] for x in ignore if x.lower() in have]

    s, t = side(sample, "s"), side(found, "t")
    on = reduce(lambda a, b: a & b, (s[f"sk_{k}"].eqNullSafe(t[f"tk_{k}"].try_cast(s.schema[f"sk_{k}"].dataType)) for k in lower))
    status = (
        F.when(F.col("t_hash").isNull(), MISSING_IN_TARGET).when(F.col("s_hash").isNull(), MISSING_IN_SOURCE)
        .when(F.col("s_hash") == F.col("t_hash"), MATCH).otherwise(HASH_MISMATCH)
    )
    return s.join(t, on, "full_outer").select(
        *(F.coalesce(f"sk_{k}", f"tk_{k}").alias(k) for k in lower), "s_hash", "t_hash", "s_row", "t_row", status.alias("status")
    )


def hashed_sample(df: DataFrame, keys: list[str], date_col: str, n: int = 1000, ignore: list[str] = ()) -> DataFrame:
    """The latest ``n`` rows of one side alone: their keys, normalised row and row hash, as ``sample_reconciliation`` would hash them."""
    skip = {x.lower() for x in ignore}
    columns = [c for c in df.columns if c.lower() not in skip]
    kinds = {f.name: f.dataType for f in df.schema}
    rows = latest_n(df, date_col, keys, n)
    texts = F.struct(*(normalised(F.col(f"`{c}`"), kinds[c]).alias(c.lower()) for c in columns))
    return rows.select(*(F.col(f"`{k}`").alias(k.lower()) for k in resolve(df.columns, keys)), texts.alias("row"), pair_hash(rows, columns).alias("row_hash"))


def sample_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("status").agg(F.count("*").alias("n_rows"))


def column_mismatches(reconciled: DataFrame, pair: TablePair, keys: list[str], ignore: list[str] = ()) -> DataFrame:
    """One row per differing column of a HASH_MISMATCH row: texts, types, semantic class, reason.

    Ignored columns ride along as ``source_ignored_<name>`` and ``target_ignored_<name>``.
    """
    lower = [k.lower() for k in keys]
    s_kind = {f.name.lower(): f.dataType.simpleString() for f in pair.source.schema}
    t_kind = {f.name.lower(): f.dataType.simpleString() for f in pair.target.schema}
    cells = []
    for c in shared_columns(pair, [*ignore, *keys]):
        k = c.lower()
        s, t = F.col(f"s_row.`{k}`"), F.col(f"t_row.`{k}`")
        kind, why = semantic_class(s, t, s_kind[k], t_kind[k])
        cells.append(F.struct(
            F.lit(k).alias("column_name"), F.lit(s_kind[k]).alias("source_type"), F.lit(t_kind[k]).alias("target_type"),
            s.alias("source_value"), t.alias("target_value"), kind.alias("mismatch_class"), why.alias("reason"),
        ))
    context = []
    for tag, name, frame in (("s_row", "source", pair.source), ("t_row", "target", pair.target)):
        context += [F.col(f"{tag}.`{x.lower()}`").alias(f"{name}_ignored_{x.lower()}") for x in ignore if x.lower() in {c.lower() for c in frame.columns}]
    rows = reconciled.where(F.col("status") == HASH_MISMATCH).select(*lower, *context, F.explode(F.array(*cells)).alias("c"))
    return rows.select("*", "c.*").drop("c").where(F.col("mismatch_class") != EXACT_MATCH)


def column_mismatch_summary(mismatches: DataFrame) -> DataFrame:
    """True and false mismatches by column."""
    return mismatches.groupBy("column_name").agg(
        F.count_if(F.col("mismatch_class") == TRUE_MISMATCH).alias("true_mismatches"), F.count_if(F.col("mismatch_class") == FALSE_MISMATCH).alias("false_mismatches"), F.count("*").alias("total_mismatches")
    )


def row_mismatch_summary(mismatches: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; TRUE_MISMATCH if any of its columns truly differs."""
    truly = F.bool_or(F.col("mismatch_class") == TRUE_MISMATCH)
    return mismatches.groupBy(*(k.lower() for k in keys)).agg(
        F.count("*").alias("mismatched_columns"), F.when(truly, TRUE_MISMATCH).otherwise(FALSE_MISMATCH).alias("row_class"),
        F.array_join(F.array_sort(F.collect_set("column_name")), ",").alias("columns"),
    )


def extreme_timestamps(df: DataFrame, low: int = 1678, high: int = 2262) -> DataFrame:
    """Per date or timestamp column: values whose year is outside [low, high], over all rows, with the extremes as text."""
    columns = [f for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    cells = [F.struct(F.lit(f.name).alias("column_name"), F.year(f"`{f.name}`").alias("y"), F.col(f"`{f.name}`").cast("string").alias("v")) for f in columns]
    rows = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where((F.col("y") < low) | (F.col("y") > high))
    return rows.groupBy("column_name").agg(F.count("*").alias("extreme_rows"), F.min("v").alias("smallest"), F.max("v").alias("largest"))
