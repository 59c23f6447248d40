"""Whole analyses: reconciliation of one or many tables, checks by flag, profiles, CSV analysis, rule mining."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cube, duplicates, infer, mining, models, profile, reconcile, sample, schema_diff, stats
from ..functions.classify import CATEGORICAL, DATE, NUMERICAL, TIMESTAMP_NTZ, TIMESTAMP_TZ
from ..rules import ERROR, ReconRule, RunContext, TablePair
from ..sources.sinks import append_run, audit_table_name, ensure_schema, with_audit_columns


@dataclass
class Result:
    """Reports by name, all of them lazy frames, and errors by name."""

    reports: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def compare_table(pair: TablePair, rule: ReconRule, mode: str = "FULL", detail_limit: int = 100_000) -> Result:
    """All reports of one table. ``mode``: FULL, METADATA_ONLY or COUNTS_ONLY."""
    if mode not in ("FULL", "METADATA_ONLY", "COUNTS_ONLY"):
        raise ValueError(f"unknown mode {mode}")
    spark = pair.source.sparkSession
    meta = [schema_diff.schema_rows(spark, df.schema, pair.name) for df in (pair.source, pair.target)]
    out = Result({"schema": schema_diff.schema_diff(*meta)})
    if mode == "METADATA_ONLY":
        return out
    if mode == "COUNTS_ONLY":
        out.reports["counts"] = stats.count_compare(pair.filtered(rule))
        return out
    out.reports |= reconcile.full_reports(pair, rule, detail_limit)
    return out


def compare_tables(pairs: dict[str, Callable[[], tuple[TablePair, ReconRule]]], mode: str = "FULL") -> tuple[dict[str, Result], dict[str, str]]:
    """Results and statuses of many tables; a table that fails is recorded and the next one goes on."""
    results, status = {}, {}
    for name, make in pairs.items():
        try:
            results[name] = compare_table(*make(), mode)
            verdict = results[name].reports.get("summary")
            status[name] = verdict.first()["status"] if verdict is not None else mode
        except Exception as e:  # noqa: BLE001 - one table's failure is a result
            results[name], status[name] = Result(errors={name: f"{type(e).__name__}: {e}"}), ERROR
    return results, status


def run_reconciliation(spark: SparkSession, pairs: dict[str, Callable[[], tuple[TablePair, ReconRule]]], run: RunContext, schema: str, prefix: str = "recon", mode: str = "FULL") -> dict[str, str]:
    """``compare_tables`` whose reports, statuses and durations are appended to audit tables; gives the status of each table.

    A table that fails leaves its error in the run's table and the next one goes
    on. A run that is repeated with the same ``run`` takes the place of what it
    left before, be it whole or half done (``append_run``).
    """
    ensure_schema(spark, schema)
    marks = audit_table_name(schema, prefix, "commits")
    put = lambda df, report, of: append_run(df, audit_table_name(schema, prefix, report), run, report, of, marks)
    status = {}
    for name, make in pairs.items():
        began, error = datetime.now(timezone.utc).replace(tzinfo=None), None
        results, verdicts = compare_tables({name: make}, mode)
        result, status[name] = results[name], verdicts[name]
        error = result.errors.get(name)
        if error is None:
            try:
                for report, df in result.reports.items():
                    put(with_audit_columns(df, run, mode, report, (None, None, name)), report, name)
            except Exception as e:  # noqa: BLE001 - one table's failure is a result
                status[name], error = ERROR, f"{type(e).__name__}: {e}"
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        row = [(run.run_id, name, mode, status[name], error, began, ended, (ended - began).total_seconds())]
        put(spark.createDataFrame(row, "run_id string, table_name string, mode string, status string, error string, started_at timestamp, ended_at timestamp, duration_seconds double"), "runs", name)
    return status


CHECKS = ("COUNTS", "TYPE", "SAMPLE", "DUPLICATE", "TYPE_ALL")


def run_checks(pair: TablePair, check: str, keys: list[str], date_col: str, n: int = 1000, ignore: list[str] = (), all_tables: tuple[DataFrame, DataFrame] | None = None) -> Result:
    """The checks of a flag. ALL is counts, types and sample; duplicates and all-table types run only when asked for."""
    check = check.upper()
    if check != "ALL" and check not in CHECKS:
        raise ValueError(f"unknown check {check}; known: ALL, {', '.join(CHECKS)}")
    wanted = ("COUNTS", "TYPE", "SAMPLE") if check == "ALL" else (check,)
    spark, out = pair.source.sparkSession, Result()
    if "COUNTS" in wanted:
        out.reports["counts"] = stats.count_compare(pair)
    if "TYPE" in wanted:
        detail = schema_diff.type_check(*(schema_diff.schema_rows(spark, df.schema, pair.name) for df in (pair.source, pair.target)))
        out.reports |= {"types": detail, "types_summary": schema_diff.type_check_summary(detail, by_table=False)}
    if "SAMPLE" in wanted:
        found = sample.sample_reconciliation(pair, keys, date_col, n, ignore)
        cells = sample.column_mismatches(found, pair, keys, ignore)
        out.reports |= {
            "sample": found, "sample_summary": sample.sample_summary(found), "column_mismatches": cells,
            "column_mismatch_summary": sample.column_mismatch_summary(cells), "row_mismatch_summary": sample.row_mismatch_summary(cells, keys),
        }
    if "DUPLICATE" in wanted:
        found = duplicates.duplicate_reconciliation(pair, keys)
        out.reports |= {"duplicates": found, "duplicate_summary": duplicates.duplicate_summary(found)}
    if "TYPE_ALL" in wanted:
        if all_tables is None:
            raise ValueError("TYPE_ALL needs the metadata rows of both schemas")
        detail = schema_diff.type_check_all(*all_tables)
        out.reports |= {"types_all": detail, "types_by_table": schema_diff.type_check_summary(detail), "types_overall": schema_diff.type_check_summary(detail, by_table=False)}
    return out


def profile_table(df: DataFrame) -> Result:
    """Counts, columns, numbers, categories and dates of one table; kinds without columns give no report."""
    pick = lambda *k: stats.columns_of(df, *k)
    out = Result({"counts": df.agg(F.count("*").alias("n_rows")), "columns": profile.profile_columns(df)})
    if pick(NUMERICAL):
        out.reports["numeric"] = profile.profile_numeric(df)
    if pick(CATEGORICAL):
        out.reports["categorical"] = profile.profile_categorical(df, most=256)
    if pick(DATE, TIMESTAMP_NTZ, TIMESTAMP_TZ):
        out.reports["datetime"] = profile.profile_datetime(df)
    return out


def profile_tables(tables: dict[str, Callable[[], DataFrame]]) -> dict[str, Result]:
    """Profiles of many tables; a table that cannot be read is recorded and the next one goes on."""
    out = {}
    for name, make in tables.items():
        try:
            out[name] = profile_table(make())
        except Exception as e:  # noqa: BLE001 - one table's failure is a result
            out[name] = Result(errors={name: f"{type(e).__name__}: {e}"})
    return out


def analyse_csv(df: DataFrame, forced: dict[str, str] | None = None, depth: int = 3, budget: int = 10_000) -> Result:
    """Inferred types, profile, imputation, percentiles, and every measure over all combinations of dimensions."""
    df = infer.clean_names(df)
    types = infer.infer_types(df, forced)
    found = types.select("column_name", "inferred_type", "date_format").collect()  # one row per column
    kind, form = {r["column_name"]: r["inferred_type"] for r in found}, {r["column_name"]: r["date_format"] for r in found}
    measures = [c for c in df.columns if kind[c] == "numeric"]
    dims = [c for c in df.columns if kind[c] in ("categorical", "boolean")]
    typed = df.withColumns({c: F.regexp_replace(F.col(f"`{c}`").cast("string"), ",", "").try_cast("double") for c in measures})
    full = infer.impute(typed, measures, dims)
    out = Result({"types": types, "profile": profile.profile_columns(typed), "columns": infer.column_report(df, forced), "imputation": infer.imputation_log(typed, measures, dims)})
    if measures:
        out.reports["percentiles"] = profile.describe_percentiles(full, measures)
    if dims:
        out.reports["top_values"] = profile.top_values(full, dims)
        for m in measures:
            out.reports[f"measure_{m}"] = cube.measure_by_dims(full, dims, m, depth, budget=budget)
    dates = [c for c in df.columns if kind[c] == "date"]
    dated = full.withColumns({c: infer.dates_of(F.col(f"`{c}`"), form[c]) for c in dates if form[c] and dict(full.dtypes)[c] == "string"})
    for d in dates:
        for m in measures:
            out.reports[f"measure_{m}_by_{d}"] = cube.measure_by_dims_time(dated, dims, m, d, depth, budget=budget)
    return out


def mine(df: DataFrame, target: mining.Target, ids: list[str], exclude: list[str] = (), length: int = 3, bins: int = 5, top: int = 20, most_features: int = 20, least_records: int = 30, least_lift: float = 1.0, least_positives: int = 5, test_share: float = 0.25, most_validated: int = 500) -> Result:
    """Rules for a target: features binned and collapsed, ranked, mined on train rows, validated on the others."""
    df = mining.prepare_target(mining.clean_missing(df), target)
    out = Result({"base_rates": mining.class_base_rates(df)})
    skip = {*ids, *exclude, target.column, "target_flag", "target_class", "target_order"}
    numeric, categorical = mining.feature_types(df, skip)
    frame = mining.binned_frame(df, mining.quantile_edges(df, numeric, bins)) if numeric else df
    for c in categorical:
        frame = profile.top_categories(frame, c, top).drop(c).withColumnRenamed(f"{c}_top", c)
    features = [*numeric, *categorical]
    def strongest(single: DataFrame, strength: Column) -> list[str]:
        """Features by what they tell alone; the ``most_features`` best go on."""
        ranked = single.groupBy("features").agg(F.max(strength).alias("s")).orderBy(F.desc_nulls_last("s"), "features")
        return [r["features"] for r in ranked.limit(most_features).collect()]  # one row per feature

    if target.mode == "ordinal":
        best = strongest(mining.ordinal_severity(frame, features, 1, least_records), F.abs(F.col("severity_index") - 1))
        out.reports["severity"] = mining.ordinal_severity(frame, best, length, least_records)
        return out
    if target.mode == "multiclass":
        best = strongest(mining.multiclass_rules(frame, features, 1, least_records, 0.0), F.col("lift"))
        out.reports["rules"] = mining.multiclass_rules(frame, best, length, least_records, least_lift)
        return out
    lifts = mining.univariate_lift(frame, features)
    rank = mining.feature_rank(lifts, least_records)
    best = [r["feature"] for r in rank.orderBy(F.desc_nulls_last("max_lift"), "feature").limit(most_features).collect()]  # one row per feature
    train, test = mining.stratified_split(frame, "target_flag", ids, test_share)
    records, positives = mining.scaled_thresholds(least_records, least_positives, test_share)
    rules = mining.combination_rules(train, best, length=length, least_records=records, least_lift=least_lift, least_positives=positives)
    out.reports |= {"lift": lifts, "features": rank, "rules": mining.validate_rules(rules, test, best, most=most_validated)}
    if numeric:
        out.reports["eda"] = mining.numeric_eda(df, numeric, "target_class")
    return out
