"""Operators and analyses on small frames: properties, edge cases, empty inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import cube, duplicates, infer, mining, models, profile, reconcile, sample, schema_diff, stats
from tallyframe.operators.ranks import distinct_counts, exact_percentiles
from tallyframe.plans import analyses
from tallyframe.rules import ReconRule, RunContext, TablePair
from tallyframe.sources import readers, sinks

RULE = ReconRule(keys=("id", "part"))


@pytest.fixture(scope="module")
def pair(spark):
    s = [(1, "a", 10.0, "x", None), (2, "a", 20.0, "y", datetime(2024, 1, 1)), (3, None, 30.0, "z", None), (4, "b", None, "w", None), (4, "c", 5.0, "w", None)]
    t = [(1, "a", 10.0, "x", None), (2, "a", 20.004, "y", datetime(2024, 1, 1, 0, 0, 30)), (3, None, 30.0, "z", None), (4, "b", 1.0, None, None), (9, "c", 5.0, "w", None)]
    schema = "id long, part string, amount double, name string, ts timestamp_ntz"
    return TablePair(spark.createDataFrame(s, schema), spark.createDataFrame(t, schema.replace("amount", "AMOUNT")), "tiny")


def status(df):
    return {r.row_status: r.n_rows for r in reconcile.row_status_summary(df).collect()}


def test_statuses_and_null_keys(pair):
    assert status(reconcile.join_rows(pair, RULE)) == {"MATCH": 2, "CHANGED": 2, "SOURCE_ONLY": 1, "TARGET_ONLY": 1}


def test_a_frame_matches_itself_and_sides_swap(pair):
    same = TablePair(pair.source, pair.source)
    assert status(reconcile.join_rows(same, RULE)) == {"MATCH": 5}
    assert status(reconcile.join_rows(TablePair(pair.target, pair.source), RULE)) == {"MATCH": 2, "CHANGED": 2, "SOURCE_ONLY": 1, "TARGET_ONLY": 1}


def test_cells(pair):
    joined = reconcile.join_rows(pair, RULE)
    cells = reconcile.changed_cells(reconcile.cell_rows(joined, pair, RULE)).collect()
    assert {(c.key_json, c.column_name, c.mismatch_type) for c in cells} == {
        ('{"id":"2.000000000000000000","part":"a"}', "amount", "VALUE_MISMATCH"), ('{"id":"2.000000000000000000","part":"a"}', "ts", "VALUE_MISMATCH"),
        ('{"id":"4.000000000000000000","part":"b"}', "amount", "SOURCE_NULL"), ('{"id":"4.000000000000000000","part":"b"}', "name", "TARGET_NULL")}
    loose = ReconRule(keys=("id", "part"), numeric_abs=0.01, timestamp_seconds=60)
    assert {c.column_name for c in reconcile.changed_cells(reconcile.cell_rows(joined, pair, loose)).collect() if "2.0" in c.key_json} == set()
    summary = reconcile.table_summary(joined, pair, loose).first()
    assert (summary.changed_rows, summary.tolerant_match_rows, summary.status) == (2, 1, "FAIL")


def test_null_equivalents_join_keys(spark):
    rule = ReconRule(keys=("k",), trim_strings=True, null_equivalents=("na",))
    p = TablePair(spark.createDataFrame([("A ", 1), ("NA", 2)], "k string, v int"), spark.createDataFrame([("A", 1), (None, 2)], "k string, v int"))
    assert status(reconcile.join_rows(p, rule)) == {"MATCH": 2}


def test_empty_sides(spark, pair):
    empty = TablePair(pair.source.limit(0), pair.target)
    assert status(reconcile.join_rows(empty, RULE)) == {"TARGET_ONLY": 5}
    none = TablePair(pair.source.limit(0), pair.target.limit(0))
    row = reconcile.table_summary(reconcile.join_rows(none, RULE), none, RULE).first()
    assert (row.source_rows, row.match_percent, row.status) == (0, 0.0, "PASS")
    assert reconcile.key_quality(none.source, ["id"]).first().total_rows == 0
    assert stats.count_compare(none).first().status == "MATCH"
    assert reconcile.bucket_summary(none, RULE).collect() == []


def test_bucket_sums_agree_for_equal_rows_in_any_order(pair):
    same = TablePair(pair.source, pair.source.orderBy(F.desc("id")))
    assert all(r.bucket_match for r in reconcile.bucket_summary(same, RULE).collect())
    assert not all(r.bucket_match for r in reconcile.bucket_summary(pair, RULE).collect())


def test_key_quality_counts_nulls_and_surplus(pair):
    r = reconcile.key_quality(pair.source, ["ID"]).first()
    assert (r.total_rows, r.null_key_rows, r.distinct_keys, r.duplicate_key_groups, r.duplicate_surplus_rows) == (5, 0, 4, 1, 1)
    assert reconcile.key_quality(pair.source, ["part"]).first().null_key_rows == 1
    assert reconcile.null_key_rows(pair.source, ["part"]).count() == 1


def test_duplicates_of_either_side(spark):
    p = TablePair(spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (None,), (None,)], "k int"), spark.createDataFrame([(1,), (1,), (1,), (3,), (3,), (None,), (None,)], "k int"))
    got = {r.k: (r.source_count, r.target_count, r.status) for r in duplicates.duplicate_reconciliation(p, ["k"]).collect()}
    assert got == {1: (2, 3, "COUNT_MISMATCH"), 2: (2, 0, "ONLY_IN_SOURCE"), 3: (0, 2, "ONLY_IN_TARGET"), None: (2, 2, "MATCH")}
    r = duplicates.duplicate_summary(duplicates.duplicate_reconciliation(p, ["k"])).first()
    assert (r.source_duplicate_rows, r.target_duplicate_rows, r.matched_keys, r.overall_status) == (6, 7, 1, "MISMATCH")


def test_schema_diff_statuses(spark, pair):
    s, t = schema_diff.schema_rows(spark, pair.source.schema, "x"), schema_diff.schema_rows(spark, pair.target.select("id", F.col("part").cast("int").alias("part"), F.lit(1).alias("new")).schema, "x")
    got = {r.column_name: r.status for r in schema_diff.schema_diff(s, t).collect()}
    assert got == {"id": "MATCH", "part": "TYPE_MISMATCH", "new": "TARGET_ONLY_COLUMN", "amount": "SOURCE_ONLY_COLUMN", "name": "SOURCE_ONLY_COLUMN", "ts": "SOURCE_ONLY_COLUMN"}
    by_class = {r.column_name: r.status for r in schema_diff.schema_diff(s, t, by_class=True).collect()}
    assert by_class["part"] == "CLASSIFICATION_MISMATCH" and by_class["id"] == "PASS"
    assert {r.status for r in schema_diff.table_rows(s, t.limit(0)).collect()} == {"SOURCE_ONLY_TABLE"}


def test_sample_keeps_null_keys_and_ignored_context(pair):
    out = sample.sample_reconciliation(pair, ["id", "part"], "ts", 10, ["name"])
    assert {(r.id, r.part): r.status for r in out.collect()} == {(1, "a"): "MATCH", (2, "a"): "HASH_MISMATCH", (3, None): "MATCH", (4, "b"): "HASH_MISMATCH", (4, "c"): "MISSING_IN_TARGET"}
    cells = sample.column_mismatches(out, pair, ["id", "part"], ["name"])
    got = {(r.id, r.column_name): (r.mismatch_class, r.source_ignored_name) for r in cells.collect()}
    assert got == {(2, "amount"): ("TRUE_MISMATCH", "y"), (2, "ts"): ("FALSE_MISMATCH", "y"), (4, "amount"): ("TRUE_MISMATCH", "w")}
    rows = {r.id: r.row_class for r in sample.row_mismatch_summary(cells, ["id", "part"]).collect()}
    assert rows == {2: "TRUE_MISMATCH", 4: "TRUE_MISMATCH"}


def test_probe_casts_keys_to_the_target(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    keys = sample.typed_keys(spark.createDataFrame([("1",), ("x",)], "k string"), target, ["k"])
    assert [r.v for r in sample.probe(target, keys, ["k"]).collect()] == ["a"]


def test_statistics_verdict(pair):
    reports = analyses.stats.compare_statistics(pair, RULE)
    assert {r.report: r.status for r in reports["overall"].collect()}["overall"] == "FAIL"
    same = stats.compare_statistics(TablePair(pair.source, pair.source), RULE)
    assert {r.status for r in same["overall"].collect()} == {"PASS"}


def test_profiles_of_an_empty_frame_keep_their_rows(pair):
    out = profile.profile_columns(pair.source.limit(0)).collect()
    assert len(out) == 5 and all(r.total_rows == 0 and r.null_percent == 0.0 for r in out)
    assert profile.profile_numeric(pair.source.limit(0)).count() == 2


def test_long_form_batches_agree(pair):
    one = {"id": {"n": F.count("id")}, "name": {"n": F.count("name")}, "amount": {"n": F.count("amount")}}
    assert sorted(profile.long_form(pair.source, one, batch=1).collect()) == sorted(profile.long_form(pair.source, one).collect())


def test_inference(spark):
    rows = [(str(i), f"2024-01-{i % 28 + 1:02d}", f"{i},000", "yes" if i % 2 else "no", "ab"[i % 2] * 2, f"text {i} of its own") for i in range(300)]
    df = spark.createDataFrame(rows, "order_id string, shipped string, amount string, flag string, grade string, note string")
    got = {r.column_name: r.inferred_type for r in infer.infer_types(df, {"grade": "other"}).collect()}
    assert got == {"order_id": "identifier", "shipped": "date", "amount": "numeric", "flag": "boolean", "grade": "other", "note": "other"}


def test_cube_separates_null_from_all(spark):
    df = spark.createDataFrame([("a", None, 1.0), (None, "x", 2.0), ("a", "x", 4.0)], "p string, q string, m double")
    got = {(r.dims, r.dim_values): r["sum"] for r in cube.measure_by_dims(df, ["p", "q"], "m").collect()}
    assert got[("p", "<NULL>")] == 2.0 and got[("p", "a")] == 5.0 and got[("p | q", "a | <NULL>")] == 1.0 and len(got) == 7
    with pytest.raises(ValueError, match="budget"):
        cube.dimension_sets([f"d{i}" for i in range(40)], 3, 100)
    few = [("p",), ("q",), ("p", "q")]
    rows = lambda chunk: sorted(map(str, cube.grouped_sets(df, few, [F.count("*").alias("n")], chunk=chunk).select("p", "q", "dims", "n").collect()))
    assert rows(1) == rows(60)


def test_rules_with_awkward_values_apply_to_rows(spark):
    rows = [(i, "x AND y = z" if i % 2 else "plain", "k", int(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, f string, g string, target_flag int")
    rules = mining.combination_rules(df, ["f", "g"], length=2, least_records=10, least_lift=1.5, prune=False)
    hits = mining.apply_rules(df, rules, ["f", "g"], ["id"]).where("rule = 'f = x AND y = z'")
    assert hits.count() == 100
    train, test = mining.split_rows(df, ["id"])
    assert train.count() + test.count() == 200 and train.join(test, "id").count() == 0
    checked = mining.validate_rules(rules, test, ["f", "g"]).first()
    assert checked.test_lift > 1.5 and checked.recommended_action


def test_quantile_edges_drop_ties(spark):
    df = spark.createDataFrame([(1.0,)] * 90 + [(2.0,)] * 5 + [(9.0,)] * 5, "v double")
    assert mining.quantile_edges(df, ["v"])["v"] == pytest.approx([1.0, 2.6, 4.2, 5.8, 7.4, 9.0])
    assert mining.quantile_edges(df.limit(90), ["v"])["v"] == [1.0]


def test_exact_percentiles_of_skewed_groups(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [("hot", float(x)) for x in rng.normal(size=3000).round(2)] + [("ties", 5.0)] * 400 + [("one", 3.0), ("none", None)] + [(None, float(x)) for x in range(7)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    points = [0.0, 0.1, 0.37, 0.5, 0.99, 1.0]
    got = {r.g: r.q for r in exact_percentiles(df, ["g"], "v", points).collect()}
    assert set(got) == {"hot", "ties", "one", None}
    for g, q in got.items():
        assert q == pytest.approx(list(np.quantile([v for k, v in rows if k == g], points)))
    assert exact_percentiles(df.where("false"), ["g"], "v", points).collect() == []
    assert {r.column_name: r.distinct_values for r in distinct_counts(df, ["g", "v"]).collect()} == {"g": 4, "v": len({str(v) for _, v in rows if v is not None})}


def test_decimal_statistics_keep_all_digits(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big,), (1,)], "v long")
    got = {r.stat: r.value for r in stats.numeric_stats(df, ["v"], decimal=True).collect()}
    assert int(got["max"]) == big and int(got["sum"]) == big + 1
    assert {r.stat: r.value for r in stats.numeric_stats(df, ["v"]).collect()}["median"] == pytest.approx(big / 2)


def test_inferred_types(spark):
    rows = [(f"u{i}", str(i), ["1", "NaN", "nan", "3"][i % 4], "2024-01-0" + str(i % 9 + 1), "yn"[i % 2], f"text {i}", "1,000") for i in range(300)]
    df = spark.createDataFrame(rows, "username string, zipcode string, few string, seen string, flag string, free string, amount string")
    got = {r.column_name: r for r in infer.infer_types(df, {"zipcode": "categorical"}).collect()}
    assert got["few"].non_missing == 150 and {k: r.inferred_type for k, r in got.items()} == {
        "username": "identifier", "zipcode": "categorical", "few": "numeric", "seen": "date", "flag": "boolean", "free": "other", "amount": "numeric",
    }
    assert infer.infer_types(df.select("zipcode")).first().inferred_type == "identifier"


def test_multiclass_rules_tell_glued_values_apart(spark):
    rows = [("x | y", "z", "A")] * 4 + [("x", "y | z", "A")] * 2 + [("x", "y | z", "B")] * 4
    df = spark.createDataFrame(rows, "f string, g string, target_class string")
    out = mining.multiclass_rules(df, ["f", "g"], 2, 1, 0.0).where("features = 'f | g'").collect()
    assert sorted((r.target_class, r.records, r.positives) for r in out) == [("A", 4, 4), ("A", 6, 2), ("B", 6, 4)]


def test_trees_take_categories_of_many_values(spark):
    rows = [(f"v{i % 200}" if i % 3 else "often", int(i % 3 == 0)) for i in range(1200)]
    df = spark.createDataFrame(rows, "c string, target_flag int")
    out = models.tree_rules(df, [], ["c"]).collect()
    assert sum(r.records for r in out) == 1200 and {r.rate for r in out} == {0.0, 1.0} and all("`" not in r.rule for r in out)


def test_stratified_split_keeps_shares(spark):
    df = spark.createDataFrame([(i, "rare" if i % 50 == 0 else "common") for i in range(2000)], "id long, y string")
    train, test = mining.stratified_split(df, "y", ["id"], 0.25)
    assert {r.y: r.n for r in test.groupBy("y").agg(F.count("*").alias("n")).collect()} == {"rare": 10, "common": 490}
    assert train.count() == 1500 and train.join(test, "id").count() == 0 and train.columns == df.columns


def test_targets(spark):
    df = spark.createDataFrame([("Low",), (" high ",), (None,), ("odd",)], "t string")
    order = (("low", 1), ("high", 3))
    assert [r.target_order for r in mining.prepare_target(df, mining.Target("t", "ordinal", order=order)).collect()] == [1, 3]
    assert [r.target_flag for r in mining.prepare_target(df, mining.Target("t", positive="HIGH")).collect()] == [0, 1, 0]
    with pytest.raises(ValueError):
        mining.prepare_target(df, mining.Target("t", "other"))


def test_tree_rules_cover_all_rows(spark):
    rows = [(float(i % 50), ["a", "b", None][i % 3], int(i % 50 > 30 and i % 3 == 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "n double, c string, target_flag int")
    out = models.tree_rules(df, ["n"], ["c"]).collect()
    assert sum(r.records for r in out) == 600 and sum(r.positives for r in out) == df.agg(F.sum("target_flag")).first()[0]
    assert max(r.rate for r in out) > 0.9 and all(r.rule is not None for r in out)
    scored = models.scored_rows(df, ["n"], ["c"])
    assert models.areas(scored)["areaUnderROC"] > 0.95 and sum(r.records for r in models.confusion(scored).collect()) == 600


def test_association_rules(spark):
    rows = [("a" if i % 4 else "b", "u" if i % 2 else "v", "Y" if i % 4 == 0 else "N") for i in range(200)]
    out = models.association_rules(spark.createDataFrame(rows, "f string, g string, t string"), ["f", "g"], "t", "Y", lift=1.1).collect()
    top = next(r for r in out if r.rule == "f=b")
    assert (top.confidence, top.support) == (1.0, 0.25) and top.lift == pytest.approx(4) and top.leverage == pytest.approx(0.25 - 0.25 * 0.25) and top.conviction is None


def test_analyses(spark, pair):
    assert set(analyses.compare_table(pair, RULE, "COUNTS_ONLY").reports) == {"schema", "counts"}
    full = analyses.compare_table(pair, RULE)
    assert all(df.count() >= 0 for df in full.reports.values())
    results, verdicts = analyses.compare_tables({"good": lambda: (TablePair(pair.source, pair.source), RULE), "bad": lambda: (pair, ReconRule(keys=("nope",)))})
    assert verdicts == {"good": "PASS", "bad": "ERROR"} and "nope" in results["bad"].errors["bad"]
    assert set(analyses.run_checks(pair, "all", ["id", "part"], "ts").reports) >= {"counts", "types", "sample", "column_mismatches"}
    assert set(analyses.run_checks(pair, "duplicate", ["id"], "ts").reports) == {"duplicates", "duplicate_summary"}
    with pytest.raises(ValueError):
        analyses.run_checks(pair, "WRONG", ["id"], "ts")
    profiles = analyses.profile_tables({"p": lambda: pair.source, "q": lambda: readers.read_table(spark, "missing_table")})
    assert set(profiles["p"].reports) == {"counts", "columns", "numeric", "categorical", "datetime"} and profiles["q"].errors


def test_csv_analysis_and_mining(spark, tmp_path):
    rows = [(f"id{i}", "ab"[i % 2], f"{i % 7}", "Y" if i % 2 and i % 3 == 0 else "N") for i in range(600)]
    df = spark.createDataFrame(rows, ["Row ID", "Kind", "Some Value", "Fraud"])
    df.coalesce(1).write.option("header", True).csv(f"{tmp_path}/in")
    source = readers.Source("csv", f"{tmp_path}/in", clean=True, columns=("row_id", "kind", "some_value", "fraud"), where="kind is not null")
    loaded = readers.load(spark, source)
    out = analyses.analyse_csv(loaded, forced={"some_value": "numeric"})
    assert out.reports["measure_some_value"].count() > 0 and all(r.count() >= 0 for r in out.reports.values())
    mined = analyses.mine(loaded, mining.Target("fraud"), ["row_id"], least_records=20)
    assert mined.reports["rules"].count() > 0
    assert analyses.mine(loaded, mining.Target("fraud", "multiclass"), ["row_id"], least_records=20).reports["rules"].count() > 0


def test_sources(spark, pair, tmp_path):
    with pytest.raises(ValueError, match="go together"):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")
    opts = readers.jdbc_options("jdbc:x", "s.t", where="a > 1", partition_column="id", lower=1, upper=100, partitions=4, user="u")
    assert opts["dbtable"] == "(select * from s.t where a > 1) q" and opts["numPartitions"] == "4" and opts["user"] == "u"
    assert "partitionColumn" not in readers.jdbc_options("jdbc:x", "t", query="select 1")
    assert readers.select_statement(["a`b"], "t", "x > 1") == "SELECT `a``b` FROM t WHERE x > 1"
    assert "'pub''lic'" in readers.catalogue_query(readers.PRIMARY_KEY_QUERY, "pub'lic", "t")
    with pytest.raises(ValueError, match="unknown source kind"):
        readers.load(spark, readers.Source("nope", ""))
    pair.source.write.parquet(f"{tmp_path}/p")
    assert readers.load(spark, readers.Source("parquet", f"{tmp_path}/p", columns=("ID",), where="id > 1")).count() == 4
    mixed = readers.rows_as_text(spark, [{"a": 1, "b": datetime(9999, 12, 31)}, {"a": 1.5, "c": {"z": 1, "y": [None]}}]).collect()
    assert [tuple(r) for r in mixed] == [("1", "9999-12-31T00:00:00", None), ("1.5", None, '{"y": [null], "z": 1}')]


def test_catalogue_metadata(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("create table main.b (k2 integer, k1 varchar, v double, primary key (k1, k2)); create table main.a (x date); insert into main.b values (1, 'p', 2.5)")

    def run(query):
        got = con.sql(query.replace("c.reltuples", "42").replace("::bigint", "::hugeint::bigint"))
        kinds = ", ".join(f"{c} {'string' if str(t) == 'VARCHAR' else 'long'}" for c, t in zip(got.columns, got.types, strict=True))
        return spark.createDataFrame(got.fetchall(), kinds)

    assert readers.base_tables(run, "main") == ["a", "b"]
    assert readers.primary_key(run, "main", "b") == ["k1", "k2"] and readers.primary_key(run, "main", "a") == []
    assert readers.exact_rows(run, "main.b") == 1 and readers.exact_rows(run, "main.b", "v > 3") == 0
    with pytest.raises(ValueError, match="does not exist"):
        readers.column_metadata(lambda q: spark.createDataFrame([("b", "v", 1)], "table_name string, column_name string, ordinal_position int"), "main", "c")
    estimate = lambda q: spark.createDataFrame([(-1,)], "estimated_rows long")
    assert readers.estimated_rows(estimate, "main", "b") == 0 and "greatest" in readers.ESTIMATE_QUERY


def test_audited_run_goes_on_after_a_failure(spark, pair):
    schema, run = "audit_run_test", RunContext("r9", datetime(2024, 1, 1))
    try:
        pairs = {"good": lambda: (pair, RULE), "bad": lambda: (pair, ReconRule(keys=("nope",)))}
        assert analyses.run_reconciliation(spark, pairs, run, schema) == {"good": "FAIL", "bad": "ERROR"}
        runs = {r.table_name: r for r in spark.table(f"{schema}.recon_runs").collect()}
        assert runs["good"].error is None and "nope" in runs["bad"].error and runs["good"].duration_seconds >= 0
        assert spark.table(f"{schema}.recon_summary").first().run_id == "r9"
        assert {r.table_name for r in schema_diff.catalogue_schema_rows(spark, schema, ["recon_runs", "missing"]).collect()} == {"recon_runs", "missing"}
        more = spark.table(f"{schema}.recon_runs").limit(1).drop("error").withColumn("note", F.lit("new"))
        sinks.append_audit(more, f"{schema}.recon_runs")
        assert spark.table(f"{schema}.recon_runs").where("note = 'new' and error is null").count() == 1
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def test_audit_roundtrip(spark, pair):
    schema, run = "audit_test", RunContext("r1", datetime(2024, 1, 1))
    sinks.ensure_schema(spark, schema)
    name = sinks.audit_table_name(schema, "recon", "counts")
    assert sinks.audit_table_name(schema, "recon", "cells", "Sales.Orders") == "audit_test.recon_cells_sales_orders"
    try:
        report = sinks.with_audit_columns(stats.count_compare(pair), run, "COUNTS", "summary", ("db", "s", "t"), ("c", "s", "t"), table_context=False)
        sinks.append_audit(report, name)
        sinks.append_audit(report, name)
        back = spark.table(name)
        assert back.count() == 2 and back.columns[:10] == list(sinks.AUDIT_COLUMNS) and back.first().source_table is None
        with pytest.raises(RuntimeError, match="existing"):
            sinks.append_audit(report.withColumn("difference", F.array(F.lit("x"))), name)
        events = f"{schema}.recon_status"
        for i, s in enumerate(("RUNNING", "COMPLETED")):
            sinks.status_event(spark, run, s, events, datetime(2024, 1, 1, i))
        assert sinks.latest_status(spark, events).first().status == "COMPLETED"
        assert "recon_counts" in sinks.truncate_audit(spark, schema, "recon") and spark.table(name).count() == 0
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def test_csv_export(spark, pair, tmp_path):
    sinks.write_csv(sinks.text_safe(pair.source), sinks.csv_folder(str(tmp_path), "My Report", "x"))
    assert spark.read.option("header", True).csv(f"{tmp_path}/my_report_x").count() == 5
    assert sinks.manifest(spark, {"a": "/x"}).first().path == "/x"
    sinks.write_csv_file(sinks.text_safe(pair.source), f"{tmp_path}/one.csv")
    assert len((tmp_path / "one.csv").read_text().splitlines()) == 6 and not (tmp_path / "one.csv.parts").exists()
    assert [tuple(r) for r in sinks.inventory({"s": pair.source}).collect()] == [("s", 5, 5)]
    assert duplicates.most_duplicated(pair.source, ["id"], 1).first().duplicate_count == 2
    assert sample.hashed_sample(pair.source, ["id"], "ts", 2).count() == 2
