"""Operators that must hold when keys are hot and groups are whole tables, on both of their paths, against plain forms of the same."""

import itertools
import math
import random
import statistics
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import measures
from tallyframe.operators import cube, infer, metrics, mining, models, ranks, reconcile, skew
from tallyframe.plans import analyses
from tallyframe.rules import ReconRule, RunContext, TablePair
from tallyframe.sources import sinks
from tallyframe.tables import discarded, settled


@pytest.fixture(params=[1_000_000, 5], ids=["windows", "ranges"])
def one_task_rows(request, monkeypatch):
    monkeypatch.setattr(ranks, "ONE_TASK_ROWS", request.param)


def test_settled_tables_are_deleted(spark):
    held = settled(spark.range(10))
    assert held.count() == 10
    discarded(held)
    with pytest.raises(Exception, match="(?i)not.exist|no such file|FILE_NOT_EXIST"):
        spark.read.parquet(held.inputFiles()[0]).count()


# -- joins ------------------------------------------------------------------------------------------------------------

def sides(spark, seed=1):
    rng = random.Random(seed)
    key = lambda hot: rng.choice([None, "hot", "cold"]) if rng.random() < hot else f"k{rng.randrange(60)}"
    left = [(key(0.5), rng.randrange(2), i) for i in range(300)] + [("left", 0, 1000 + i) for i in range(80)]
    right = [(key(0.3), rng.randrange(2), i) for i in range(200)] + [("right", 1, 1000 + i) for i in range(70)]
    return spark.createDataFrame(left, "a string, b int, l int"), spark.createDataFrame(right, "c string, d int, r int"), left, right


def plain(left, right):
    want, met = Counter(), set()
    for x in left:
        hits = [(i, y) for i, y in enumerate(right) if x[:2] == y[:2]]
        want.update((*x, *y) for _, y in hits)
        met.update(i for i, _ in hits)
        if not hits:
            want[(*x, None, None, None)] += 1
    want.update((None, None, None, *y) for i, y in enumerate(right) if i not in met)
    return want


@pytest.mark.parametrize(("rows", "cell"), [(None, 2000), (20, 2000), (20, 7), (5, 1), (10_000, 5)])
def test_full_outer_join_with_hot_keys(spark, rows, cell):
    left, right, a, b = sides(spark)
    got = skew.full_outer(left.repartition(3), right.repartition(2), ["a", "b"], ["c", "d"], rows, cell)
    assert Counter(tuple(r) for r in got.collect()) == plain(a, b)
    none = skew.full_outer(left.where("false"), right, ["a", "b"], ["c", "d"], rows, cell)
    assert Counter(tuple(r) for r in none.collect()) == plain([], b)


def test_hot_keys_are_the_ones_with_many_rows(spark):
    left, right, a, b = sides(spark)
    n = lambda rows: Counter(r[:2] for r in rows)
    got = {tuple(r)[:2]: (r.n_left, r.n_right) for r in skew.hot_keys(left, right, ["a", "b"], ["c", "d"], 25).collect()}
    assert got == {k: (n(a)[k], n(b)[k]) for k in {*n(a), *n(b)} if n(a)[k] + n(b)[k] > 25} and (None, 0) in got
    assert skew.hot_keys(left, right, ["a", "b"], ["c", "d"], 1000) is None


def test_a_hot_key_runs_in_even_tasks(spark):
    """A tenth of all rows have a null key on both sides."""
    rows = lambda n, name: spark.range(n).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias(name), F.col("id").alias(f"{name}_v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.full_outer(rows(4000, "x"), rows(3000, "y"), ["x"], ["y"], 100, 40).where("x is null and y is null")
        per = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(per) == 400 * 300 and len(per) == 4 and max(per) < 2 * min(per)


def test_rows_of_a_very_hot_key_are_not_repeated_with_its_size(spark):
    """A null key on both sides: rows that go into the join, for each row of the inputs."""
    def dealt_rows(n):
        left, right = (spark.range(n).select(F.lit(None).cast("long").alias(x), F.col("id").alias(f"{x}_v")) for x in "xy")
        joined = skew.full_outer(left, right, ["x"], ["y"], 10, 10)
        assert joined.count() == n * n
        node = joined._jdf.queryExecution().optimizedPlan()
        while "Join" not in node.nodeName():
            node = node.children().head()
        frame = lambda plan: spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan).count()
        return sum(frame(node.children().apply(i)) for i in range(2)) / (2 * n)

    assert dealt_rows(100) <= 1.3 * skew.MOST_COPIES and dealt_rows(1000) <= 1.3 * skew.MOST_COPIES


def test_status_counts_are_those_of_the_joined_rows(spark):
    left, right, _, _ = sides(spark)
    s = left.select("a", "b", F.pmod("l", F.lit(7)).alias("v"))
    t = right.select(F.col("c").alias("a"), F.col("d").alias("b"), F.pmod("r", F.lit(7)).alias("v"))
    rule = ReconRule(keys=("a", "b"))
    for x, y in ((s, t), (t, s), (s.where("false"), t), (s.where("false"), t.where("false"))):
        joined = reconcile.join_rows(TablePair(x, y, "hot"), rule)
        want = joined.groupBy(F.coalesce("sk_0", "tk_0").alias("k_0"), F.coalesce("sk_1", "tk_1").alias("k_1"), "row_status").count()
        assert {tuple(r) for r in reconcile.status_counts(TablePair(x, y, "hot"), rule).collect()} == {tuple(r) for r in want.collect()}


def test_pairs_of_a_hot_key_are_counted_and_not_made(spark):
    """A null key of 200,000 rows on both sides has 40 billion pairs."""
    rows = spark.range(200_000).select(F.lit(None).cast("long").alias("k"), F.pmod("id", F.lit(1000)).alias("v"))
    got = {tuple(r) for r in reconcile.status_counts(TablePair(rows, rows, "hot"), ReconRule(keys=("k",))).collect()}
    assert got == {(None, "MATCH", 1000 * 200 * 200), (None, "CHANGED", 200_000**2 - 1000 * 200 * 200)}


RULE = ReconRule(keys=("id",), hash_buckets=16)


@pytest.fixture(scope="module")
def pair(spark):
    s = [(i if i % 9 else None, float(i), f"n{i % 5}") for i in range(90)] + [(4, 4.0, "n4")]
    t = [(i if i % 9 else None, float(i) + (i == 7), f"n{i % 5}") for i in range(3, 95)]
    schema = "id long, amount double, name string"
    return TablePair(spark.createDataFrame(s, schema), spark.createDataFrame(t, schema), "some")


def test_full_reports_scan_each_side_once_and_say_the_same(spark, pair):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    watched = TablePair(*(df.mapInPandas(seen, df.schema) for df in (pair.source, pair.target)), "some")
    got = reconcile.full_reports(watched, RULE)
    rows = lambda df: sorted(map(str, df.collect()))
    joined = reconcile.join_rows(pair, RULE)
    cells = reconcile.cell_rows(joined, pair, RULE)
    both = joined.agg(F.count_if(F.col("row_status").isin("MATCH", "CHANGED")).alias("n"))
    from tallyframe.operators import stats

    want = {
        "counts": stats.count_compare(pair), "source_keys": reconcile.key_quality(pair.source, RULE.keys), "target_keys": reconcile.key_quality(pair.target, RULE.keys), "buckets": reconcile.bucket_summary(pair, RULE),
        "summary": reconcile.table_summary(joined, pair, RULE), "rows": reconcile.row_status_detail(joined, pair, RULE), "columns": reconcile.column_mismatch_stats(cells, both), "cells": reconcile.changed_cells(cells),
    }
    assert list(got) == list(want)
    for name, df in want.items():
        assert got[name].columns == df.columns and rows(got[name]) == rows(df), name
    assert reads.value == 91 + 92


def test_checksum_tree_and_pruned_join(spark, pair):
    sums = reconcile.bucket_summary(pair, RULE)
    tree = reconcile.checksum_tree(sums, 4).collect()
    assert Counter(r.level for r in tree) == Counter({0: 1, 1: 4, 2: sums.count()})
    top = next(r for r in tree if r.level == 0)
    assert (top.source_rows, top.target_rows, top.node_match) == (91, 92, False)
    for r in tree:
        below = [x for x in tree if x.level == r.level + 1 and (r.level == 0 or x.root_id == r.root_id)]
        assert not below or r.source_hash_sum == sum(x.source_hash_sum for x in below)
    got, _ = reconcile.differing_rows(pair, RULE, 4)
    want = reconcile.join_rows(pair, RULE).where("row_status <> 'MATCH'")
    key = lambda df: Counter((r.sk_0, r.tk_0, r.s_hash, r.t_hash, r.row_status) for r in df.collect())
    assert key(got) == key(want)
    same, tree = reconcile.differing_rows(TablePair(pair.source, pair.source), RULE, 4)
    assert same.count() == 0 and all(r.node_match for r in tree.collect())


def test_texts_that_join_alike_hash_apart(spark):
    from tallyframe.functions.canonical import portable_hash

    rows = [("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc"), ("abc", None), ("abc", ""), ("∅", "abc"), ("1:a", "bc")]
    df = spark.createDataFrame(rows, "x string, y string")
    got = [r.h for r in df.select(portable_hash([F.col("x"), F.col("y")]).alias("h")).collect()]
    assert len(set(got)) == len(rows) and all(0 <= h < 1 << 60 for h in got)


# -- ranks ------------------------------------------------------------------------------------------------------------

def linear(values, p):
    v = sorted(values)
    at = p * (len(v) - 1)
    lo, hi = v[math.floor(at)], v[math.ceil(at)]
    return lo + (hi - lo) * (at - math.floor(at))


def test_percentiles_of_groups(spark, one_task_rows):
    rng = random.Random(2)
    rows = [(g, rng.choice([float(rng.randrange(20)), rng.random(), None])) for g in ["a"] * 300 + ["b"] * 7 + [None] * 30 + ["c"]]
    points = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {r.g: r.q for r in ranks.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", points).collect()}
    for g in {g for g, v in rows if v is not None}:
        assert got.pop(g) == pytest.approx([linear([v for x, v in rows if x == g and v is not None], p) for p in points])
    assert got == {}


def test_medians_of_grouping_sets(spark, one_task_rows):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), rng.choice(["p", "q", None]), "one", rng.choice([None, rng.randrange(9), rng.random()])) for _ in range(200)]
    rows = [(a, b, c, None if v is None else float(v)) for a, b, c, v in rows]
    got = cube.measure_by_dims(spark.createDataFrame(rows, "a string, b string, c string, m double"), ["a", "b", "c"], "m").collect()
    for r in got:
        own = [v for a, b, c, v in rows if v is not None and r.a in (None, a) and r.b in (None, b or "<NULL>") and r.c in (None, c)]
        assert (r["count"], r.median) == (len(own), pytest.approx(statistics.median(own)))
    assert len(got) == 2 + 3 + 1 + 6 + 2 + 3 + 6


def test_areas_with_ties(spark, one_task_rows):
    rng = random.Random(4)
    rows = [(int(rng.random() < 0.3), rng.randrange(12) / 10) for _ in range(150)]
    rows = [(f, min(1.0, s + 0.2 * f)) for f, s in rows]
    got = metrics.areas(spark.createDataFrame(rows + [(None, 0.5), (1, None)], "target_flag int, score double")).first()
    pos, neg = [s for f, s in rows if f], [s for f, s in rows if not f]
    assert got.roc_auc == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg))
    steps = slopes = recall = 0.0
    before = 1.0
    for s in sorted({s for _, s in rows}, reverse=True):
        taken = [f for f, x in rows if x >= s]
        precision, now = sum(taken) / len(taken), sum(taken) / len(pos)
        steps, slopes, recall, before = steps + (now - recall) * precision, slopes + (now - recall) * (precision + before) / 2, now, precision
    assert (got.average_precision, got.pr_auc) == (pytest.approx(steps), pytest.approx(slopes))
    one = metrics.areas(spark.createDataFrame([(1, 0.5)], "target_flag int, score double")).first()
    assert (one.records, one.roc_auc, one.average_precision) == (1, None, None)
    assert metrics.areas(spark.createDataFrame([], "target_flag int, score double")).first().records == 0


def test_class_report(spark):
    rows = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("b", "c")] + [("d", "a")]
    got = {r["class"]: r for r in metrics.class_report(spark.createDataFrame(rows, "target_flag string, predicted string")).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (pytest.approx(6 / 7), 0.75, 8)
    assert got["b"].f1 == pytest.approx(2 * (3 / 5) * (3 / 4) / (3 / 5 + 3 / 4)) and (got["c"].precision, got["c"].support, got["d"].f1) == (0.0, 0, 0.0)
    f1 = [got[c].f1 for c in "abcd"]
    assert got["macro avg"].f1 == pytest.approx(sum(f1) / 4) and got["weighted avg"].f1 == pytest.approx((8 * f1[0] + 4 * f1[1] + f1[3]) / 13)
    assert got["accuracy"].recall == pytest.approx(9 / 13) and got["accuracy"].support == 13


# -- bins and rules ---------------------------------------------------------------------------------------------------

def test_bins_of_near_edges_stay_apart(spark):
    df = spark.range(1000).select((F.lit(1_000_000) + F.col("id") / 999).alias("v"))
    edges = mining.quantile_edges(df, ["v"], 5)
    got = mining.binned_frame(df, edges).groupBy("v").count().collect()
    assert len(got) == 5 and all(r["count"] == 200 for r in got)
    numbers = df.groupBy(measures.bin_number(F.col("v"), edges["v"]).alias("b")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    low, high = measures.bin_edges(F.col("b"), edges["v"])
    for r in numbers.select("*", low.alias("low"), high.alias("high")).collect():
        assert r.low <= r.lo <= r.hi <= r.high
    edge = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 5.0, 5.1, 10.0, 11.0, None)], "v double")
    assert [r.b for r in edge.select(measures.bin_number(F.col("v"), [0.0, 5.0, 10.0]).alias("b")).collect()] == [1, 1, 1, 2, 2, 2, None]
    assert [r.b for r in edge.select(measures.binned(F.col("v"), [3.0]).alias("b")).collect()] == ["UNKNOWN"] * 7


@pytest.mark.parametrize("slots", [1 << 20, 128])
def test_item_sets_are_those_without_pruning(spark, slots):
    rng = random.Random(6)
    features = ["f", "g", "h", "i"]
    rows = [(*(rng.choice(["x", "y=1", None, f"z{rng.randrange(8)}"]) for _ in features), int(rng.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "f string, g string, h string, i string, target_flag int")
    got = mining.frequent_sets(df, features, "target_flag", 4, 12, slots)
    for k, level in enumerate(got, 1):
        want = Counter()
        for places in itertools.combinations(range(4), k):
            for key, n in Counter(tuple((p, r[p] or "UNKNOWN") for p in places) for r in rows).items():
                if n >= 12:
                    want[key] = (n, sum(r[4] for r in rows if all((r[p] or "UNKNOWN") == v for p, v in key)))
        assert {tuple((x.f, x.v) for x in r["items"]): (r.records, r.positives) for r in level.collect()} == dict(want)
    assert len(got) >= 3


def test_association_rules_come_from_rows_counted_alike(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice(["u", "v"]), rng.choice(["Y", "N", "N", None])) for _ in range(3000)]
    df, features, held = spark.createDataFrame(rows, "f string, g int, h string, t string"), ["f", "g", "h"], []

    def watched(frame):
        out = settled(frame)
        held.append(out.count())
        return out

    monkeypatch.setattr(mining, "settled", watched)
    monkeypatch.setattr(models, "settled", watched, raising=False)
    for target, longest in (("N", 4), ("UNKNOWN", 3)):
        got = {r.rule: (r.support, r.confidence, r.lift) for r in models.association_rules(df, features, "t", target, 0.01, 0.2, 0.9, longest).collect()}
        named = [([f"{f}={'UNKNOWN' if v is None else v}" for f, v in zip(features, r, strict=False)], (r[3] or "UNKNOWN") == target) for r in rows]
        share, want = sum(y for _, y in named) / len(rows), {}
        for k in range(1, longest):
            n, p = Counter(), Counter()
            for items, y in named:
                n.update(itertools.combinations(items, k))
                p.update(itertools.combinations(items, k) if y else ())
            want |= {" AND ".join(sorted(s)): (p[s] / len(rows), p[s] / n[s], p[s] / n[s] / share) for s in n if p[s] >= 30 and p[s] / n[s] >= 0.2 and p[s] / n[s] / share >= 0.9}
        assert got.keys() == want.keys() and len(want) > 8 and all(got[r] == pytest.approx(want[r]) for r in want)
    assert models.association_rules(df.where("false"), features, "t", "N").collect() == []
    assert max(held) <= 21  # rows that differ in a feature (18) and item sets (at most 21 of two), not all rows


def test_rules_need_positives_and_rate_drops_are_told(spark):
    rows = [("a", "u", 1)] * 40 + [("a", "v", 0)] * 20 + [("b", "u", 0)] * 60 + [("c", "u", 1)] * 4
    df = spark.createDataFrame(rows, "f string, g string, target_flag int")
    rules = lambda **more: {r.rule for r in mining.combination_rules(df, ["f", "g"], length=2, least_records=4, **more).collect()}
    assert rules() == {"f = a", "f = c", "g = u", "f = a AND g = u", "f = c AND g = u"}
    assert rules(least_positives=5) == {"f = a", "g = u", "f = a AND g = u"}
    assert "f = a AND g = u" not in rules(least_lift=1.2, prune=True) and "f = a AND g = u" in rules(least_lift=1.2)
    test = spark.createDataFrame([("a", "u", 1)] * 2 + [("a", "u", 0)] * 2, df.schema)
    got = {r.rule: r for r in mining.validate_rules(mining.combination_rules(df, ["f", "g"], length=1, least_records=4), test, ["f", "g"], most=2).collect()}
    assert len(got) == 2 and got["f = a"].rate_drop == pytest.approx(40 / 60 - 0.5)
    assert mining.scaled_thresholds(20, 5, 0.25) == (15, 3) and mining.scaled_thresholds(4, 1, 0.25) == (5, 2)


def test_tree_rules_say_what_the_tree_does(spark):
    """Every rule, as SQL of another engine over the rows that the tree saw, holds exactly for the rows of its leaf."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(8)
    odd = ["a\\b", "it's", 'say "x"', "`tick`", "plain", "% _"]
    rows = [(rng.choice(odd), rng.uniform(0, 10), i) for i in range(600)]
    rows = [(c, n, i, int((c in ("a\\b", "it's")) != (n > 6))) for c, n, i in rows]
    df = spark.createDataFrame(rows, "c string, `a number` double, id long, target_flag int")
    leaves, paths = models.tree_leaves(df, ["a number"], ["c"], depth=4)
    seen = leaves.toPandas()
    assert set(seen.leaf) == set(range(len(paths))) and len(paths) > 3
    con = duckdb.connect()
    con.register("seen", seen)
    for i, path in enumerate(paths):
        text = " and ".join(str(p).replace("a number", '"a number"') for p in path)
        assert con.sql(f"select count(*), count(*) filter (leaf = {i}) from seen where {text}").fetchall() == [(int((seen.leaf == i).sum()),) * 2]
        tests = F.lit(True)
        for p in path:
            tests = tests & p.test()
        assert leaves.where(tests).select("leaf").distinct().collect() == [(i,)]
    out = models.tree_rules(df, ["a number"], ["c"]).collect()
    assert sum(r.records for r in out) == 600 and all(r.positives in (0, r.records) for r in out if r.predicted_class == (r.rate > 0.5) and r.rate in (0.0, 1.0))


def test_a_value_with_a_backslash_has_its_own_leaf(spark):
    df = spark.createDataFrame([("a\\b", 1)] * 200 + [("other", 0)] * 200, "c string, target_flag int")
    got = models.tree_rules(df, [], ["c"]).collect()
    assert sorted((r.records, r.positives) for r in got) == [(200, 0), (200, 200)]


# -- dates ------------------------------------------------------------------------------------------------------------

def test_dates_are_parsed_and_the_column_decides(spark):
    rows = [("2024-13-45", "Jan 5, 2024", "13/01/2024", "01/02/2024", "20240131", "2024", "5-feb-99", "March 2024", "2024-02-29T23:59:59.5Z")] * 3
    rows += [("9999-99-99", "december 31 2023", "02/01/2024", "03/04/2024", "20241301", "1999", "28 Feb 68", "Apr-24", "2023-02-29 10:00")]
    names = ["order_date", "ship", "eu", "both", "paid_dt", "years", "when", "m", "at"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    got = {r.column_name: r for r in infer.infer_types(df).collect()}
    assert (got["order_date"].date_score, got["order_date"].date_format, got["order_date"].inferred_type) == (0.0, None, "categorical")
    want = {"ship": (1.0, "month-name day, year"), "eu": (1.0, "day/month/year"), "both": (1.0, "month/day/year"), "paid_dt": (0.75, "yearmonthday"), "years": (1.0, "year"), "when": (1.0, "day month-name year"), "m": (1.0, "month-name year"), "at": (0.75, "year-month-day")}
    assert {n: (got[n].date_score, got[n].date_format) for n in want} == want
    assert got["years"].inferred_type == "date" and infer.infer_types(df.select(F.col("years").alias("n"))).first().inferred_type == "numeric"
    day = lambda c, f: [r[0] for r in df.select(infer.dates_of(F.col(f"`{c}`"), f)).collect()]
    assert day("ship", "month-name day, year")[::3] == [datetime(2024, 1, 5), datetime(2023, 12, 31)]
    assert day("when", "day month-name year")[::3] == [datetime(1999, 2, 5), datetime(2068, 2, 28)] and day("m", "month-name year")[3] == datetime(2024, 4, 1)
    assert day("at", "year-month-day")[::3] == [datetime(2024, 2, 29, 23, 59, 59), None]


def test_column_report(spark):
    rows = [("1,000", "2024-01-05", "x"), ("30", "2024-03-01", "x"), ("NA", None, "y"), ("2.5", "2023-12-31", " ")]
    got = {r.column_name: r for r in infer.column_report(spark.createDataFrame(rows, "n string, d string, t string")).collect()}
    n, d, t = got["n"], got["d"], got["t"]
    assert (n.inferred_type, n.row_count, n.non_null_count, n.min, n.max, n.median) == ("numeric", 4, 3, 2.5, 1000.0, 30.0)
    assert (d.inferred_type, d.date_format, d.first_date, d.last_date, d.median) == ("date", "year-month-day", datetime(2023, 12, 31), datetime(2024, 3, 1), None)
    assert (t.inferred_type, t.unique_count, t.null_percent, t.top_values) == ("categorical", 2, 25.0, "x:2 | y:1")
    empty = infer.column_report(spark.createDataFrame([], "n string, v double")).collect()
    assert [(r.row_count, r.unique_count) for r in empty] == [(0, 0)] * 2


# -- repeated runs ----------------------------------------------------------------------------------------------------

def test_a_run_that_fails_half_way_and_is_repeated_leaves_no_double_rows(spark, tmp_path):
    spark.sql("create schema if not exists again")
    run, other = RunContext("run 'a'", datetime(2024, 1, 1)), RunContext("b", datetime(2024, 1, 2))
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    put = lambda df, r=run, of="t": sinks.append_run(df, "again.rows", r, "report", of, "again.marks")
    rows = lambda df: sorted((r.run_id, r.report_of, r.v) for r in df.collect())
    try:
        assert put(frame(1, 2)) == 2 and put(frame(3), other) == 1
        bad = frame(4, 5).withColumn("v", F.expr("assert_true(v < 5)").cast("long"))
        with pytest.raises(RuntimeError, match="incoming .* existing"):
            put(bad, of="u")
        assert rows(sinks.committed(spark, "again.rows", "again.marks")) == [("b", "t", 3), ("run 'a'", "t", 1), ("run 'a'", "t", 2)]
        assert put(frame(1, 2)) == 2 and put(frame(4), of="u") == 1
        assert rows(spark.table("again.rows")) == [("b", "t", 3), ("run 'a'", "t", 1), ("run 'a'", "t", 2), ("run 'a'", "u", 4)]
        assert put(frame()) == 0 and put(frame(7).withColumn("more", F.lit("m")), other) == 1
        assert rows(spark.table("again.rows")) == [("b", "t", 7), ("run 'a'", "u", 4)]
        with pytest.raises(RuntimeError, match="incoming struct<v:string>"):
            put(spark.createDataFrame([("x",)], "v string"))
    finally:
        spark.sql("drop schema again cascade")


def test_reconciliation_can_be_run_again(spark, pair):
    run = RunContext("r1", datetime(2024, 1, 1))
    pairs = {"good": lambda: (pair, RULE), "bad": lambda: (pair, ReconRule(keys=("nope",)))}
    try:
        first = analyses.run_reconciliation(spark, pairs, run, "twice")
        counts = {t.name: spark.table(f"twice.{t.name}").count() for t in spark.catalog.listTables("twice") if t.name != "recon_commits"}
        assert analyses.run_reconciliation(spark, pairs, run, "twice") == first == {"good": "FAIL", "bad": "ERROR"}
        assert {t: spark.table(f"twice.{t}").count() for t in counts} == counts and counts["recon_runs"] == 2
    finally:
        spark.sql("drop schema twice cascade")
