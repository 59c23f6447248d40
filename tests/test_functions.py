"""Column builders on small inline frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import rules
from tallyframe.functions import canonical, classify, equality, measures
from tallyframe.rules import ReconRule


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_null_booleans_and_binary_have_one_text(spark):
    df = spark.createDataFrame([(True, bytearray(b"a")), (False, None), (None, b"")], "b boolean, x binary")
    text = lambda c: canonical.normalised(F.col(c), df.schema[c].dataType)
    assert values(df, text("b"), text("x")) == [("true", "YQ=="), ("false", "<NULL>"), ("<NULL>", "")]


def test_timestamps_always_have_six_digits_and_far_years_pass(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 03:04:05' a, timestamp'2024-01-02 03:04:05.120000' b, timestamp_ntz'9999-12-31 00:00:00' c, date'1600-01-01' d")
    got = values(df, *(canonical.normalised(F.col(c), df.schema[c].dataType) for c in "abcd"))
    assert got == [("2024-01-02T03:04:05.000000", "2024-01-02T03:04:05.120000", "9999-12-31T00:00:00.000000", "1600-01-01")]


def test_canonical_strings_follow_the_rule(spark):
    df = spark.createDataFrame([(" A ",), ("n/a",), ("NULL",), ("",), (None,), ("NAB",)], "s string")
    rule = ReconRule(keys=("s",), trim_strings=True, lower_strings=True, null_equivalents=rules.NULL_EQUIVALENTS)
    assert [r[0] for r in values(df, canonical.canonical(F.col("s"), T.StringType(), rule))] == ["a", None, None, None, None, "nab"]


def test_numbers_beyond_the_scale_keep_plain_text(spark):
    df = spark.sql("select cast('1234567890123456789012345' as decimal(38,0)) d, 10.5 e, cast(1e3 as double) f")
    got = values(df, *(canonical.canonical(F.col(c), df.schema[c].dataType) for c in "def"))[0]
    assert got == ("1234567890123456789012345", "10.500000000000000000", "1000.000000000000000000")


def test_complex_values_keep_null_fields(spark):
    df = spark.sql("select named_struct('a', 1, 'b', cast(null as int)) s, array(1, null) a")
    assert values(df, *(canonical.canonical(F.col(c), df.schema[c].dataType) for c in "sa")) == [('{"a":1,"b":null}', "[1,null]")]


def test_zone_of_wall_clock_times(spark):
    df = spark.sql("select timestamp_ntz'2024-07-01 12:00:00' t")
    out = canonical.zone_normalised(F.col("t"), T.TimestampNTZType(), "Asia/Kolkata")
    assert values(df, F.date_format(out, "yyyy-MM-dd HH:mm")) == [("2024-07-01 06:30",)]


@pytest.mark.parametrize(("s", "t", "want"), [(None, None, True), (None, 1.0, False), (1.0, 1.009, True), (1.0, 1.02, False), (0.5, 0.509, True), (1000.0, 1005.0, True), (1000.0, 1011.0, False)])
def test_tolerances(spark, s, t, want):
    rule = ReconRule(keys=("k",), numeric_abs=0.01, numeric_rel=0.01)
    df = spark.createDataFrame([(s, t)], "s double, t double")
    assert values(df, equality.equal(F.col("s"), F.col("t"), T.DoubleType(), rule)) == [(want,)]


def test_timestamp_tolerance(spark):
    rule = ReconRule(keys=("k",), timestamp_seconds=1)
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' s, timestamp_ntz'2024-01-01 00:00:01' t, timestamp_ntz'2024-01-01 00:00:02' u")
    e = lambda a, b: equality.equal(F.col(a), F.col(b), T.TimestampNTZType(), rule)
    assert values(df, e("s", "t"), e("s", "u")) == [(True, False)]


@pytest.mark.parametrize(("s", "t", "kind", "want"), [
    ("a", "a", "string", "EXACT_MATCH"), ("a", "b", "string", "TRUE_MISMATCH"), ("2024-01-01T10:00:00.000000", "2024-01-01 10:00:59+05:30", "timestamp", "FALSE_MISMATCH"),
    ("2024-01-01T10:00:00", "2024-01-01T10:01:00", "timestamp", "TRUE_MISMATCH"), ("9999-12-31", "9999-12-31T00:00:00", "date", "FALSE_MISMATCH"), ("10.0", "10.0000", "numeric", "FALSE_MISMATCH"),
    ("1E+3", "1000", "double", "FALSE_MISMATCH"), ("<NULL>", "1", "int", "TRUE_MISMATCH"), ("", "0", "int", "TRUE_MISMATCH"), ("true", "1", "boolean", "TRUE_MISMATCH")])
def test_semantic_class(spark, s, t, kind, want):
    df = spark.createDataFrame([(s, t)], "s string, t string")
    assert values(df, equality.semantic_class(F.col("s"), F.col("t"), kind, kind)[0]) == [(want,)]


def test_types_have_common_names_and_classes():
    assert classify.type_name("character varying(20)") == classify.type_name("string") == "string"
    assert classify.type_name("numeric(10,2)") == classify.type_name("decimal(12,4)") and classify.type_name("jsonb") == "jsonb"
    assert classify.type_name("jsonb", {"jsonb": "string"}) == "string"
    assert [classify.classify_name(n) for n in ("money", "uuid", "date", "timestamp with time zone", "time", "interval")] == ["NUMERICAL", "CATEGORICAL", "DATE", "TIMESTAMP_WITH_TIME_ZONE", "TIME", "UNSUPPORTED"]
    assert classify.classify(T.DecimalType(10, 2)) == "NUMERICAL" and classify.classify(T.BooleanType()) == "CATEGORICAL"


def test_measures(spark):
    df = spark.createDataFrame([(6.0, 0.0, 17, "2024-01-31", "2024-01-01"), (6.0, 3.0, 76, "bad", None)], "a double, b double, age int, x string, y string")
    got = values(df, measures.safe_ratio(F.col("a"), F.col("b")), measures.age_band(F.col("age")), measures.day_difference(F.col("x"), F.col("y")))
    assert got == [(None, "<=18", 30), (2.0, ">75", None)]
    low, high = values(spark.range(1), *measures.wilson(F.lit(5), F.lit(10)))[0]
    assert low == pytest.approx(0.236593, abs=1e-6) and high == pytest.approx(0.763407, abs=1e-6)
    assert values(spark.createDataFrame([(0.0,), (5.0,), (7.0,), (None,)], "v double"), measures.binned(F.col("v"), [0.0, 5.0, 10.0])) == [("(0, 5]",), ("(0, 5]",), ("(5, 10]",), ("UNKNOWN",)]


def test_recommended_action(spark):
    df = spark.createDataFrame([(2.5, 2.1, 40), (2.5, 1.6, 40), (2.5, None, None), (1.6, 0.5, 9), (1.0, 1.0, 5)], "l double, t double, n long")
    got = [measures.ACTIONS.index(r[0]) for r in values(df, measures.recommended_action(F.col("l"), F.col("t"), F.col("n")))]
    assert got == [0, 1, 1, 2, 3]


def test_iso_weeks_at_year_ends(spark):
    df = spark.sql("select explode(array(date'2024-12-30', date'2021-01-03')) d")
    grains = measures.date_grains(F.col("d"))
    assert values(df, grains["year_week"], grains["year"]) == [("2025-W01", 2024), ("2020-W53", 2021)]


def test_rules_are_validated():
    with pytest.raises(ValueError):
        ReconRule(keys=())
    with pytest.raises(ValueError):
        ReconRule(keys=("k",), numeric_abs=-1)
    assert rules.parse_column_list(" a, b ,,a") == ["a", "b"] and rules.parse_column_list(None) == []
    assert rules.duplicate_labels(["A", "a", "b"]) == ["a"]
    assert rules.selected_tables(["b1", "a1", "a2"], "a.*", "a2") == ["a1"] and rules.selected_tables(["b", "a"], most=1) == ["a"]
    with pytest.raises(ValueError, match="x, y"):
        rules.resolve(["a"], ["x", "A", "y"])


def test_decimal_sums_do_not_overflow(spark):
    big = spark.createDataFrame([(Decimal(9_223_372_036_854_775_807),), (Decimal(9_223_372_036_854_775_807),)], "h decimal(38,0)")
    assert big.agg(F.sum("h")).first()[0] == Decimal(18_446_744_073_709_551_614)


def test_missing_tokens(spark):
    df = spark.createDataFrame([(" ? ",), ("x ",), (None,)], "s string")
    assert values(df, canonical.missing_cleaned(F.col("s"), ("?", ""))) == [(None,), ("x",), (None,)]
    assert dt.date(2024, 1, 1).isoformat() == "2024-01-01"


def test_display_order_puts_the_worst_first(spark):
    from tallyframe.functions.ordering import ROWS_FIRST, for_display, status_rank

    rows = [("b", "PASS"), ("a", "FAIL"), (None, "FAIL"), ("c", None), ("d", "ERROR"), ("a", "COUNTS_ONLY")]
    shown = for_display(spark.createDataFrame(rows, "table_name string, status string"), ["table_name"])
    assert [(r.table_name, r.status, r.display_rank) for r in shown.collect()] == [("d", "ERROR", 1), ("a", "FAIL", 2), (None, "FAIL", 2), ("a", "COUNTS_ONLY", 3), ("b", "PASS", 3), ("c", None, 3)]
    assert [r[0] for r in spark.createDataFrame([("CHANGED",), ("TARGET_ONLY",), ("MATCH",)], "s string").select(status_rank(F.col("s"), ROWS_FIRST)).collect()] == [1, 3, 4]
