"""Further registered queries: whole comparisons, filters, clean copies that pass, and exports, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .functions.measures import age_band
from .functions.ordering import ROWS_FIRST, for_display
from .operators import duplicates, mining, profile, reconcile, stats
from .plans import analyses
from .queries import DUPLICATES, JOINED, ORDER_KEYS, ORDERS, ORDERS_TOLERANT, T_CUSTOMER, T_ORDERS, customer_pair, lineitem_pair, orders_joined, orders_pair, query, rounded, table
from .rules import ReconRule, TablePair
from .sources.readers import read_csv
from .sources.sinks import inventory, text_safe, write_csv
from .tables import shared_dir

VERDICT = "case when count(*) filter (row_status <> 'MATCH') > 0 then 'FAIL' else 'PASS' end"
COUNTS = """count(sk) source_rows, count(tk) target_rows, count(*) filter (row_status = 'MATCH') match_rows, count(*) filter (row_status = 'CHANGED') changed_rows, count(*) filter (row_status = 'SOURCE_ONLY') source_only_rows,
    count(*) filter (row_status = 'TARGET_ONLY') target_only_rows"""


@query(f"""with {T_ORDERS}, j as (select s.o_orderkey sk, t.o_orderkey tk, case when t.o_orderkey is null then 'SOURCE_ONLY' when s.o_orderkey is null then 'TARGET_ONLY' when s.o_custkey = t.o_custkey and s.o_orderstatus is not distinct from t.o_orderstatus then 'MATCH' else 'CHANGED' end row_status
    from (select * from orders where o_orderkey % 89 <> 0 and o_orderkey % 97 <> 0 and o_orderkey % 101 <> 0) s full join (select * from t_orders where o_orderkey < 10000000 and o_orderkey % 89 <> 0 and o_orderkey % 101 <> 0) t on s.o_orderkey = t.o_orderkey)
    select {COUNTS}, count(*) filter (row_status = 'CHANGED') * 0 tolerant_match_rows, 100.0 * count(*) filter (row_status = 'MATCH') / greatest(count(sk), count(tk), 1) match_percent, {VERDICT} status from j""")
def filtered_tables_agree(spark, sf_dir):
    """Both sides filtered to what was not altered: the verdict is PASS."""
    rule = ReconRule(
        keys=("o_orderkey",), exclude=("o_orderdate", "o_orderpriority", "o_totalprice"), source_where="o_orderkey % 89 <> 0 and o_orderkey % 97 <> 0 and o_orderkey % 101 <> 0",
        target_where="o_orderkey < 10000000 and o_orderkey % 89 <> 0 and o_orderkey % 101 <> 0",
    )
    pair = orders_pair(spark, sf_dir)
    return reconcile.table_summary(reconcile.join_rows(pair, rule), pair, rule)


@query(f"with {JOINED} select {COUNTS}, count(*) filter (row_status = 'CHANGED' and s_c is not distinct from t_c and s_s is not distinct from t_s and abs(s_p - t_p) <= 0.01) tolerant_match_rows, round(100.0 * count(*) filter (row_status = 'MATCH') / greatest(count(sk), count(tk), 1), 4) match_percent, {VERDICT} status from joined")
def full_compare_summary(spark, sf_dir):
    """The summary of a whole comparison, whose sides are scanned once."""
    return rounded(analyses.compare_table(orders_pair(spark, sf_dir), ORDERS_TOLERANT).reports["summary"])


@query("""select 'orders' table_name, count(*) source_count, count(*) target_count, 0::bigint difference, case when count(*) = count(*) then 'MATCH' else 'MISMATCH' end status from orders""")
def count_compare_same(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return stats.count_compare(TablePair(o, o.orderBy("o_custkey"), "orders"))


@query("with " + DUPLICATES + (""" select count(*) filter (source_count > 0) source_duplicate_keys, count(*) filter (source_count > 0) target_duplicate_keys, coalesce(sum(source_count), 0)::bigint source_duplicate_rows,
    coalesce(sum(source_count), 0)::bigint target_duplicate_rows, count(*) filter (source_count > 0) matched_keys, 0::bigint mismatched_keys, 'MATCH' overall_status from d where source_count > 0"""))
def duplicate_summary_same(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = duplicates.duplicate_summary(duplicates.duplicate_reconciliation(TablePair(li, li, "lineitem"), ORDER_KEYS))
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("source_duplicate_rows", "target_duplicate_rows")})


@query(f"""with {T_ORDERS}, r(table_name, status) as (
    select 'orders', case when (select count(*) from (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders except select o_orderkey, o_custkey, o_orderstatus, o_totalprice from t_orders)) > 0 then 'FAIL' else 'PASS' end
    union all select 'customer', 'PASS' union all select 'nowhere', 'ERROR')
    select table_name, status, case status when 'ERROR' then 1 when 'FAIL' then 2 else 3 end display_rank, row_number() over (order by case status when 'ERROR' then 1 when 'FAIL' then 2 else 3 end, table_name) place from r""")
def run_statuses(spark, sf_dir):
    """The statuses of a run over three tables, one of which cannot be compared, as they are shown: worst first."""
    c = table(spark, sf_dir, "customer")
    pairs = {
        "orders": lambda: (orders_pair(spark, sf_dir), ORDERS), "customer": lambda: (TablePair(c, c, "customer"), ReconRule(keys=("c_custkey",))),
        "nowhere": lambda: (TablePair(c, c, "nowhere"), ReconRule(keys=("no_such_key",))),
    }
    _, status = analyses.compare_tables(pairs)
    shown = for_display(spark.createDataFrame(sorted(status.items()), "table_name string, status string"), ["table_name"])
    return shown.withColumn("place", F.row_number().over(Window.orderBy("display_rank", "table_name")).cast("long"))  # a row for each table


@query(f"""with {JOINED}, n as (select row_status, count(*) n_rows, case row_status when 'CHANGED' then 1 when 'SOURCE_ONLY' then 2 when 'TARGET_ONLY' then 3 else 4 end display_rank from joined group by 1) select * from n""")
def status_display(spark, sf_dir):
    return for_display(reconcile.row_status_summary(orders_joined(spark, sf_dir)[0]), ["row_status"], "row_status", ROWS_FIRST)


@query(f"with {T_CUSTOMER} select c_custkey, c_acctbal from t_customer where c_mktsegment is null or c_acctbal is null")
def null_key_rows(spark, sf_dir):
    return reconcile.null_key_rows(customer_pair(spark, sf_dir).target, ["c_mktsegment", "C_ACCTBAL"]).select("c_custkey", "c_acctbal")


@query(f"""with {JOINED}, w as (select k, column_name, row_number() over (partition by column_name order by '{{"o_orderkey":"' || (k::decimal(38, 18))::varchar || '"}}') n from cells where not eq)
    select k::bigint o_orderkey, column_name from w where n <= 7""")
def few_cells_of_each_column(spark, sf_dir):
    joined, pair = orders_joined(spark, sf_dir)
    few = reconcile.changed_cells(reconcile.cell_rows(joined, pair, ORDERS), per_column=7)
    return few.select(F.get_json_object("key_json", "$.o_orderkey").cast("decimal(38,18)").cast("long").alias("o_orderkey"), "column_name")


@query("""select 'o_custkey' column_name, 'sum' stat, (sum(o_custkey)::decimal(38, 0))::varchar "value" from orders union all select 'o_custkey', 'min', (min(o_custkey)::decimal(38, 0))::varchar from orders union all select 'o_custkey', 'max', (max(o_custkey)::decimal(38, 0))::varchar from orders
    union all select 'o_orderkey', 'sum', (sum(o_orderkey)::decimal(38, 0))::varchar from orders union all select 'o_orderkey', 'min', (min(o_orderkey)::decimal(38, 0))::varchar from orders union all select 'o_orderkey', 'max', (max(o_orderkey)::decimal(38, 0))::varchar from orders""")
def decimal_stats(spark, sf_dir):
    """Statistics that keep all digits."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    out = stats.numeric_stats(o, ["o_custkey", "o_orderkey"], decimal=True).where("stat <> 'median'")
    return out.withColumn("value", F.col("value").cast("decimal(38,0)").cast("string"))


@query("""with c as (select case when p_size % 7 = 0 then ' NA ' when p_size % 11 = 0 then '--' when p_size % 13 = 0 then '?' else '  ' || p_brand || ' ' end v from part) select case when trim(v) not in ('?', '', 'NA', 'N/A', 'NULL', 'null', 'None', 'none', '-', '--') then trim(v) end v, count(*) n_rows from c group by 1""")
def missing_tokens(spark, sf_dir):
    size = F.col("p_size")
    v = F.when(size % 7 == 0, " NA ").when(size % 11 == 0, "--").when(size % 13 == 0, "?").otherwise(F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")))
    return mining.clean_missing(table(spark, sf_dir, "part").select(v.alias("v"))).groupBy("v").agg(F.count("*").alias("n_rows"))


@query("select case when p_size <= 18 then '<=18' when p_size <= 30 then '19-30' when p_size <= 45 then '31-45' when p_size <= 60 then '46-60' when p_size <= 75 then '61-75' else '>75' end age_band, count(*) n_rows from part group by 1")
def age_bands(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(age_band(F.col("p_size")).alias("age_band")).agg(F.count("*").alias("n_rows"))


@query("select 'p_type' column_name, coalesce(substr(p_type, 1, 6), '<NULL>') category_value, count(*) n_rows from part group by 2")
def cut_categories(spark, sf_dir):
    return stats.category_counts(table(spark, sf_dir, "part"), ["p_type"], most=6)


@query("""with s as (select o_orderstatus c, count(*) n from orders group by 1) select c o_orderstatus, n - ceil(0.25 * (n - 1))::bigint train_rows, ceil(0.25 * (n - 1))::bigint test_rows from s""")
def stratified_parts(spark, sf_dir):
    """Of each class, a quarter of its rows; which ones, the hash of the key says."""
    train, test = mining.stratified_split(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_orderkey"])
    rows = train.withColumn("t", F.lit(0)).unionByName(test.withColumn("t", F.lit(1)))
    return rows.groupBy("o_orderstatus").agg(F.sum(1 - F.col("t")).alias("train_rows"), F.sum("t").alias("test_rows"))


NAMES = """n_t as (select c_custkey, case when c_custkey % 5 = 0 then '  ' || lower(c_name) || ' ' when c_custkey % 7 = 0 then 'N/A' else c_name end c_name from customer),
    n_j as (select s.c_custkey, case when lower(trim(s.c_name)) = case when t.c_name = 'N/A' then null else lower(trim(t.c_name)) end then 'MATCH' else 'CHANGED' end row_status from customer s join n_t t on s.c_custkey = t.c_custkey)"""


@query(f"with {NAMES} select row_status, count(*) n_rows from n_j group by 1")
def text_rules(spark, sf_dir):
    """Texts compared trimmed, without case, and with words that stand for null."""
    c, k = table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.col("c_custkey")
    name = F.when(k % 5 == 0, F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))).when(k % 7 == 0, "N/A").otherwise(F.col("c_name"))
    rule = ReconRule(keys=("c_custkey",), trim_strings=True, lower_strings=True, null_equivalents=("n/a",))
    return reconcile.row_status_summary(reconcile.join_rows(TablePair(c, c.withColumn("c_name", name), "customer"), rule))


@query(f"""with {T_CUSTOMER} """ + " union all ".join(f"select '{c}' column_name, count({c}) non_null_rows, count(*) - count({c}) null_rows, true near_exact from t_customer" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def full_profile(spark, sf_dir):
    """Nulls and approximate distinct counts in one pass, the latter within a tenth of the exact ones."""
    df = customer_pair(spark, sf_dir).target
    exact = profile.profile_columns(df).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.1 * F.col("exact")
    return profile.full_profile(df).join(exact, "column_name").select("column_name", "non_null_rows", "null_rows", near.alias("near_exact"))


@query(f"""with {JOINED} select 'rows' report, count(*) filter (row_status <> 'MATCH') n_rows, 2 n_columns from joined union all select 'statuses', count(distinct row_status), 2 from joined""")
def report_inventory(spark, sf_dir):
    joined, pair = orders_joined(spark, sf_dir)
    return inventory({"rows": reconcile.row_status_detail(joined, pair, ORDERS), "statuses": reconcile.row_status_summary(joined)})


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ts from events")
def dates_as_text(spark, sf_dir):
    """Times as text for an export; fractions, which engines write in their own ways, are left out."""
    e = table(spark, sf_dir, "events").select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    return text_safe(e)


@query("select o_orderpriority, count(*) n_rows, sum(o_custkey)::bigint sum_custkey, count(*) filter (o_orderstatus is null) no_status from (select o_orderpriority, o_custkey, case when o_orderkey % 101 = 0 then null else o_orderstatus end o_orderstatus from orders) group by 1")
def csv_round_trip(spark, sf_dir):
    """A table written as CSV, all values quoted, and read back."""
    import uuid

    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey", F.when(F.col("o_orderkey") % 101 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    write_csv(o, folder, single=False)
    back: DataFrame = read_csv(spark, folder)
    return back.groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"), F.sum(F.col("o_custkey").cast("long")).alias("sum_custkey"), F.count_if(F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") == "")).alias("no_status"))


@query("""select 'customer' table_name, count(*) n_rows from customer union all select 'part', count(*) from part union all select 'nation', count(*) from nation""")
def profile_many(spark, sf_dir):
    found = analyses.profile_tables({n: (lambda n=n: table(spark, sf_dir, n)) for n in ("customer", "part", "nation")})
    return stats.unioned([r.reports["counts"].select(F.lit(n).alias("table_name"), "n_rows") for n, r in found.items()])


@query(f"""with {T_CUSTOMER}, s as (select count(*) n, count(c_acctbal) a from customer) select report, checks, failures, case when failures > 0 then 'FAIL' else 'PASS' end status from (
    select 'counts' report, 1::bigint checks, ((select count(*) from customer) <> (select count(*) from t_customer))::int::bigint failures)""")
def statistics_verdict(spark, sf_dir):
    """The verdict on counts of a whole statistical comparison."""
    pair = customer_pair(spark, sf_dir)
    return analyses.stats.compare_statistics(pair, ReconRule(keys=("c_custkey",)))["overall"].where("report = 'counts'")


@query("""with d as (select l_orderkey, l_linenumber, count(*) n from lineitem where l_partkey % 5 <> 0 or l_partkey % 50 = 0 group by 1, 2) select count(*) total_rows_keys, sum(n)::bigint total_rows from d""")
def target_key_groups(spark, sf_dir):
    found = reconcile.key_quality(lineitem_pair(spark, sf_dir).target, ORDER_KEYS)
    return found.select(F.col("distinct_keys").alias("total_rows_keys"), "total_rows")
