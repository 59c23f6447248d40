"""Segments and rules of a target: lift, combinations, ordinal severity, validation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import age_band, binned, day_difference, missing_flag, recommended_action, rule_score, safe_ratio, split_part, wilson
from ..functions.canonical import missing_cleaned
from ..tables import settled
from .cube import grouped_sets, with_medians
from .ranks import cells_of, exact_percentiles, with_percentiles
from .stats import unioned

# Tokens that mean missing in mining input.
MISSING_TOKENS = ("?", "", "NA", "N/A", "NULL", "null", "None", "none", "-", "--")


@dataclass(frozen=True)
class Target:
    """What is mined for: ``mode`` is binary, one_vs_rest, multiclass or ordinal."""

    column: str
    mode: str = "binary"
    positive: str = "Y"
    order: tuple[tuple[str, int], ...] = ()


def clean_missing(df: DataFrame) -> DataFrame:
    """Text columns trimmed, missing-value tokens as null."""
    return df.withColumns({f.name: missing_cleaned(F.col(f"`{f.name}`"), MISSING_TOKENS) for f in df.schema if isinstance(f.dataType, T.StringType)})


def prepare_target(df: DataFrame, target: Target) -> DataFrame:
    """Rows with a target, and ``target_flag`` (int), ``target_class`` (text) or ``target_order`` (int) by mode."""
    c = F.col(f"`{target.column}`")
    text = F.lower(F.trim(c.cast("string")))
    df = df.where(c.isNotNull())
    flag = (text == target.positive.lower()).cast("int")
    if target.mode in ("binary", "one_vs_rest"):
        return df.withColumns({"target_flag": flag, "target_class": F.trim(c.cast("string"))})
    if target.mode == "multiclass":
        return df.withColumn("target_class", F.trim(c.cast("string")))
    if target.mode == "ordinal":
        places = F.create_map(*(F.lit(x) for name, n in target.order for x in (name.lower(), n)))
        return df.withColumns({"target_class": F.trim(c.cast("string")), "target_order": places[text]}).where("target_order is not null")
    raise ValueError(f"unknown target mode {target.mode}")


def domain_features(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Ratios, day differences, bands and missing flags of the roles that are present.

    Roles: amount, premium, insured, start_date, event_date, admission, discharge, age, room_rent.
    """
    have = lambda *r: all(x in roles for x in r)
    c = {r: F.col(f"`{n}`") for r, n in roles.items()}
    new: dict[str, Column] = {}
    if have("amount", "premium"):
        new["amount_to_premium"] = safe_ratio(c["amount"], c["premium"])
    if have("amount", "insured"):
        new["amount_to_insured"] = safe_ratio(c["amount"], c["insured"])
    if have("event_date", "start_date"):
        new["tenure_days"] = day_difference(c["event_date"], c["start_date"])
    if have("discharge", "admission"):
        new["stay_days"] = day_difference(c["discharge"], c["admission"])
    if have("room_rent", "amount"):
        new["room_rent_share"] = safe_ratio(c["room_rent"], c["amount"])
    if have("age"):
        new["age_band"] = age_band(c["age"])
    new |= {f"{n}__missing": missing_flag(F.col(f"`{n}`")) for n in roles.values()}
    return df.withColumns(new)


def feature_types(df: DataFrame, exclude: set[str], numeric: set[str] = frozenset(), categorical: set[str] = frozenset()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names, by type unless a name is forced."""
    names = [f for f in df.schema if f.name not in exclude]
    is_numeric = lambda f: f.name in numeric or (isinstance(f.dataType, T.NumericType) and f.name not in categorical)
    return [f.name for f in names if is_numeric(f)], [f.name for f in names if not is_numeric(f) and not isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.ArrayType))]


def quantile_edges(df: DataFrame, columns: list[str], bins: int = 5) -> dict[str, list[float]]:
    """Exact, distinct quantile edges per column; equal widths if ties leave a single bin."""
    found = exact_percentiles(cells_of(df, columns), ["column_name"], "v", [i / bins for i in range(bins + 1)])
    points = {r["column_name"]: r["q"] for r in found.collect()}  # one row per column
    out = {}
    for c in columns:
        edges = sorted(set(points.get(c, [])))
        if len(edges) == 2 and bins > 1:
            edges = [edges[0] + (edges[1] - edges[0]) * k / bins for k in range(bins + 1)]
        out[c] = edges
    return out


def binned_frame(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Each column of ``edges`` as the text of its right-closed bin, null as UNKNOWN."""
    return df.withColumns({c: binned(F.col(f"`{c}`").cast("double"), e) for c, e in edges.items()})


def feature_cells(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """(feature, value, keep...) of every feature of every row; null is UNKNOWN."""
    cells = F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("UNKNOWN")).alias("value")) for f in features))
    return df.select(*keep, F.explode(cells).alias("c")).select("c.*", *keep)


def with_lift(groups: DataFrame, base: DataFrame) -> DataFrame:
    """Adds rate, lift and the Wilson interval to (records, positives), given a one-row base (all_records, all_positives)."""
    out = groups.crossJoin(F.broadcast(base))  # one row
    rate = F.col("positives") / F.col("records")
    lift = F.try_divide(rate, F.nullif(F.col("all_positives") / F.col("all_records"), F.lit(0.0)))
    low, high = wilson(F.col("positives"), F.col("records"))
    return out.withColumns({"rate": rate, "lift": lift, "support": F.col("records") / F.col("all_records"), "ci_low": low, "ci_high": high}).drop("all_records", "all_positives")


def base_of(df: DataFrame, flag: str = "target_flag") -> DataFrame:
    return df.agg(F.count("*").alias("all_records"), F.sum(flag).alias("all_positives"))


def univariate_lift(df: DataFrame, features: list[str], flag: str = "target_flag") -> DataFrame:
    """Records, positives, rate, lift and interval per feature value, all features in one shuffle."""
    groups = feature_cells(df, features, [flag]).groupBy("feature", "value").agg(F.count("*").alias("records"), F.sum(flag).alias("positives"))
    return with_lift(groups, base_of(df, flag))


def feature_rank(lifts: DataFrame, least: int = 1, near_unique: float = 0.9) -> DataFrame:
    """Features by their largest lift over values of at least ``least`` records; nearly unique ones are dropped."""
    per = lifts.groupBy("feature").agg(F.count("*").alias("values"), F.sum("records").alias("records"), F.max(F.when(F.col("records") >= least, F.col("lift"))).alias("max_lift"))
    return per.where(F.col("values") <= near_unique * F.col("records"))


def numeric_eda(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Per class and column: count, missing, mean, median, standard deviation, extremes and quartiles."""
    rows = cells_of(df.withColumn("class", F.col(f"`{by}`")), columns, ("class",))
    keys = ["class", "column_name"]
    out = rows.groupBy(*keys).agg(F.count("v").alias("count"), F.count_if(F.col("v").isNull()).alias("missing"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    return with_percentiles(out, exact_percentiles(rows, keys, "v", [0.25, 0.5, 0.75]), keys, ["p25", "median", "p75"])


def item_arrays(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """(keep..., items): each row's items (place of the feature, its value; null is UNKNOWN) in the order of ``features``."""
    items = F.array(*(F.struct(F.lit(i).alias("f"), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("UNKNOWN")).alias("v")) for i, f in enumerate(features)))
    return df.select(*keep, items.alias("items"))


class SetTable:
    """Which item sets may be frequent, in a fixed number of slots: a set that is has its slot marked, one that is not may share it."""

    def __init__(self, frequent: DataFrame, most_slots: int):
        # About 64 slots for each set, as long as the table stays in its bound.
        self.slots = min(most_slots, 1 << (64 * max(64, frequent.count())).bit_length())
        marks = bytearray(self.slots)
        for r in frequent.select(self.slot(F.col("items")).alias("s")).distinct().collect():  # at most a row for each slot
            marks[r["s"]] = 1
        self.marks = F.lit(marks)

    def slot(self, items: Column) -> Column:
        return F.pmod(F.xxhash64(items), F.lit(self.slots)).cast("int")

    def may_have(self, items: Column) -> Column:
        return F.substring(self.marks, self.slot(items) + 1, 1) == F.lit(bytearray([1]))


def candidate_sets(items: Column, tables: list[SetTable]) -> Column:
    """All item sets of a row with one item more than those of the last table, of which every subset with one item less may be frequent.

    Sets grow by an item of a later feature, from sets that may be frequent themselves.
    """
    if not tables:
        return F.transform(items, lambda x: F.array(x))
    # A transform over one element holds the items that may be frequent, so that they are looked up once.
    items = F.filter(items, lambda x: tables[0].may_have(F.array(x)))
    return F.get(F.transform(F.array(items), lambda own: larger_sets(own, tables)), F.lit(0))


def larger_sets(items: Column, tables: list[SetTable]) -> Column:
    """``candidate_sets`` of items that may all be frequent: pairs need no look, larger sets one for each subset."""
    later = lambda i: F.slice(items, i + 2, F.size(items))
    sets = F.flatten(F.transform(items, lambda x, i: F.transform(later(i), lambda y: F.array(x, y))))
    for k, table in enumerate(tables[1:], 2):
        sets = F.flatten(F.transform(F.filter(sets, table.may_have), growing(items, k, table)))
    return sets


def growing(items: Column, k: int, table: SetTable) -> Callable[[Column], Column]:
    return lambda s: grown(s, items, k, table)


def grown(s: Column, items: Column, k: int, table: SetTable) -> Column:
    """A set of ``k`` items with each later item, if the sets that have it instead of another one are in the table too."""
    later = F.filter(items, lambda y: y["f"] > F.get(s, F.lit(k - 1))["f"])
    subsets = lambda y: [F.concat(F.slice(s, 1, m), F.slice(s, m + 2, k), F.array(y)) for m in range(k)]
    fit = F.filter(later, lambda y: reduce(lambda a, b: a & b, (table.may_have(x) for x in subsets(y))))
    return F.transform(fit, lambda y: F.concat(s, F.array(y)))


def frequent_sets(df: DataFrame, features: list[str], flag: str, length: int, least_records: int, slots: int = 1 << 20) -> list[DataFrame]:
    """For 1 to ``length`` items: (items, records, positives) of the item sets found in ``least_records`` rows or more.

    Level by level: a set can be frequent only if its subsets are, so a row is
    expanded only to sets whose subsets with one item less are all marked in the table
    of the level before. Tables have ``slots`` bytes however many sets there
    are, and hold no set back: counts are of the sets themselves, and exact.
    Rows that agree in all features are counted first, combined before the shuffle, and expanded as one.
    """
    named = df.select(F.col(flag).alias("_flag"), *(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("UNKNOWN")).alias(f"_{i}") for i, f in enumerate(features)))
    alike = named.groupBy(*(f"_{i}" for i in range(len(features)))).agg(F.count("*").alias("n"), F.sum("_flag").alias("p"))
    rows, levels, tables = settled(item_arrays(alike, [f"_{i}" for i in range(len(features))], ["n", "p"])), [], []
    for k in range(1, min(length, len(features)) + 1):
        sets = F.transform("items", lambda x: F.array(x)) if k == 1 else candidate_sets(F.col("items"), tables)
        counted = rows.select("n", "p", F.explode(sets).alias("items")).groupBy("items").agg(F.sum("n").alias("records"), F.sum("p").alias("positives"))
        levels.append(settled(counted.where(F.col("records") >= least_records)))
        if k < length:
            if levels[-1].isEmpty():
                break
            tables.append(SetTable(levels[-1], slots))
    return levels


def combination_rules(
    df: DataFrame, features: list[str], flag: str = "target_flag", length: int = 3, least_records: int = 30, least_rate: float = 0.0, least_lift: float = 1.0, per_level: int = 5000,
    prune: bool = False, least_positives: int = 0,
) -> DataFrame:
    """Rules of up to ``length`` features with enough records, positives, rate and lift, best score first.

    Item sets are counted level by level (``frequent_sets``). With ``prune`` a
    longer set counts only if each of its features gave a rule of its own.
    ``items`` holds the conditions as ``feature=value``.
    """
    base = base_of(df, flag)
    alive, levels = list(features), []
    named = lambda item: F.element_at(F.array(*map(F.lit, features)), item["f"] + 1)
    for k, groups in enumerate(frequent_sets(df, features, flag, length, least_records), 1):
        if k > 1 and prune:
            groups = groups.where(F.forall("items", lambda x: named(x).isin(alive)))
        good = (F.col("rate") >= least_rate) & (F.col("lift") >= least_lift) & (F.col("positives") >= least_positives)
        rated = with_lift(groups, base).where(good)
        texts = lambda sep: F.transform("items", lambda x: F.concat(named(x), F.lit(sep), x["v"]))
        score = rule_score(F.col("lift"), F.col("rate"), F.col("records"), F.col("positives"))
        rules = rated.select(
            F.lit(k).alias("rule_length"), F.array_join(F.transform("items", named), " | ").alias("features"), F.array_join(texts(" = "), " AND ").alias("rule"), texts("=").alias("items"),
            "records", "positives", "rate", "lift", "support", "ci_low", "ci_high", score.alias("score"),
        )
        rules = rules.orderBy(F.desc("score"), F.desc("lift"), F.desc("records"), "rule").limit(per_level)
        levels.append(rules)
        if prune and k == 1:
            kept = {r["features"] for r in rules.select("features").distinct().collect()}  # at most one row per feature
            alive = [f for f in features if f in kept]
    return unioned(levels)


def multiclass_rules(df: DataFrame, features: list[str], length: int = 2, least_records: int = 30, least_lift: float = 1.0) -> DataFrame:
    """Rules for every class of ``target_class``: records, class records, rate and lift against the class's base rate."""
    sets = [s for k in range(1, length + 1) for s in combinations(features, k)]
    named = df.select("target_class", *(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("UNKNOWN")).alias(f) for f in features))
    per_class = grouped_sets(named, sets, [F.count("*").alias("positives")], keep=("target_class",))
    # A group's rows are the sum of its classes': features that are not in a set are null in it, so they tell the groups apart.
    per_class = per_class.withColumn("records", F.sum("positives").over(Window.partitionBy(*features)))
    base = named.groupBy("target_class").agg(F.count("*").alias("class_records"))
    total = named.agg(F.count("*").alias("all_records"))
    out = per_class.join(base, "target_class").crossJoin(F.broadcast(total))  # one row
    rate = F.col("positives") / F.col("records")
    out = out.withColumns({"rate": rate, "lift": rate / (F.col("class_records") / F.col("all_records"))})
    return out.where((F.col("records") >= least_records) & (F.col("lift") >= least_lift)).select("target_class", F.col("dims").alias("features"), F.col("dim_values").alias("values"), "records", "positives", "rate", "lift")


def ordinal_severity(df: DataFrame, features: list[str], length: int = 2, least_records: int = 30) -> DataFrame:
    """Per combination: records, mean and median order, and the index against the portfolio mean."""
    sets = [s for k in range(1, length + 1) for s in combinations(features, k)]
    groups = grouped_sets(df, sets, [F.count("*").alias("records"), F.avg("target_order").alias("mean_order")])
    groups = with_medians(groups.where(F.col("records") >= least_records), df, sets, F.col("target_order")).withColumnRenamed("median", "median_order")
    whole = df.agg(F.avg("target_order").alias("portfolio_mean"))
    out = groups.crossJoin(F.broadcast(whole))  # one row
    return out.select(F.col("dims").alias("features"), F.col("dim_values").alias("values"), "records", "mean_order", F.col("median_order").cast("double").alias("median_order"), (F.col("mean_order") / F.col("portfolio_mean")).alias("severity_index"))


def class_base_rates(df: DataFrame) -> DataFrame:
    total = df.agg(F.count("*").alias("n"))
    return df.groupBy("target_class").agg(F.count("*").alias("records")).crossJoin(F.broadcast(total)).select("target_class", "records", (F.col("records") / F.col("n")).alias("base_rate"))  # one row


def apply_rules(df: DataFrame, rules: DataFrame, features: list[str], keep: list[str], broadcast_rows: int = 100_000) -> DataFrame:
    """(rule, keep...) for every row and rule that it satisfies.

    Rows join rules on the rule's first item, then all items must be among the
    row's. Rules are counted first and broadcast up to ``broadcast_rows``; more of
    them are joined by a shuffle.
    """
    items = F.array(*(F.concat(F.lit(f"{f}="), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("UNKNOWN"))) for f in features))
    rows = df.select(*keep, items.alias("_items")).select(*keep, "_items", F.explode("_items").alias("_first"))
    wanted = rules.select("rule", F.col("items").alias("_wanted"), F.element_at("items", 1).alias("_first"))
    small = wanted.limit(broadcast_rows + 1).count() <= broadcast_rows
    return rows.join(F.broadcast(wanted) if small else wanted, "_first").where(F.size(F.array_except("_wanted", "_items")) == 0).select("rule", *keep)


def split_rows(df: DataFrame, ids: list[str], parts: int = 4, test_part: int = 0, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test), by a hash of the id."""
    part = split_part([F.col(f"`{c}`") for c in ids], parts, seed)
    return df.where(part != test_part), df.where(part == test_part)


def stratified_split(df: DataFrame, by: str, ids: list[str], share: float = 0.25, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test): of each class of ``by``, as nearly ``share`` of its rows as ties of the id's hash allow go to the test side.

    Rows are ordered by the hash of their id; the hash at ``share`` of each class
    is found by ``exact_percentiles`` and compared with each row, so no class
    is sorted in one task. The same rows are chosen every time.
    """
    draw = (F.pmod(F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in ids)), F.lit(1 << 52))).cast("double")
    drawn = df.withColumns({"_draw": draw, "_class": F.col(f"`{by}`")})
    cut = exact_percentiles(drawn, ["_class"], "_draw", [share]).select(F.col("_class").alias("_of"), F.col("q")[0].alias("_cut"))
    placed = drawn.join(cut, F.col("_class").eqNullSafe(F.col("_of")))
    pick = lambda test: placed.where(F.col("_draw") < F.col("_cut") if test else F.col("_draw") >= F.col("_cut")).select(*(df[c] for c in df.columns))
    return pick(False), pick(True)


def stratified_sample(df: DataFrame, by: str, fractions: dict, seed: int = 0) -> DataFrame:
    return df.sampleBy(by, fractions, seed)


def scaled_thresholds(least_records: int, least_positives: int, test_share: float) -> tuple[int, int]:
    """Thresholds for rules that are mined on the training share of rows only."""
    return max(5, int(least_records * (1 - test_share))), max(2, int(least_positives * (1 - test_share)))


def validate_rules(rules: DataFrame, test: DataFrame, features: list[str], flag: str = "target_flag", most: int | None = None) -> DataFrame:
    """Records, positives, rate and lift of each rule (of the ``most`` best by score, if given) on rows it was not mined on, the drop of its rate, and the recommended action."""
    if most:
        rules = settled(rules.orderBy(F.desc("score"), F.desc("lift"), F.desc("records"), "rule").limit(most))
    hits = apply_rules(test, rules, features, [flag]).groupBy("rule").agg(F.count("*").alias("records"), F.sum(flag).alias("positives"))
    tested = with_lift(hits, base_of(test, flag)).select("rule", F.col("records").alias("test_records"), F.col("positives").alias("test_positives"), F.col("rate").alias("test_rate"), F.col("lift").alias("test_lift"))
    out = rules.join(tested, "rule", "left")
    return out.withColumn("rate_drop", F.col("rate") - F.col("test_rate")).withColumn("recommended_action", recommended_action(F.col("lift"), F.col("test_lift"), F.col("test_records")))
