"""Rules and scores from models: association rules, decision trees, risk bands."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import bin_edges, bin_number
from ..sources.readers import quoted
from . import metrics
from .mining import base_of, frequent_sets, quantile_edges, with_lift
from .stats import unioned


def association_rules(df: DataFrame, features: list[str], target: str, value: str, support: float = 0.02, confidence: float = 0.35, lift: float = 1.3, longest: int = 4) -> DataFrame:
    """Frequent-pattern rules that end in ``target = value``: support, confidence, lift, leverage, conviction.

    Antecedents are item sets ``feature=value``, counted level by level
    (``frequent_sets``) from rows that agree in all features, which are combined before the shuffle: no
    task or cache holds baskets of single rows. A rule is frequent if rows with
    its antecedent and the consequent are ``support`` of all, so its antecedent is too.
    """
    flag = (F.coalesce(F.col(f"`{target}`").cast("string"), F.lit("UNKNOWN")) == str(value)).cast("int")
    rows = df.select(*(F.col(f"`{f}`") for f in features), flag.alias("_rule_flag"))
    whole = rows.agg(F.count("*").alias("n"), F.sum("_rule_flag").alias("p")).first()
    total, least = whole["n"], math.ceil(support * whole["n"])
    found = unioned(frequent_sets(rows, features, "_rule_flag", max(longest - 1, 1), least)).where(F.size("items") < longest)
    text = lambda x: F.concat(F.element_at(F.array(*(F.lit(f"{f}=") for f in features)), x["f"] + 1), x["v"])
    sc, n, together = F.lit((whole["p"] or 0) / max(total, 1)), F.col("records").cast("double"), F.col("positives").cast("double")
    rated = found.withColumns({"support": together / total, "confidence": together / n}).withColumn("lift", F.try_divide("confidence", sc))
    rules = rated.where((F.col("positives") >= max(least, 1)) & (F.col("confidence") >= confidence) & (F.col("lift") >= lift))
    return rules.select(
        F.array_join(F.array_sort(F.transform("items", text)), " AND ").alias("rule"), F.lit(f"{target}={value}").alias("consequent"), "support", "confidence", "lift",
        (F.col("support") - n / total * sc).alias("leverage"), F.try_divide(1 - sc, F.nullif(1 - F.col("confidence"), F.lit(0.0))).alias("conviction"),
    )


RARE = "INFREQUENT"


def frequent_values(df: DataFrame, columns: list[str], least: float) -> dict[str, list[str]]:
    """The values of each column that make up ``least`` of its rows or more, most frequent first: at most ``1 / least`` of each column."""
    cells = F.array(*(F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns))
    counts = df.select(F.explode(cells).alias("x")).select("x.*").where("v is not null").groupBy("c", "v").agg(F.count("*").alias("n"))
    total = df.agg((F.lit(least) * F.count("*")).alias("least"))
    rows = counts.crossJoin(F.broadcast(total)).where("n >= least").orderBy("c", F.desc("n"), "v").collect()  # one row to join with
    return {c: [r["v"] for r in rows if r["c"] == c] for c in columns}


def prepared(df: DataFrame, numeric: list[str], kept: dict[str, list[str]], flag: str) -> DataFrame:
    """Doubles for numbers; categories that are missing as the most frequent one, rare ones as ``RARE``; weights that balance the classes."""
    base = df.agg(F.count("*").alias("__n"), F.sum(flag).alias("__p"))
    text = lambda c, values: F.when(F.col(f"`{c}`").isNull(), values[0] if values else RARE).when(F.col(f"`{c}`").cast("string").isin(values), F.col(f"`{c}`").cast("string")).otherwise(RARE)
    df = df.withColumns({**{c: F.col(f"`{c}`").cast("double") for c in numeric}, **{c: text(c, values) for c, values in kept.items()}})
    own = F.when(F.col(flag) == 1, F.col("__p")).otherwise(F.col("__n") - F.col("__p"))
    return df.crossJoin(F.broadcast(base)).withColumn("__weight", F.col("__n") / (2.0 * own)).drop("__n", "__p")  # one row


def fit_tree(df: DataFrame, numeric: list[str], categorical: list[str], flag: str = "target_flag", depth: int = 5, least: int = 1, seed: int = 7, least_share: float = 0.01) -> tuple[object, dict[str, list[str]]]:
    """A fitted pipeline (median imputation, one column for each frequent value, tree on balanced weights) and the values kept of each category.

    Values below ``least_share`` of the rows are one, so a category of any
    number of values gives at most ``1 / least_share`` inputs and one more.
    """
    kept = frequent_values(df, categorical, least_share) if categorical else {}
    stages: list = []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}__num" for c in numeric]))
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__hot", handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=[*(f"{c}__num" for c in numeric), *(f"{c}__hot" for c in categorical)], outputCol="__features"))
    stages.append(DecisionTreeClassifier(featuresCol="__features", labelCol=flag, weightCol="__weight", maxDepth=depth, minInstancesPerNode=least, maxBins=128, seed=seed))
    return Pipeline(stages=stages).fit(prepared(df, numeric, kept, flag)), kept


def tree_inputs(fitted, numeric: list[str]) -> list[tuple[str, str | None]]:
    """(column, value) of each input of the tree; no value for numbers, null for what was not among the values."""
    indexers = [s for s in fitted.stages if hasattr(s, "labels")]
    hot = [s for s in fitted.stages if hasattr(s, "categorySizes")]
    out: list[tuple[str, str | None]] = [(c, None) for c in numeric]
    for index, wide in zip(indexers, hot, strict=True):
        labels = [*index.labels, *[RARE] * (wide.categorySizes[0] - len(index.labels))]
        out += [(index.getInputCol(), v) for v in labels]
    return out


@dataclass(frozen=True)
class Condition:
    """One step on the way to a leaf: a number beside a threshold, or a category that is, or is not, a value."""

    column: str
    holds: bool
    threshold: float | None = None
    value: str | None = None

    def test(self) -> Column:
        c = F.col(quoted(self.column))
        found = c <= self.threshold if self.value is None else c == F.lit(self.value)
        return found if self.holds else ~found

    def __str__(self) -> str:
        if self.value is None:
            return f"{self.column} {'<=' if self.holds else '>'} {self.threshold!r}"
        return f"{self.column} {'=' if self.holds else '<>'} " + "'" + self.value.replace("'", "''") + "'"


def leaf_paths(model: DecisionTreeClassificationModel, inputs: list[tuple[str, str | None]]) -> list[list[Condition]]:
    """The conditions to each leaf, leaves in the order of the model's own numbers, from its nodes."""
    paths: list[list[Condition]] = []
    stack = [(model._java_obj.rootNode(), [])]
    while stack:
        node, path = stack.pop()
        if node.subtreeDepth() == 0:
            paths.append(path)
            continue
        split = node.split()
        name, value = inputs[split.featureIndex()]
        if value is None:
            left, right = (Condition(name, holds, split.threshold()) for holds in (True, False))
        else:  # the input is 1 where the column has the value, else 0
            has = 1.0 in list(split.leftCategories()) if split.getClass().getSimpleName() == "CategoricalSplit" else split.threshold() >= 1.0
            left, right = Condition(name, has, value=value), Condition(name, not has, value=value)
        stack += [(node.rightChild(), [*path, right]), (node.leftChild(), [*path, left])]  # the left child is next
    return paths


def tree_leaves(df: DataFrame, numeric: list[str], categorical: list[str], flag: str = "target_flag", depth: int = 4, least: int = 20) -> tuple[DataFrame, list[list[Condition]]]:
    """The rows that a tree fitted on them sees (numbers filled in, rare values as one), with their ``leaf``, and the way to each leaf."""
    fitted, kept = fit_tree(df, numeric, categorical, flag, depth, least)
    tree = fitted.stages[-1]
    tree.setLeafCol("leaf")
    scored = fitted.transform(prepared(df, numeric, kept, flag))
    rows = scored.withColumns({**{c: F.col(f"{c}__num") for c in numeric}, "leaf": F.col("leaf").cast("int")})
    return rows.select(*df.columns, "__weight", "leaf"), leaf_paths(tree, tree_inputs(fitted, numeric))


def tree_rules(df: DataFrame, numeric: list[str], categorical: list[str], flag: str = "target_flag", depth: int = 4, least: int = 20) -> DataFrame:
    """One row per leaf: its path, records, weighted records and positives, class, rate and lift, counted on all rows in one aggregation."""
    rows, paths = tree_leaves(df, numeric, categorical, flag, depth, least)
    weight = F.col("__weight")
    groups = rows.groupBy("leaf").agg(F.count("*").alias("records"), F.sum(flag).alias("positives"), F.sum(weight).alias("weighted_records"), F.sum(weight * F.col(flag)).alias("weighted_positives"))
    groups = groups.withColumn("predicted_class", (F.col("weighted_positives") > F.col("weighted_records") - F.col("weighted_positives")).cast("int"))
    texts = df.sparkSession.createDataFrame([(i, " AND ".join(map(str, p))) for i, p in enumerate(paths)], "leaf int, rule string")
    return with_lift(groups, base_of(df, flag)).join(F.broadcast(texts), "leaf", "left")  # a row for each leaf


def scored_rows(df: DataFrame, numeric: list[str], categorical: list[str], flag: str = "target_flag", depth: int = 5) -> DataFrame:
    """``df`` with the tree's probability of the positive class (``score``) and ``predicted``."""
    fitted, kept = fit_tree(df, numeric, categorical, flag, depth)
    out = fitted.transform(prepared(df, numeric, kept, flag))
    return out.select(*df.columns, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("predicted"))


def confusion(scored: DataFrame, flag: str = "target_flag") -> DataFrame:
    return scored.groupBy(F.col(flag).alias("actual"), "predicted").agg(F.count("*").alias("records"))


def areas(scored: DataFrame, flag: str = "target_flag") -> dict[str, float]:
    """Exact areas under the ROC and precision-recall curves, by their usual names (``metrics.areas``)."""
    row = metrics.areas(scored, flag).first()
    return {"areaUnderROC": row["roc_auc"], "areaUnderPR": row["pr_auc"]}


def class_performance(scored: DataFrame, flag: str = "target_flag") -> DataFrame:
    """Per class: actual, predicted and correct rows, recall, precision, mean score."""
    pairs = F.array(F.struct(F.col(flag).alias("class"), F.lit(1).alias("a"), F.lit(0).alias("p")), F.struct(F.col("predicted").alias("class"), F.lit(0).alias("a"), F.lit(1).alias("p")))
    rows = scored.select(F.explode(pairs).alias("x"), (F.col(flag) == F.col("predicted")).alias("hit"), "score").select("x.*", "hit", "score")
    out = rows.groupBy("class").agg(F.sum("a").alias("actual"), F.sum("p").alias("predicted"), F.count_if(F.col("hit") & (F.col("a") == 1)).alias("correct"), F.avg(F.when(F.col("a") == 1, F.col("score"))).alias("mean_score"))
    return out.withColumns({"recall": F.try_divide("correct", "actual"), "precision": F.try_divide("correct", "predicted")})


def risk_bands(scored: DataFrame, bands: int = 10, flag: str = "target_flag") -> DataFrame:
    """Score bands by quantile, numbered from the lowest (ties stay together): exact edges, records, positives, extremes and mean of the score, rate, lift."""
    edges = quantile_edges(scored, ["score"], bands)["score"]
    numbered = scored.withColumn("band", bin_number(F.col("score"), edges))
    groups = numbered.groupBy("band").agg(F.count("*").alias("records"), F.sum(flag).alias("positives"), F.avg("score").alias("mean_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))
    low, high = bin_edges(F.col("band"), edges)
    return with_lift(groups.withColumns({"lower_edge": low, "upper_edge": high}), base_of(scored, flag))
