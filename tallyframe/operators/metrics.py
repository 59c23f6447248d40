"""Exact measures of a scored frame: areas under curves from cumulative counts, and the class report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discarded, settled
from .ranks import running_sums


def curve_points(scored: DataFrame, flag: str = "target_flag", score: str = "score") -> tuple[DataFrame, DataFrame]:
    """(rows, table to discard): per distinct score, highest first, the rows and positives with it, above it, and in all.

    Rows with the same score are one point, counted before the shuffle; running
    sums over range partitions give what lies above, whatever the number of scores.
    """
    counted = scored.where(F.col(score).isNotNull() & F.col(flag).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(F.count("*").alias("n"), F.sum(flag).cast("long").alias("p"))
    return running_sums(counted.withColumn("g", F.lit(0)), ["g"], [F.desc("score")], ["n", "p"])


def areas(scored: DataFrame, flag: str = "target_flag", score: str = "score") -> DataFrame:
    """One row: records, positives, and the exact areas: ROC (a tie counts half), precision-recall by average precision, and by trapezoids.

    Null without records of both classes.
    """
    points, held = curve_points(scored, flag, score)
    p, n = F.col("p"), F.col("n")
    above_p, above_n = F.col("p_before"), F.col("n_before")
    precision, before = (above_p + p) / (above_n + n), F.when(above_n > 0, above_p / above_n).otherwise(F.lit(1.0))
    row = points.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.coalesce(F.sum("p"), F.lit(0)).alias("positives"),
        # A negative has above it the positives of higher scores, and half of those of its own.
        F.sum(((n - p) * (above_p + p / 2)).cast("double")).alias("_pairs"), F.sum(p * precision).alias("_steps"), F.sum(p * (precision + before) / 2).alias("_slopes"),
    )
    positives, negatives = F.nullif(F.col("positives"), F.lit(0)), F.nullif(F.col("records") - F.col("positives"), F.lit(0))
    out = settled(row.select(
        "records", "positives", (F.col("_pairs") / positives / negatives).alias("roc_auc"),
        F.when(negatives.isNotNull(), F.col("_steps") / positives).alias("average_precision"), F.when(negatives.isNotNull(), F.col("_slopes") / positives).alias("pr_auc"),
    ))
    discarded(held)
    return out


def class_report(scored: DataFrame, flag: str = "target_flag", predicted: str = "predicted") -> DataFrame:
    """Per class, and as macro and weighted means: precision, recall, F1 and support; and the accuracy.

    A share of nothing is 0. One grouping by pairs of actual and predicted class; all else is read from those counts.
    """
    pairs = scored.groupBy(F.col(flag).cast("string").alias("actual"), F.col(predicted).cast("string").alias("guess")).agg(F.count("*").alias("n"))
    sides = F.array(F.struct(F.col("actual").alias("class"), F.lit(1).alias("a")), F.struct(F.col("guess").alias("class"), F.lit(0).alias("a")))
    tagged = pairs.select(F.explode(sides).alias("x"), (F.col("actual") == F.col("guess")).alias("hit"), "n").select("x.*", "hit", "n")
    per = tagged.groupBy("class").agg(
        F.sum(F.col("n") * F.col("a")).alias("support"), F.sum(F.col("n") * (1 - F.col("a"))).alias("guessed"), F.sum(F.when(F.col("hit") & (F.col("a") == 1), F.col("n")).otherwise(0)).alias("correct")
    )
    share = lambda a, b: F.coalesce(F.try_divide(a, F.nullif(b, F.lit(0))), F.lit(0.0))
    per = per.withColumns({"precision": share(F.col("correct"), F.col("guessed")), "recall": share(F.col("correct"), F.col("support"))})
    per = per.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    columns = ("precision", "recall", "f1")
    mean = lambda name, f: per.agg(F.lit(name).alias("class"), *(f(c).alias(c) for c in columns), F.sum("support").alias("support"))
    weighted = mean("weighted avg", lambda c: share(F.sum(F.col(c) * F.col("support")), F.sum("support")))
    accuracy = share(F.sum("correct"), F.sum("support"))
    whole = per.agg(F.lit("accuracy").alias("class"), *(accuracy.alias(c) for c in columns), F.sum("support").alias("support"))
    own = per.select("class", *columns, "support")
    return own.unionByName(mean("macro avg", F.avg)).unionByName(weighted).unionByName(whole)
