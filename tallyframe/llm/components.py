"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, the component being its smallest node.

    Alternates large-star (a node hands its larger neighbours to its smallest
    one) and small-star (its smaller neighbours likewise) until no edge
    changes, in a number of rounds that grows with the logarithm of the graph.
    Each round is a minimum per node and an equi-join, so a node with very many
    neighbours is combined before the shuffle and its join can be split. Edges
    with a null end and loops are ignored; an empty table gives no rows.
    """
    now = written(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(f"`{left}` is not null and `{right}` is not null and u <> v").distinct()
    )
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        own = least.select("u", F.col("m").alias("v"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(own.unionByName(small).distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
