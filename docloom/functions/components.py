"""Connected components of an edge table, by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.shared import kept


def components(edges: DataFrame, a: str = "a", b: str = "b", most_depth: int = 60) -> DataFrame:
    """node, component (its smallest node) of every node that an edge names.

    Every node hooks on the smallest node around it; pointers are jumped until
    all lead to the root of their tree, which takes the logarithm of its depth;
    roots that edges still tie are one node each in the next, at most half as
    large step.  Hooks are minima, a map-side combined aggregate: no
    neighbourhood is ever collected, and a hub costs one row per task.  Each
    step is written to the shared checkpoint folder.  Null ends and loops are
    ignored; an empty table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v")
    return _solved(kept(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()), most_depth)


def _solved(e: DataFrame, depth: int) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")))
    for _ in range(depth):
        up = labels.select(F.col("u").alias("l"), F.col("l").alias("ll"))
        jumped = kept(labels.join(up, "l").select("u", F.col("ll").alias("l"), (F.col("ll") != F.col("l")).alias("moved")))
        if jumped.where("moved").isEmpty():
            break
        labels = jumped.select("u", "l")
    else:
        raise RuntimeError("components did not settle")
    at = lambda c, l: labels.select(F.col("u").alias(c), F.col("l").alias(l))
    rest = kept(e.join(at("u", "lu"), "u").join(at("v", "lv"), "v").where("lu != lv").select(F.greatest("lu", "lv").alias("u"), F.least("lu", "lv").alias("v")).distinct())
    if rest.isEmpty():
        return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))
    up = _solved(rest, depth - 1)
    return labels.join(up.select(F.col("node").alias("l"), "component"), "l", "left").select(F.col("u").alias("node"), F.coalesce("component", "l").alias("component"))
