"""Connected components by alternating large-star and small-star steps, each an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import scratch, staged

ROUNDS = 40


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Of links (a, b): rows (node, label) for each node that has one, label the least node of its component.

    Large star: each node links its larger neighbours to its least one; small star: its smaller neighbours
    and itself. The number of rounds grows with the logarithm of the longest path. Edges stay one for each
    node and step at most two for each edge; the label tables are written to the shared folder, and only
    the result stays there.
    """
    with scratch(edges.sparkSession):
        now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
        mark = _mark(now)
        for _ in range(ROUNDS):
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "components-least")
            large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = staged(large.distinct(), "components-large")
            least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "components-least")
            small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
            now = staged(small.distinct(), "components")
            after = _mark(now)
            if after == mark:
                roots = now.select(F.col("v").alias("node")).distinct()
                return staged(now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.select("node", F.col("node").alias("label"))), "components-labels", keep=True)
            mark = after
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
