"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps (Kiveris et al., 2014) are one pre-aggregated minimum per node and one
join back, so that a node with very many neighbours is never gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartulary.llm.shared import drop_stash, stash


def settled(edges: DataFrame) -> bool:
    """Whether the edges (a, b) are stars: every a has one b, and no b is an a."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return edges.select("b").join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root): every node that has an edge to another node, and the least node it reaches.

    Self-loops, repeated edges and either direction are accepted; an empty table gives an empty result.
    """
    e = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where("a <> b").distinct()
    e = stash(e, "edges")
    for _ in range(max_rounds):
        if settled(e):
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stash(large, "large-star")
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(root.select("a", F.col("m").alias("b")))
            .distinct()
        )
        before, e = e, stash(small, "small-star")
        drop_stash(before, large)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
