"""Connected components of a link table, by contraction.

Each round every node hooks onto its smallest smaller neighbour, the hooks
are flattened by pointer jumping, and the links are contracted onto the
roots; rounds end when no link joins two roots. Every step is a join or a
pre-aggregated minimum over written tables, so a hub's links can be split by
Spark's skew-join handling and never meet in one task's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.scratch import Scratch


def _flatten(hooks: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, to`` with ``to`` replaced by the end of its chain."""
    while True:
        up = hooks.select(F.col("id").alias("_via"), F.col("to").alias("_up"))
        jumped = scratch.keep(
            hooks.select("id", "to").join(up, F.col("to") == F.col("_via"), "left")
                 .select("id", F.coalesce("_up", "to").alias("to"), F.col("_up").isNotNull().alias("moved")), "jump")
        scratch.drop(hooks)
        hooks = jumped
        if hooks.where("moved").isEmpty():
            return hooks


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root`` for every node that occurs in a link between two different
    nodes; ``root`` is the smallest node reachable. Null ends and self links
    are ignored; nodes without links are not listed."""
    edges = scratch.keep(links.where(F.col(a) != F.col(b))
                         .select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct(), "links")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        hooks = scratch.keep(edges.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("to")), "hooks")
        level = _flatten(hooks, scratch)
        levels.append(level.select("id", "to"))
        lo = level.select(F.col("id").alias("lo"), F.col("to").alias("lo_to"))
        hi = level.select(F.col("id").alias("hi"), F.col("to").alias("hi_to"))
        moved = (edges.join(lo, "lo", "left").withColumn("lo", F.coalesce("lo_to", "lo"))
                      .join(hi, "hi").withColumn("hi", F.col("hi_to")).where(F.col("lo") != F.col("hi"))
                      .select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).distinct())
        contracted = scratch.keep(moved, "contracted")
        scratch.drop(edges)
        edges = contracted
    if not levels:
        return edges.select(F.col("hi").alias("id"), F.col("lo").alias("root"))
    out = levels[0]
    for level in levels[1:]:
        nxt = level.select(F.col("id").alias("_r"), F.col("to").alias("_t"))
        out = (out.join(nxt, F.col("to") == F.col("_r"), "left")
                  .select("id", F.coalesce("_t", "to").alias("to"))
                  .unionByName(level))
    out = scratch.keep(out.select("id", F.col("to").alias("root")), "members")
    return out.unionByName(out.select(F.col("root").alias("id"), "root").distinct())
