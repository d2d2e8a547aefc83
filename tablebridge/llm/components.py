"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablebridge.llm.staging import stage


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root) for every node that has a link; root is one node of its component.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the pointers
    to their ends by doubling, and contracts the links to the ends. The links shrink every round;
    they are gone when every component is one node. All steps are joins of staged tables, whose hot
    keys the adaptive skew join splits; minima are aggregated before the shuffle. The driver reads
    one flag a step. Loops and repeated links are fine, an empty table gives an empty one.
    """
    edges = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while True:
        hooks = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("m"))
        pointers = stage(hooks.select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "hooks")
        if found is not None and pointers.isEmpty():
            return found
        while True:
            ahead = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stage(pointers.join(ahead, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "jumps")
            pointers = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = pointers
        else:
            ends = pointers.select(F.col("node").alias("root"), F.col("root").alias("end"))
            found = stage(found.join(ends, "root", "left").select("node", F.coalesce("end", "root").alias("root")), "roots")
        to = lambda c: pointers.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
        contracted = edges.join(to("a"), "a").join(to("b"), "b").where("ra <> rb")
        edges = stage(contracted.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
