"""Connected components of a graph of links, by hooking to the smallest neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import narrow_broadcasts, staged


@narrow_broadcasts
def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is the smallest node reachable.

    A round lets each node hook to its smallest neighbour, follows the hooks
    to their ends by doubling, and contracts the links to those ends. Every
    round at least halves the nodes that still have links, so rounds and
    doublings grow with the logarithm of the graph. Hubs cost nothing extra:
    minima combine before the shuffle, and joins to labels have one row per
    node on one side, so that AQE can split the other. The driver gets no side
    of more than 256 KB to broadcast. No links, no rows.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    labels = None
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
        hooks = staged(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")), name)
        while True:
            ends = hooks.where("node <> to").select(F.col("node").alias("to"), F.col("to").alias("end"))
            moving = hooks.join(ends, "to", "left")
            moved = staged(moving.select("node", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")), name)
            hooks = moved.select("node", "to")
            if not moved.where("moved").limit(1).count():
                break
        if labels is None:
            labels = hooks.select("node", F.col("to").alias("component"))
        else:
            labels = labels.join(hooks.select(F.col("node").alias("component"), "to"), "component", "left")
            labels = staged(labels.select("node", F.coalesce("to", "component").alias("component")), name)
        for end in ("a", "b"):
            edges = edges.join(hooks.select(F.col("node").alias(end), F.col("to").alias(f"_{end}")), end)
        edges = edges.select(F.greatest("_a", "_b").alias("a"), F.least("_a", "_b").alias("b")).where("a <> b").distinct()
        edges = staged(edges, name)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
