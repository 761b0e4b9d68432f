"""Connected components by contraction, as joins of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.tables import store


def components(links: DataFrame) -> DataFrame:
    """Smallest number reachable from each end of ``links`` (a long, b long): (node, component).

    Every node points at its smallest neighbour or itself, then at where that one points;
    links between different targets are contracted and the round starts again. A hot node
    costs one partial aggregate per task and a join side that AQE can split.
    """
    edges = store(links.filter("a <> b").select("a", "b").distinct(), "links")
    mapping = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = store(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("b"))
            .select("node", F.least("node", "b").alias("target")),
            "points",
        )
        onward = points.select(F.col("node").alias("target"), F.col("target").alias("further"))
        jumped = store(
            points.join(onward, "target").select("node", F.least("target", "further").alias("target")),
            "jumped",
        )
        if mapping is None:
            mapping = jumped.select("node", F.col("target").alias("component"))
        else:
            step = jumped.select(F.col("node").alias("component"), "target")
            mapping = store(
                mapping.join(step, "component", "left").select(
                    "node", F.coalesce("target", "component").alias("component")
                ),
                "mapping",
            )
        end = lambda c: jumped.select(F.col("node").alias(c), F.col("target").alias(f"t{c}"))
        edges = store(
            edges.join(end("a"), "a").join(end("b"), "b")
            .filter("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct(),
            "links",
        )
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return mapping
