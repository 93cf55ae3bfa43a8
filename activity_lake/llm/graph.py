"""Connected components of a link table, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import stage


def _hung_on_least(links: DataFrame, keep_least: bool) -> DataFrame:
    """Links (node, other) of each node, moved to the least of the node's others.

    The least is aggregated apart and written, so a node with very many links is only the many side of a join that AQE
    can split.
    """
    least = stage(links.groupBy("node").agg(F.min("other").alias("least")), "least")
    moved = links.join(least, "node").select(
        F.col("other").alias("node"), F.least("least", "node").alias("other"), F.col("node").alias("was"))
    if keep_least:
        moved = moved.filter("node <> other").select("node", "other").unionByName(
            least.select("node", F.col("least").alias("other")))
    else:
        moved = moved.filter("node > was").select("node", "other")
    return moved.filter("node <> other").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots; root is the least node of its component.

    Each round hangs all larger others of a node, then all smaller ones, on the least; rounds grow with the logarithm
    of the graph. Every round is written to the shared folder. Links of a node with itself, repeated links and nulls
    are left out.
    """
    links = links.filter("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    links, seen = stage(links, name), None
    while True:
        both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
        links = stage(_hung_on_least(_hung_on_least(both, False), True), name)
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.select("node", F.col("other").alias("root"))
        seen = now
