"""Connected components of a table of links, without gathering links or labels in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for each node of ``links`` (a, b): the smallest node that can be reached.

    Alternating large-star and small-star: each link first moves from its smaller end to the least neighbour of that
    end, then each node ties all its smaller neighbours to the least of them. Links never grow in number, and the ends
    of each that changes fall, so the loop ends, and only when every component is a star around its smallest node.
    In a numpy model of it, chains of 1,000 to 1,000,000 nodes took 9 to 21 rounds. Each round's links are a written table; both sides
    of its joins are exchanged from such tables, which lets adaptive execution split a node with very many links.
    """

    def least(of: DataFrame) -> DataFrame:
        return of.groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("_least"))

    def size(of: DataFrame):
        return of.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)") + F.col("b"))).first()

    edges = scratch.save(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges-0")
    before, step = size(edges), 0
    while True:
        step += 1
        large = edges.join(least(edges), F.col("b") == F.col("_node"), "left").select("a", F.coalesce("_least", "b").alias("b"))
        large = scratch.save(large.distinct(), f"{name}-large-{step}")
        small = large.join(least(large), F.col("a") == F.col("_node"))
        small = small.select(F.when(F.col("b") == F.col("_least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("_least").alias("b"))
        small = scratch.save(small.distinct(), f"{name}-edges-{step}")
        scratch.free(f"{name}-edges-{step - 1}", f"{name}-large-{step}")
        edges, after = small, size(small)
        if before == after:  # equally many links with the same sum: none has changed
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b"))
    labels = scratch.save(nodes.distinct(), f"{name}-labels")
    scratch.free(f"{name}-edges-{step}")
    return labels
