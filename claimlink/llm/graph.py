"""Connected components of a large graph of links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.sources.tables import Staging


def components(links: DataFrame, store: Staging) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node it reaches.

    Every round takes the smallest label among neighbours and then the label of that label, so
    labels spread over doubling distances. Both steps are joins and minima: a node with very many
    neighbours is combined before its shuffle, and its join splits at run time. Labels are stored
    each round, which cuts lineage. A null end or a link to itself adds nothing.
    """
    both = links.filter("a IS NOT NULL AND b IS NOT NULL")
    edges = store(
        both.select("a", "b").unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct(),
        "edges",
    )
    labels = store(
        edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
        .withColumnRenamed("a", "node"),
        "labels",
    )
    while True:
        near = (
            edges.join(labels, edges.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hop = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("via")
        )
        far = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        step = store(
            hop.join(far, "via").select("node", "old", F.least("via", "far").alias("root")),
            "labels",
        )
        if step.filter("root < old").isEmpty():
            return step.select("node", "root")
        labels = step.select("node", "root")
