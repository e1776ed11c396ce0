"""Connected components of a link table, by rounds of contraction under a random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import materialise

_NONE = "node long, root long"


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` has longs a and b.

    In each round every node moves to the neighbour (or itself) that comes first in an order by
    hash, another order each round, and links are rewritten to where their ends moved. On average
    that leaves about half of the nodes that still have links, so the rounds are logarithmic in
    the largest component. A node's neighbours are only ever reduced to their minimum, with
    partial minima in each task, so a node with very many links is no burden. What a round leaves
    is written under the checkpoint folder, which keeps plans short and survives lost executors.
    """
    links = materialise(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct())
    labels, rounds = None, 0
    while not links.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(rounds)).alias("h"), F.col(c).alias("x"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("first"))
                            .select("node", F.least(order("node"), "first")["x"].alias("root")))
        to = lambda c: moved.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        links = materialise(links.join(to("a"), "a").join(to("b"), "b").where("a_root <> b_root")
                            .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
                            .distinct())
        if labels is None:
            labels = moved
        else:
            step = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = materialise(labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        rounds += 1
    return labels if labels is not None else links.sparkSession.createDataFrame([], _NONE)
