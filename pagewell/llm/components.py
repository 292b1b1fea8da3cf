"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge.

    Each round every node takes the smallest label among itself, its
    neighbours and its label's own label (pointer jumping), so the rounds grow
    with the logarithm of the longest chain of labels. Rounds are written tables; only a
    count comes to the driver. Minima are combined before they are shuffled,
    so a node with very many edges is no burden. Self-loops and repeated edges
    do no harm; no edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = written(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = written(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("x").alias("label"), F.col("label").alias("far"))
        hooked = labels.join(near, "x").join(jump, "label")
        # A smaller label found by a node is also passed to the node it was labelled with.
        passed = hooked.select(F.col("label").alias("x"), F.least("near", "far").alias("given")).groupBy("x").agg(F.min("given").alias("given"))
        stepped = hooked.select("x", "label", F.least("label", "near", "far").alias("next")).join(passed, "x", "left")
        stepped = written(stepped.select("x", "label", F.least("next", F.coalesce("given", "next")).alias("next")), "labels")
        changed = stepped.where("next < label").count()
        labels = stepped.select("x", F.col("next").alias("label"))
        if changed == 0:
            return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
