"""Connected components by hooking and pointer jumping, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node and root (the least node that it reaches) of every node in links (a, b).

    A round gives every node the least label around it, gives every label the least one that its nodes have met, and
    follows labels to their labels; the rounds grow with the logarithm of the longest path. Each round is written to
    the shared folder and the one before it deleted. Without links there are no nodes.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = scratch.keep(both, "links")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "labels0")
    turn = 0
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        met = labels.join(around, F.col("node") == F.col("a")).select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        met = scratch.keep(met, f"met{turn}")
        hooks = met.groupBy(F.col("was").alias("h")).agg(F.min("root").alias("least"))
        hooked = met.join(hooks, F.col("node") == F.col("h"), "left").select("node", "was", F.least("root", F.coalesce("least", "root")).alias("root"))
        hooked = scratch.keep(hooked, f"hooked{turn}")
        to = hooked.select(F.col("node").alias("n1"), F.col("root").alias("r1"))
        jumped = hooked.join(to, F.col("root") == F.col("n1")).select("node", "was", F.col("r1").alias("root"))
        turn += 1
        labels = scratch.keep(jumped, f"labels{turn}")
        moved = labels.filter("root <> was").limit(1).count()
        for old in (f"met{turn - 1}", f"hooked{turn - 1}", f"labels{turn - 1}"):
            scratch.drop(old)
        labels = labels.select("node", "root")
        if not moved:
            return labels
