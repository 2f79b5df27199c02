"""Connected components of a large edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import save


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Every round gives each node the least root of its neighbours (a grouped minimum, combined before the
    shuffle) and then the root of its root; it ends when nothing changes. Only a count reaches the driver.
    """
    both = save(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    state = save(both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("root")), "roots")
    while True:
        near = both.join(state, both["b"] == state["node"]).groupBy("a").agg(F.min("root").alias("low"))
        own = state.join(near, state["node"] == near["a"]).select(
            "node", F.col("root").alias("was"), F.least("root", "low").alias("root"))
        # a round also hooks the old root to the new one, so whole trees move at once
        hooks = own.where("root < was").groupBy(F.col("was").alias("node")).agg(F.min("root").alias("hook"))
        lower = own.join(hooks, "node", "left").select("node", "was", F.least("root", "hook").alias("root"))
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = save(lower.join(up, "root", "left").select(
            "node", "was", F.least("root", "top").alias("root")), "roots")
        if new.where("root <> was").limit(1).count() == 0:
            return new.select("node", "root")
        state = new.select("node", "root")
