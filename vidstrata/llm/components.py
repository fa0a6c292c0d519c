"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of a link, root the smallest node of its component.

    Each round a node takes the smallest root of itself and its neighbours, then the root of that root,
    until nothing changes. Only the number of changed nodes reaches the driver.
    """
    there = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    back = there.select(F.col("other").alias("node"), F.col("node").alias("other"))
    edges = stored(there.unionByName(back).where("node <> other").distinct(), "links")
    roots = stored(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "roots")
    while True:
        near = edges.join(roots.select(F.col("node").alias("other"), F.col("root").alias("near")), "other")
        near = near.groupBy("node").agg(F.min("near").alias("near"))
        step = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("step"))
        above = roots.select(F.col("node").alias("step"), F.col("root").alias("above"))
        new = step.join(above, "step", "left").select(
            "node", F.col("root").alias("old"), F.least("step", F.coalesce("above", "step")).alias("root")
        )
        new = stored(new, "roots")
        roots = new.select("node", "root")
        if new.where("root <> old").isEmpty():
            return roots
