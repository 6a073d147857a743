"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(spark: SparkSession, edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node in ``edges`` (src long, dst long); component is the smallest node reachable.

    A round sends each node the least label among its neighbours and then replaces each label by its label's label, so long
    chains shrink in a logarithmic number of rounds. Minima are combined before the shuffle, so a hub costs one row for each
    task and neighbour; nothing is gathered by group. Self-links, repeated links and null ends are harmless (nulls are left
    out). Every round is a table in the shared folder.
    """
    e = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")).dropna()
    e = scratch.write(e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = scratch.write(e.groupBy(F.col("src").alias("node")).agg(F.min(F.least("src", "dst")).alias("component")))
    for _ in range(max_rounds):
        heard = e.join(labels.select(F.col("node").alias("dst"), "component"), "dst").select(F.col("src").alias("node"), "component")
        least = labels.select("node", "component", F.col("component").alias("was")).union(heard.select("node", "component", F.lit(None).cast("long"))).groupBy("node").agg(F.min("component").alias("component"), F.max("was").alias("was"))
        step = scratch.write(least)
        jumped = step.join(step.select(F.col("node").alias("component"), F.col("component").alias("next")), "component", "left").select("node", F.coalesce("next", "component").alias("component"), "was")
        new = scratch.write(jumped)
        moved = new.where("component < was").limit(1).count()
        scratch.drop(labels, step)
        labels = new.select("node", "component")
        scratch._paths[id(labels)] = (labels, scratch._paths.pop(id(new))[1])
        if not moved:
            scratch.drop(e)
            return labels
    raise RuntimeError(f"labels still move after {max_rounds} rounds")
