"""Connected components of a link table, by contraction: no links or components reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of the links (a, b): the root is the least node that can be reached.

    Each level hooks a node to its least neighbour if that is smaller, follows the hooks to their ends by
    pointer jumping, and contracts the links to the ends; every level at least halves the nodes that still
    have links.  Tables are written per step, so a lost executor repeats one step only."""
    edges = stage(links.where("a <> b").select("a", "b").distinct(), f"{folder}/links")
    labels, level = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        up = stage(hooks.select("node", F.least("node", "m").alias("root")), f"{folder}/{level}-0")
        jump = 0
        while True:  # until every hook ends at a node that is its own root
            jump += 1
            nxt = up.select(F.col("node").alias("n"), F.col("root").alias("r"))
            moved = up.join(nxt, F.col("root") == F.col("n")).select(
                "node", F.col("r").alias("root"), (F.col("r") != F.col("root")).alias("moved"))
            up = stage(moved, f"{folder}/{level}-{jump}")
            if up.where("moved").isEmpty():
                break
        up = up.select("node", "root")
        if labels is None:
            labels = up
        else:
            step = up.select(F.col("node").alias("n"), F.col("root").alias("r"))
            labels = labels.join(step, F.col("root") == F.col("n"), "left").select("node", F.coalesce("r", "root").alias("root"))
        a = up.select(F.col("node").alias("na"), F.col("root").alias("ra"))
        b = up.select(F.col("node").alias("nb"), F.col("root").alias("rb"))
        edges = stage(edges.join(a, F.col("a") == F.col("na")).join(b, F.col("b") == F.col("nb"))
                      .where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
                      f"{folder}/{level}-edges")
        level += 1
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, root long")
    return stage(labels, f"{folder}/roots")
