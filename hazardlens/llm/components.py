"""Connected components of an edge table, without collecting edges or nodes anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.storage import save


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the root is the smallest node that can be reached.

    Each round hooks every node, and the node it points to, on to the smallest root among the neighbours, and then
    halves the paths to the roots. All sums and minima are combined before they are shuffled; each round is written
    to the shared folder, so a lost executor costs no earlier round. Loops and repeated edges do no harm; an empty
    table gives an empty one.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = save(edges.select(F.explode(ways).alias("way")).select("way.a", "way.b").distinct(), "edges")
    label = save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "roots")
    while True:
        near = (
            both.join(label.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        met = label.join(near, "node")
        offers = (
            met.select("node", "near")
            .union(met.select(F.col("root").alias("node"), "near"))
            .groupBy("node")
            .agg(F.min("near").alias("near"))
        )
        hooked = save(
            label.join(offers, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")),
            "hooked",
        )
        jumped = hooked.join(
            hooked.select(F.col("node").alias("root"), F.col("root").alias("top")), "root"
        ).select("node", "old", F.col("top").alias("root"))
        label_with_old = save(jumped, "roots")
        label = label_with_old.select("node", "root")
        if label_with_old.where("old <> root").isEmpty():
            return label
