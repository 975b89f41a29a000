"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root): each vertex with the smallest vertex that it can reach. Rounds go on until no label moves.

    Lineage is cut once a round by checkpoint(); spark.checkpoint.dir names the shared folder.
    """
    from talkloom.sources.artifacts import checkpointed

    pairs = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).distinct()
    both = checkpointed(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    moved = 1
    while moved:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        hooked = label.join(near, F.col("node") == F.col("a")).select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        up = label.select(F.col("node").alias("over"), F.col("root").alias("top"))
        now = checkpointed(hooked.join(up, F.col("root") == F.col("over")).select("node", F.least("root", "top").alias("root"), "was"))
        moved = now.where("root <> was").limit(1).count()
        label = now.select("node", "root")
    return label
