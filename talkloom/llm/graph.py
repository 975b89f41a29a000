"""Connected components as rounds of DataFrame joins; nothing is gathered on the driver but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import cut


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Label every vertex of ``edges`` with the smallest vertex that it can reach: columns node, root.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes. A vertex of
    very high degree is no bottleneck: minima are combined before the shuffle and the join back on the
    vertex is one that adaptive execution may split. Rows with a null end and self-loops are ignored;
    repeated rows change nothing; an empty table gives an empty result.
    """
    both = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null and u <> v")
    stars = cut(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    before = None
    while True:
        stars = cut(_small_star(_large_star(stars)), "stars")
        now = stars.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if before == (now["n"], now["s"]):
            break
        before = (now["n"], now["s"])
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _large_star(stars: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a vertex to the smallest of its neighbours and itself."""
    near = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Connect a vertex and its smaller neighbours to the smallest of them. Here u > v in every row."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    hooked = stars.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
