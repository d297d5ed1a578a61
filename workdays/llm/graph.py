"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


SALTS = 8


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbours and itself."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # the centre of a star may hold a third of all edges: they are dealt by centre and salt
    part = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    salted = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    larger = both.where("v > u").withColumn("part", part).join(salted, ["u", "part"])
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node's smaller neighbours, and the node, on the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): root is the smallest node it reaches.

    Each round is written to the shared work folder, so its lineage ends there; the rounds grow
    with the logarithm of the longest chain. Aggregates run partially before their shuffles, and
    the neighbours of one node are spread by a salt.
    """
    ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = staged(edges.where("u <> v").select(*ends).distinct(), name)
    mark = None
    while True:
        now = staged(_small_star(_large_star(now)), name)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
