"""Connected components of a link table, by alternating star contraction.

Each round links every node's larger neighbours to its smallest neighbour
(large star), then every node's smaller neighbours to the smallest (small
star); the components' smallest nodes end as the centres of stars. Rounds grow
with the logarithm of the longest chain. Each round is two grouped minima with
map-side combining and two joins on the node, which Spark's skew join may
split, and its links are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v), each in one direction with u > v."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where(F.col("u") != F.col("v")).distinct()


def _signature(links: DataFrame):
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b of one ordered
    type) that is not itself a root; the root is its component's smallest node.
    """
    now = stored(links.where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _signature(now)
    while mark[0]:
        now = stored(_star(_star(now, large=True), large=False), "links")
        new = _signature(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
