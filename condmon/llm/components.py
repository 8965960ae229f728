"""Connected components of an edge table by alternating star contraction
(large-star / small-star): each round hooks every node's larger neighbours,
then its smaller ones, to the smallest neighbour known.  Rounds grow with the
logarithm of the longest path; only a count and a checksum per round reach
the driver, and each round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import gathered, save


def _mark(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).cast("string")
    ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node of the component) for every node of
    ``edges(a, b)`` that is not its own root.  Self edges and repeated edges
    are allowed; an empty table gives no rows."""
    star = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    star = save(star, "edges")
    mark = _mark(star)
    star = gathered(star, mark[0])
    while mark[0]:
        both = star.union(star.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = gathered(save(gathered(large, mark[0]), "large-star"), mark[0])
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        star = small.union(least.select("hi", F.col("m").alias("lo"))).distinct()
        star = gathered(save(gathered(star, mark[0]), "small-star"), mark[0])
        last, mark = mark, _mark(star)
        if mark == last:
            break
    return star.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
