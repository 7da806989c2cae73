"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two joins and two grouped minima over edges that were written to
the shared folder; nothing is collected but a count and a checksum. The number
of rounds grows with the logarithm of the component size. A hub's rows are
plain scanned rows on both join sides, so adaptive skew-join splitting applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import stage


def _with_minimum(edges: DataFrame) -> DataFrame:
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_minimum(both).filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge runs from the larger to the smaller node
    joined = _with_minimum(edges)
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (u, v: long); root is the smallest node reached.

    Self links and repeated edges do no harm; no edges give no rows.
    """
    current = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
    mark = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        current = stage(_small_star(stage(_large_star(current))))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
