"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.llm.common import written


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node now points at the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours now point at the least of them; ``v < u`` in every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for every node that is not its component's least, from edges ``(u, v)``.

    Each round is written to the shared folder, which cuts its lineage; only a count and a checksum
    of the edges come to the driver. The rounds end when the edges stay the same, which is when they
    are stars; their number grows with the logarithm of the longest path.
    """
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return now.select("u", F.col("v").alias("root"))
        before = mark
        now = written(_small(_large(now)), "edges")
