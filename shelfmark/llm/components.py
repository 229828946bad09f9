"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``v`` and ``c``, the smallest vertex that can be reached, for every vertex of the links ``a``, ``b``.

    Each round every vertex hooks on to the one of itself and its neighbours that comes first in the order of a hash,
    which differs from round to round, and links are taken over to where their ends hook. Links within one vertex go;
    when none is left, the rest is done. In such an order a fixed share of the vertices is expected to go each round,
    whatever the numbers of the vertices: a chain in ascending order takes as few rounds as any other. Everything
    stays in tables."""
    live = written(links.select("a", "b"), "links")
    labels = live.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("c", F.col("v"))
    salt = 0
    while True:
        ends = live.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        live = written(ends.select("e.a", "e.b").distinct(), "links")
        if live.isEmpty():
            smallest = labels.groupBy("c").agg(F.min("v").alias("least"))
            return labels.join(smallest, "c").select("v", F.col("least").alias("c"))
        salt += 1
        placed = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("place"), F.col(c).alias("v"))  # noqa: B023, E731
        first = F.least(placed("a"), F.min(placed("b")))
        parents = written(live.groupBy("a").agg(first["v"].alias("p")), "link-parents")
        labels = written(labels.join(parents, labels.c == parents.a, "left").select("v", F.coalesce("p", "c").alias("c")), "link-labels")
        other = parents.select(F.col("a").alias("b"), F.col("p").alias("q"))
        live = live.join(parents, "a").join(other, "b").select(F.col("p").alias("a"), F.col("q").alias("b"))
