"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import written


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is linked to by any path; only nodes that have a link.

    Links hold two long columns and may repeat; a link of a node to itself is ignored. In each round every node points
    its larger neighbours at its smallest one (large star), then its smaller neighbours (small star); the rounds end
    when a round changes nothing, after about log(n) of them. Each is written to the shared folder, and only its
    number of links and a checksum come to the driver.
    """
    u, v = F.col("u"), F.col("v")
    start = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u != v).distinct()
    edges, seen = written(start, "links"), None
    while True:
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(low.select("u", F.col("m").alias("v"))).where(u != v).distinct()
        edges = written(small, "links")
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(u.alias("node"), v.alias("root"))
    return roots.unionByName(edges.select(v.alias("node"), v.alias("root")).distinct())
