"""Connected components of an edge table by alternating large and small stars.

All work is joins and aggregates on edge tables in the shared folder; the driver sees
one count and one checksum a round. Minima are aggregates (combined before the
shuffle) and are written before they are joined back, so a node with very many
neighbours is split by the planner's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): ``root`` is the smallest
    node it is connected with. Loops and repeated edges do no harm; no edges, no rows."""
    pairs = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                    "edges")
    seen = None
    while True:
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                        "large")
        # small star: u and its smaller neighbours go to the smallest of them
        small = written(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        pairs = written(large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
