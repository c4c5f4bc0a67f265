"""Connected components of a link table, with Spark joins only (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm import store


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): component is the smallest id that can be reached.

    Each round makes every id point at the smallest neighbour (first among larger neighbours, then among smaller ones);
    rounds go on until the edges no longer change. Edge tables are written, so a round never repeats earlier ones.
    """
    edges = store.written(links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _digest(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store.written(large.union(least.where("u > m").select("u", F.col("m").alias("v"))).distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = store.written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
