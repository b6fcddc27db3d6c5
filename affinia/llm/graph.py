"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.tables import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "m"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node that each node of a link can reach.

    Every step hangs the neighbours of a node on the smallest of them (first those
    larger than the node, then the smaller ones), so the depth of the trees falls by a
    factor each time and no group is ever gathered: what is needed of a node's
    neighbours is their minimum, which is summed up before the shuffle.
    """
    links = links.select(F.col(left).alias("u"), F.col(right).alias("m")).where("u <> m")
    edges = written(links.select(F.greatest("u", "m").alias("u"), F.least("u", "m").alias("m")).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("m").alias("u"), F.col("u").alias("m")))
        low = both.groupBy("u").agg(F.min("m").alias("low")).select("u", F.least("u", "low").alias("low"))
        # Larger neighbours hang on the smallest one.
        large = both.join(low, "u").where("m > u").select(F.col("m").alias("u"), F.col("low").alias("m"))
        large = large.where("u <> m").distinct()
        least = large.groupBy("u").agg(F.min("m").alias("low"))
        # Of what a node now hangs on, all hang on the smallest.
        small = large.join(least, "u").select(F.greatest("m", "low").alias("u"), F.least("m", "low").alias("m"))
        small = small.where("u <> m").union(least.select("u", F.col("low").alias("m"))).distinct()
        edges = written(small, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("m").alias("component")).union(roots)
