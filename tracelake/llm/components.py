"""Connected components of a graph of long ids: alternating stars, each round a table in the work folder.

A round hangs every node's larger neighbours, then its smaller ones, on the
smallest node it knows; edges never leave their component and their number
does not grow. It ends when a round changes nothing; then every edge points
from a node to the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracelake.llm.shared import written


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, folder: str) -> DataFrame:
    """edges: a, b (longs, any order, repeats and loops allowed). Returns node, root for nodes that are not their own root."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = written(edges, folder, "edges-0")
    before, number = _summary(edges), 0
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, folder, f"large-{number}")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y"))))
        edges = large.join(smallest, "a").select(pairs.alias("e")).select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct()
        number += 1
        edges = written(edges, folder, f"edges-{number}")
        after = _summary(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
