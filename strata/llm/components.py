"""Connected components of an edge table by alternating star steps.

Each round links every node to the smallest node it sees (first for larger
neighbours, then for smaller ones), which halves the distance to the
smallest node of the component, so the rounds grow with the logarithm of
the component's diameter. Minima come from partially aggregated groupings and
meet the edges in ordinary joins, so a node with very many neighbours is one
row of the grouping and a skewed key that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(node, root)`` for every node that has an edge.

    ``root`` is the smallest node of the component; the smallest node itself
    is included. Loops, repeated and reversed edges and rows with a null end
    are harmless; an empty input gives an empty result.
    """
    e = written(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(
                     F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                     F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").filter(F.col("u") != F.col("v")).distinct())
        e = written(small, "edges")
        last, mark = mark, _mark(e)
        if mark == last:
            break
    own = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own)
