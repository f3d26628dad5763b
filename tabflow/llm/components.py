"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.scratch import staged


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``edges`` (``a, b``); the smallest id names it.

    Alternates the two star operations: every node's larger neighbours are linked to
    its smallest one, then every node's smaller neighbours are. Each round is
    written to the scratch folder; the edges end as one star per component after a
    number of rounds that grows with the logarithm of the longest path. A node with
    very many edges is one key of a minimum, combined before the shuffle, and of a
    join whose large partitions adaptive execution splits.
    """
    current = staged(_ordered(edges).distinct(), "edges")
    while not _stars(current):
        both = current.union(current.select(F.col("b"), F.col("a")))
        # a star has no more rows than its edges and nodes, so copies can stay until the second
        large = _star(both.toDF("u", "v"), F.col("v") > F.col("u"))
        small = _star(_ordered(large).select(F.col("b"), F.col("a")).toDF("u", "v"), F.lit(True))
        current = staged(_ordered(small).distinct(), "edges")
    ends = current.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = current.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return ends.union(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges with ``a`` smaller than ``b``."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")


def _stars(edges: DataFrame) -> bool:
    """Whether distinct ordered edges are stars: no node has two smaller ones, or both kinds."""
    side = lambda end, roots, ends: F.struct(
        F.col(end).alias("id"), F.lit(roots).alias("roots"), F.lit(ends).alias("ends")
    )
    sides = edges.select(F.inline(F.array(side("a", 1, 0), side("b", 0, 1)))).groupBy("id")
    sides = sides.agg(F.max("roots").alias("roots"), F.sum("ends").alias("ends"))
    return sides.where(F.col("roots") + F.col("ends") > 1).isEmpty()


def _star(arcs: DataFrame, moved) -> DataFrame:
    """Edges from the chosen neighbours ``v`` of each ``u``, and ``u``, to their minimum."""
    least = arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = arcs.join(least, "u")
    linked = met.where(moved & (F.col("v") != F.col("m"))).select("m", "v")
    return linked.union(least.where("u <> m").select("m", "u")).toDF("a", "b")
