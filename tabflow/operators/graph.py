"""Follower graph: nodes, edges and the views on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.fixed import REL_NAME, REL_TYPE
from tabflow.operators.skew import join_salted


def follow_nodes(pairs: DataFrame) -> DataFrame:
    """Every user id at either end of a pair, once."""
    return pairs.select(F.explode(F.array("src", "dst")).alias("userid")).distinct()


def follow_pairs(pairs: DataFrame) -> DataFrame:
    """Every distinct pair; copies are removed map-side before the shuffle."""
    return pairs.select("src", "dst").distinct()


def relationships(pairs: DataFrame) -> DataFrame:
    """Pairs as relationship records: edge key, type and property added."""
    edge = F.concat_ws(":", F.col("src").cast("string"), F.col("dst").cast("string"))
    return pairs.withColumns(
        {"edge": edge, "rel_type": F.lit(REL_TYPE), "name": F.lit(REL_NAME)}
    )


def follow_edges(pairs: DataFrame) -> DataFrame:
    """One relationship record for each distinct pair."""
    return relationships(follow_pairs(pairs))


def only_new(candidates: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not stored yet.

    The stored side is usually far larger. Reducing it to the keys that occur
    among the candidates first lets a small load be broadcast against it; a
    large load falls back to a sort-merge join on the same keys.
    """
    keys = list(keys)
    hits = stored.select(*keys).join(candidates.select(*keys), keys, "left_semi")
    return candidates.join(hits, keys, "left_anti")


def edge_dump(edges: DataFrame, nodes: DataFrame, salted: bool = False) -> DataFrame:
    """Every relationship with the ids of its record and of both end nodes.

    ``salted`` divides the edges of users who have very many, where their partitions are
    too small for adaptive execution to split; it reads the ends of the edges once more.
    """
    start = nodes.select(F.col("node_id").alias("start_id"), F.col("userid").alias("src"))
    end = nodes.select(F.col("node_id").alias("end_id"), F.col("userid").alias("dst"))
    records = edges.select("rel_id", "src", "dst", "name")
    if salted:
        spread = F.col("rel_id")
        # both kinds of hot ends are counted on the stored edges, not on the joined ones
        found = join_salted(records, start, "src", spread)
        found = join_salted(found, end, "dst", spread, counted=records)
    else:
        found = records.join(start, "src").join(end, "dst")
    return found.select(
        "rel_id",
        "start_id",
        F.col("src").alias("start_userid"),
        "name",
        "end_id",
        F.col("dst").alias("end_userid"),
    )


def incident_edges(edges: DataFrame) -> DataFrame:
    """Each edge under both of its ends; a self-loop appears once.

    Needs one pass over the edges and no shuffle.
    """
    ends = F.array_distinct(F.array("src", "dst"))
    return edges.select(F.explode(ends).alias("userid"), "*")
