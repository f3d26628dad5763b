"""Placing rows with equal keys next to each other in the output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cluster_rows(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Cluster rows by ``key`` and sort each output partition by it.

    The rebalance hint lets adaptive execution split a partition that one hot
    key has made too large and merge those that are too small.
    """
    arguments = [key] if partitions is None else [partitions, key]
    return df.hint("rebalance", *arguments).sortWithinPartitions(key)
