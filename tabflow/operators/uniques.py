"""Counting members of delimited lists and words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tabflow.functions.text import (
    has_null_marker,
    items,
    leading_fields,
    strict_long,
    trim_blanks,
    without_trailing,
)


def _id_lists(lines: DataFrame) -> DataFrame:
    """``key`` and trimmed ``list`` text of each line; a missing list is an empty one."""
    return lines.select(leading_fields(F.col("value"), 2).alias("fields")).select(
        F.get("fields", F.lit(0)).alias("key"),
        trim_blanks(F.coalesce(F.get("fields", F.lit(1)), F.lit(""))).alias("list"),
    )


def id_tokens(lines: DataFrame, counts: Observation | None = None) -> DataFrame:
    """``(id, token)`` for every item of every comma list.

    Lines whose id holds a null marker, and lines without a list, are dropped.
    A kept id that is not a number fails the job. ``counts`` collects the
    numbers of lines read and rejected while the job runs.
    """
    marker, no_list = has_null_marker(F.col("key")), F.col("list") == ""
    lists = _id_lists(lines)
    if counts is not None:
        lists = lists.observe(
            counts,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(marker).alias("marker_lines"),
            F.count_if(~marker & no_list).alias("no_list_lines"),
        )
    usable = lists.select(
        F.when(~marker & ~no_list, strict_long(F.col("key"))).alias("id"),
        "list",
        without_trailing(F.col("list"), ",").alias("body"),
    )
    tokens = F.when(F.col("id").isNotNull(), items(F.col("list"), F.col("body"), ","))
    return usable.select("id", F.explode(tokens).alias("token"))


def explode_unique(lines: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Exact number of distinct list items per id: ``(id, uniq)``.

    The distinct pairs are shuffled by ``(id, token)`` after map-side
    deduplication and only their counts by ``id``, so an id that owns a large
    part of the data is spread over all tasks.
    """
    pairs = id_tokens(lines, counts).distinct()
    return pairs.groupBy("id").agg(F.count(F.lit(1)).alias("uniq"))


def id_list_counts(lines: DataFrame) -> DataFrame:
    """One row of record counts for an id-list input: read, rejected and kept.

    Counts are merged per id before the total, so that the number of distinct
    ids comes from the same single pass. Rejected lines share the null id.
    """
    flags = _id_lists(lines).select(
        "key",
        has_null_marker(F.col("key")).alias("marker"),
        (F.col("list") == "").alias("no_list"),
    )
    usable = ~F.col("marker") & ~F.col("no_list")
    per_id = (
        flags.withColumn("id", F.when(usable, strict_long(F.col("key"))))
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if("marker").alias("marker_lines"),
            F.count_if(~F.col("marker") & F.col("no_list")).alias("no_list_lines"),
        )
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(column)

    kept_lines = F.sum(F.when(F.col("id").isNotNull(), F.col("lines")))
    return per_id.agg(
        total("lines"),
        total("marker_lines"),
        total("no_list_lines"),
        F.coalesce(kept_lines, F.lit(0)).alias("kept_lines"),
        F.count("id").alias("kept_ids"),
    )


def word_count(texts: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of every space-separated word: ``(word, n)``."""
    text = F.col(column)
    bodies = texts.select(text.alias("text"), without_trailing(text, " ").alias("body"))
    words = bodies.select(F.explode(items(F.col("text"), F.col("body"), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
