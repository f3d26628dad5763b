"""Cleaning delimited lines into typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tabflow.fixed import NO_USER_ID, USER_FIELDS
from tabflow.functions.text import (
    has_null_marker,
    kept,
    leading_fields,
    present,
    soft_long,
    strict_long,
    trim_blanks,
)


def edge_list(lines: DataFrame, counts: Observation | None = None) -> DataFrame:
    """``(src, dst)`` of every usable two-column line; duplicates stay.

    Dropped: lines with fewer than two fields, and lines where an end is empty
    or holds a null marker. An end that is not a number fails the job.
    ``counts`` collects the numbers of lines read and kept while the job runs.
    """
    ends = lines.select(leading_fields(F.col("value"), 2).alias("fields")).select(
        trim_blanks(F.get("fields", F.lit(0))).alias("src"),
        trim_blanks(F.get("fields", F.lit(1))).alias("dst"),
    )
    src, dst = F.col("src"), F.col("dst")
    usable = (src != "") & (dst != "") & ~has_null_marker(src) & ~has_null_marker(dst)
    if counts is not None:
        ends = ends.observe(
            counts,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(usable).alias("kept_lines"),
        )
    return ends.select(kept(usable, strict_long(src).alias("src"), strict_long(dst).alias("dst")))


def user_records(lines: DataFrame, counts: Observation | None = None) -> DataFrame:
    """User profiles as named records with a nested ``location``.

    A line without a usable id is dropped on its own. A property that is
    missing, empty or a null marker is null. ``counts`` collects the numbers of
    lines read and kept while the job runs.
    """
    count = max(USER_FIELDS.values()) + 1
    texts = lines.select(leading_fields(F.col("value"), count).alias("fields")).select(
        trim_blanks(F.get("fields", F.lit(0))).alias("userid"),
        *[trim_blanks(F.get("fields", F.lit(i))).alias(n) for n, i in USER_FIELDS.items()],
    )
    records = texts.select(
        soft_long(F.col("userid")).alias("userid"),
        *[present(F.col(n)).alias(n) for n in USER_FIELDS],
    )
    person = ("userid", "username", "fname", "lname", "mname", "email")
    location = F.struct("city", "state", "country", "zip").alias("location")
    usable = F.col("userid") != NO_USER_ID
    if counts is not None:
        records = records.observe(
            counts,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(usable).alias("kept_lines"),
        )
    return records.select(kept(usable, *[F.col(n) for n in person], location))
