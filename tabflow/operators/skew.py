"""Joins in which one key may own a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TRACKED = 1_000_000  # the most items that a sketch of Spark's may track

def join_hot(
    rows: DataFrame, by_key: DataFrame, on: Sequence[str], hot: Column, how: str = "inner"
) -> DataFrame:
    """Rows joined with a table that has one row per key.

    The rows of that table which ``hot`` selects are broadcast to theirs, so no key owns a task;
    the others meet theirs in a shuffle. The caller bounds how many ``hot`` selects, for
    example keys with more than one row in a thousand, which are fewer than a thousand.
    Both inputs are read twice: stage them. ``how`` is inner or left.
    """
    keys = list(on)
    few = F.broadcast(by_key.where(hot))
    rest = rows.join(few.select(*keys), keys, "left_anti")
    return rows.join(few, keys).unionByName(rest.join(by_key.where(~hot), keys, how))


def heavy_keys(rows: DataFrame, key: str, most: int) -> dict[int, int]:
    """Hashes of the keys with more than one row in ``most``, and how many times more.

    The counts are those of a frequent-items sketch, which is at most a few times
    ``most`` counters per task, combined before the shuffle. A key may get a larger
    number than its rows deserve, and one near the bound may be left out.
    """
    keys = rows.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    kept = min(_TRACKED, 8 * most)  # an error below half a share
    found = keys.agg(
        F.call_function("approx_top_k", "h", F.lit(min(most, kept)), F.lit(kept)).alias("top"),
        F.count("*").alias("n"),
    ).first()
    counts = ((t["item"], t["count"] * most // found["n"]) for t in found["top"] or ())
    return {item: int(times) for item, times in counts if times > 1}


def join_salted(
    rows: DataFrame,
    others: DataFrame,
    on: str,
    spread: Column,
    pieces: int = 8,
    counted: DataFrame | None = None,
) -> DataFrame:
    """An inner join of two tables in which a key of ``rows`` may own a large share of them.

    A key that holds more than a ``pieces``-th of a mean shuffle partition is divided
    into parts of about that size, so no task waits for a hot key, whether its
    partition is large enough for adaptive execution to split it or not. Rows of
    ``others`` with such a key are repeated once per part; all others are not. The hot
    keys, at most ``pieces`` times the shuffle partitions, reach the driver as pairs of
    numbers and are broadcast. ``rows`` are read twice, the first time for ``on`` alone;
    ``counted`` is another table with the same keys as often, if that is cheaper to read.

    ``spread`` is a value that differs between rows of one key. It must be the same when a
    lost task runs again: a unique column, or the row's number in a scan.
    """
    spark = rows.sparkSession
    most = pieces * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = heavy_keys(rows if counted is None else counted, on, most)
    if not hot:
        return rows.join(others, on)
    parts = F.broadcast(spark.createDataFrame(list(hot.items()), "__h bigint, __parts int"))
    many = F.coalesce("__parts", F.lit(1))

    def with_parts(df: DataFrame) -> DataFrame:
        return df.join(parts, F.xxhash64(on) == F.col("__h"), "left")

    salted = with_parts(rows).withColumn("__salt", F.pmod(F.xxhash64(spread), many).cast("int"))
    repeated = with_parts(others).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), many - 1))
    )
    held = ("__h", "__parts")
    return salted.drop(*held).join(repeated.drop(*held), [on, "__salt"]).drop("__salt")
