"""Dense numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.fixed import USER_BATCH_SIZE
from tabflow.scratch import staged

_PART_BITS = 33  # monotonically_increasing_id(): partition above, row number below


def dense_numbers(
    df: DataFrame,
    name: str,
    order_by: Sequence[str] = (),
    unique: bool = False,
    start: int = 0,
    stage: Callable[[DataFrame, str], DataFrame] = staged,
) -> DataFrame:
    """Add ``name``: ``start, start + 1, ...`` in the order of ``order_by``.

    Rows are range-partitioned and sorted, written once to the scratch folder
    together with their partition and position, and read back with the sum of
    the sizes of all earlier partitions added. The written table fixes the
    partitioning, so lost executors cannot shift a number. Without ``order_by``
    rows keep their input partitions and nothing is shuffled.

    ``stage`` writes the table; pass that of a ``Scratch`` to have it deleted later.

    The range partitioning samples its input first, so an expensive plan is
    best ``staged`` before it is numbered.

    Unless the keys are ``unique``, the position in the input breaks ties, so
    that copies of one key can fall into several partitions. The input order
    must then be repeatable, as it is for files.
    """
    rows = df
    if order_by:
        keys = [F.col(c) for c in order_by]
        if not unique:
            rows = rows.withColumn("__tie", F.monotonically_increasing_id())
            keys.append(F.col("__tie"))
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*df.columns)

    place = F.monotonically_increasing_id()
    placed = stage(
        rows.select(
            "*",
            F.shiftright(place, _PART_BITS).alias("__part"),
            place.bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias("__row"),
        ),
        "numbered",
    )

    # One row per written partition: small enough to broadcast and to window.
    sizes = placed.groupBy("__part").agg((F.max("__row") + 1).alias("size"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("__offset")
    )
    number = F.col("__offset") + F.col("__row") + start
    return placed.join(F.broadcast(offsets), "__part").select(
        *df.columns, number.cast("bigint").alias(name)
    )


def batch_numbers(
    df: DataFrame,
    size: int = USER_BATCH_SIZE,
    order_by: Sequence[str] = (),
    unique: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = staged,
) -> DataFrame:
    """Add ``batch``; counting rows from one, row ``n`` is in batch ``n div size``."""
    numbered = dense_numbers(df, "__n", order_by, unique, start=1, stage=stage)
    batch = F.call_function("div", F.col("__n"), F.lit(size))
    return numbered.select(*df.columns, batch.alias("batch"))
