"""Selecting partitions by ordered column and value lists."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

PartitionValue = str | int | tuple

_LISTERS = 16  # folders listed at a time
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_predicate(
    df: DataFrame, columns: Sequence[str], values: Sequence[PartitionValue]
) -> Column | None:
    """One predicate for the partition columns, or None for the whole table.

    A value is a single value, a ``(low, high)`` pair, or the text ``"low:high"``.
    A text with one colon that is no range goes into a tuple of its own, as in
    ``("12:30",)``, and times in a range into a pair. Ranges include both ends. Literals take the type of the
    partition column, so the comparison prunes folders before anything is read.
    """
    if len(columns) != len(values):
        raise ValueError("one value or range is needed for each partition column")

    parts = [
        _chosen(F.col(c), df.schema[c].dataType, v) for c, v in zip(columns, values, strict=True)
    ]
    return reduce(lambda a, b: a & b, parts) if parts else None


def _chosen(column: Column, dtype: DataType, value: PartitionValue) -> Column:
    if isinstance(value, str) and value.count(":") == 1:
        value = tuple(value.split(":"))
    if isinstance(value, tuple) and len(value) == 1:
        return column == F.lit(value[0]).cast(dtype)
    if isinstance(value, tuple):
        low, high = (F.lit(v).cast(dtype) for v in value)
        return column.between(low, high)
    return column == F.lit(value).cast(dtype)


def scan_partitions(
    df: DataFrame, columns: Sequence[str] = (), values: Sequence[PartitionValue] = ()
) -> DataFrame:
    """The rows of the chosen partitions; empty lists mean the whole table."""
    predicate = partition_predicate(df, columns, values)
    return df if predicate is None else df.where(predicate)


def chosen_folders(
    spark: SparkSession,
    path: str,
    partition_schema: str,
    columns: Sequence[str],
    values: Sequence[PartitionValue],
) -> list[str]:
    """The folders below ``path`` that may hold rows of the chosen partitions.

    One level of ``column=value`` folders is listed after the other, below those only whose
    values are chosen so far, down to the last chosen column. So what is listed grows with the
    chosen part of the table and not with the table. Values are compared as their type in
    ``partition_schema``; a value that is none of that type is not chosen.
    """
    if len(columns) != len(values):
        raise ValueError("one value or range is needed for each partition column")
    schema = StructType.fromDDL(partition_schema)
    wanted = {c.lower(): (schema[c].dataType, v) for c, v in zip(columns, values, strict=True)}
    folders = [path.rstrip("/")]
    while wanted and folders:
        with ThreadPoolExecutor(_LISTERS) as pool:
            below = [f for found in pool.map(lambda f: subfolders(spark, f), folders) for f in found]
        levels = {f.rsplit("/", 1)[1].partition("=")[0].lower() for f in below}
        if len(levels) > 1:
            raise ValueError(f"folders of several columns on one level below {path}: {levels}")
        choice = wanted.pop(levels.pop(), None) if levels else None
        folders = _matching(spark, below, *choice) if choice else below
    return folders


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The ``column=value`` folders directly below a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(place)
    names = [s.getPath().getName() for s in found if s.isDirectory()]
    return [f"{path}/{n}" for n in names if "=" in n and n[0] not in "_."]


def _matching(
    spark: SparkSession, folders: list[str], dtype: DataType, value: PartitionValue
) -> list[str]:
    """The folders whose value is chosen, judged by the same comparison as the rows."""
    texts = {f: unquote(f.rsplit("/", 1)[1].partition("=")[2]) for f in folders}
    held = sorted({t for t in texts.values() if t != _NULL_FOLDER})
    if not held:
        return []
    typed = spark.createDataFrame([(t,) for t in held], "text string")
    hits = typed.where(_chosen(F.col("text").try_cast(dtype), dtype, value)).collect()
    chosen = {r["text"] for r in hits}
    return [f for f in folders if texts[f] in chosen]
