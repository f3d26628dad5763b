"""Replacing one partition of an existing table."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def sql_text(value: object) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clause(spec: Mapping[str, object]) -> str:
    return ", ".join(f"`{column}` = {sql_text(value)}" for column, value in spec.items())


def drop_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_clause(spec)})")


def add_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_clause(spec)})")


_MODE = "spark.sql.sources.partitionOverwriteMode"
_lock = threading.Lock()
#: Of each session with exports under way: how many, and the setting before the first.
_exports: dict[SparkSession, tuple[int, str]] = {}


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that get rows, at commit.

    Inserts into a catalog table take this from the session, not from options. Exports in
    several threads share the setting; the last one to end puts the old one back.
    """
    with _lock:
        running, before = _exports.get(spark, (0, spark.conf.get(_MODE)))
        _exports[spark] = running + 1, before
        spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        with _lock:
            running, before = _exports.pop(spark)
            if running > 1:
                _exports[spark] = running - 1, before
            else:
                spark.conf.set(_MODE, before)


def _check_spec(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    columns = spark.catalog.listColumns(table)
    keys = {c.name for c in columns if c.isPartition}
    unknown = set(spec) - {c.name for c in columns}
    if unknown:
        raise ValueError(f"not columns of {table}: {sorted(unknown)}")
    if set(spec) != keys:
        raise ValueError(f"{table} is partitioned by {sorted(keys)}, not by {sorted(spec)}")


def _empty_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    """Replace a partition by no rows; unlike a drop this deletes external files too."""
    nothing = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()})"
        for f in spark.table(table).schema.fields
        if f.name not in spec
    )
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({_clause(spec)}) SELECT {nothing} WHERE false"
    )
    left = spark.table(table)
    for column, value in spec.items():
        left = left.where(F.col(f"`{column}`") == F.lit(value).cast(left.schema[column].dataType))
    if not left.isEmpty():
        raise RuntimeError(f"{table}: rows are left in PARTITION ({_clause(spec)})")


def overwrite_partition(df: DataFrame, table: str, spec: Mapping[str, object]) -> int:
    """Replace the partition ``spec`` of ``table`` with the rows; return their number.

    The table must exist, and ``spec`` must name all of its partition columns and
    nothing else; both are checked before anything is written. New files are
    staged and the old ones disappear only when the job commits; other partitions
    are not touched. An empty input leaves an empty partition, of managed and
    external tables.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    _check_spec(spark, table, spec)
    columns = [
        F.lit(spec[f.name]).cast(f.dataType).alias(f.name)
        if f.name in spec
        else F.col(f"`{f.name}`")
        for f in spark.table(table).schema.fields
    ]
    written = Observation()
    rows = df.select(*columns).observe(written, F.count(F.lit(1)).alias("rows"))
    with _dynamic_overwrite(spark):
        rows.write.mode("overwrite").insertInto(table)
    count = written.get["rows"]
    if count == 0:
        _empty_partition(spark, table, spec)
    add_partition(spark, table, spec)
    return count
