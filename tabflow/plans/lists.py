"""Jobs over id lists and plain text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.uniques import explode_unique, word_count
from tabflow.sinks.files import to_tsv, write_lines
from tabflow.sources.lines import lines_of, offset_lines, sequence_file
from tabflow.sources.partitions import PartitionValue


def count_uniques(
    spark: SparkSession,
    table: str | DataFrame,
    out: str,
    partition_schema: str = "",
    columns: Sequence[str] = (),
    values: Sequence[PartitionValue] = (),
) -> dict[str, int]:
    """Distinct list items per id over the chosen partitions, as ``id<TAB>uniq`` lines.

    Returns the lines read and rejected and the ids written.
    """
    lines = lines_of(spark, table, partition_schema, columns, values)
    counts = Observation()
    ids = write_lines(to_tsv(explode_unique(lines, counts)), out)
    return {**counts.get, "ids": ids}


def sequence_to_text(spark: SparkSession, path: str, out: str) -> int:
    """The values of a SequenceFile as text lines."""
    pairs = sequence_file(spark, path, "key string, value string")
    return write_lines(pairs.select("value"), out)


def count_words(spark: SparkSession, path: str, out: str) -> int:
    """Words in the keys of a SequenceFile, as ``word<TAB>n`` lines."""
    pairs = sequence_file(spark, path, "key string, value string")
    return write_lines(to_tsv(word_count(pairs, "key")), out)


def copy_with_offsets(spark: SparkSession, path: str, out: str) -> int:
    """Text lines, each after its byte offset in its file."""
    lines = offset_lines(spark, path)
    return write_lines(
        lines.select(F.concat_ws("\t", F.col("byte_offset").cast("string"), "value")), out
    )
