"""Jobs over follower pairs and user profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from tabflow.fixed import USER_BATCH_SIZE
from tabflow.operators.clean import edge_list, user_records
from tabflow.operators.numbering import batch_numbers
from tabflow.operators.placement import cluster_rows
from tabflow.scratch import Scratch
from tabflow.sinks.files import to_tsv, write_lines
from tabflow.sinks.graph_store import GraphStore
from tabflow.sinks.record_batches import deliver, is_staged, send_in_batches, stage_batches
from tabflow.sources.lines import lines_of
from tabflow.sources.partitions import PartitionValue


def clean_pairs(
    spark: SparkSession,
    table: str | DataFrame,
    out: str,
    partition_schema: str = "",
    columns: Sequence[str] = (),
    values: Sequence[PartitionValue] = (),
    partitions: int | None = None,
) -> dict[str, int]:
    """Usable pairs clustered by source, as ``src<TAB>dst`` lines; ``out`` must be new.

    Returns the lines read and kept.
    """
    lines = lines_of(spark, table, partition_schema, columns, values)
    counts = Observation()
    pairs = cluster_rows(edge_list(lines, counts), "src", partitions)
    write_lines(to_tsv(pairs), out, replace=False)
    return counts.get


def load_followers(
    spark: SparkSession,
    table: str | DataFrame,
    store: GraphStore,
    partition_schema: str = "",
    columns: Sequence[str] = (),
    values: Sequence[PartitionValue] = (),
) -> dict[str, int]:
    """Create the missing nodes and edges of the chosen follower partitions.

    Returns the lines read and kept, and the nodes and edges created.
    """
    lines = lines_of(spark, table, partition_schema, columns, values)
    counts = Observation()
    created = store.upsert(edge_list(lines, counts))
    return {**counts.get, **created}


def load_users(
    spark: SparkSession,
    table: str | DataFrame,
    sender: str,
    partition_schema: str = "",
    columns: Sequence[str] = (),
    values: Sequence[PartitionValue] = (),
    size: int = USER_BATCH_SIZE,
    outbox: str | None = None,
    target: str = "",
) -> dict[str, int]:
    """Send user records to an external store in batches; see ``send_in_batches``.

    With an ``outbox`` folder, batches are numbered in the order of user ids, staged there
    and delivered to ``target``; see ``deliver`` for the sender. Running the same load
    again stages nothing and sends only batches that were not delivered.

    Returns the lines read and kept, if the input was read; every kept line is a record.
    With an outbox also the batches and records delivered now.
    """
    lines = lines_of(spark, table, partition_schema, columns, values)
    counts = Observation()
    if outbox is None:
        send_in_batches(user_records(lines, counts), sender, size)
        return counts.get
    read: dict[str, int] = {}
    if not is_staged(spark, outbox):
        with Scratch(spark) as scratch:
            users = scratch.staged(user_records(lines, counts), "users")
            read = counts.get
            stage_batches(batch_numbers(users, size, ["userid"], stage=scratch.staged), outbox)
    return {**read, **deliver(spark, outbox, sender, target)}
