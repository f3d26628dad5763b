"""Sending records to an external store in bounded batches.

``send_in_batches`` hands records to a sender while they are computed. For stores in
which a repeated batch would show, an outbox comes between: tasks stage their batches as files,
the commit of the job names the files that count, and a ledger remembers each batch that
was delivered, so that a delivery that failed goes on where it stopped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from importlib import import_module

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tabflow.fixed import USER_BATCH_SIZE

#: Name of the column with the number of the batch that a record belongs to.
NUMBER = "batch"


def _function(name: str) -> Callable:
    """The function that ``module:function`` names."""
    module, function = name.split(":")
    return getattr(import_module(module), function)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path on it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


# Sending directly


@dataclass
class Sent(WriterCommitMessage):
    batches: int
    records: int


class RecordBatchWriter(DataSourceArrowWriter):
    """Hands each task's rows to the sender, ``batchSize`` at a time.

    Rows arrive as Arrow batches, which are cut and converted a batch at a time.
    """

    def __init__(self, options: dict[str, str]):
        self.sender = options["sender"]
        self.size = int(options.get("batchsize", USER_BATCH_SIZE))

    def write(self, arrow: Iterator[pa.RecordBatch]) -> Sent:
        send = _function(self.sender)
        batches = records = 0
        for rows in _resized(arrow, self.size):
            send(rows.to_pylist())
            batches, records = batches + 1, records + rows.num_rows
        return Sent(batches, records)


def _resized(arrow: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``size`` rows, the last one of what is left."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in arrow:
        held.append(batch)
        count += batch.num_rows
        while count >= size:
            table = pa.Table.from_batches(held)
            yield table.slice(0, size)
            held, count = table.slice(size).to_batches(), count - size
    if count:
        yield pa.Table.from_batches(held)


class RecordBatches(DataSource):
    """Data source ``record_batches``: option ``sender`` is ``module:function``.

    The function receives a list of dicts and must be idempotent per record,
    since a lost task sends its rows again.
    """

    @classmethod
    def name(cls) -> str:
        return "record_batches"

    def writer(self, schema: StructType, overwrite: bool) -> RecordBatchWriter:
        return RecordBatchWriter(self.options)


def send_in_batches(df: DataFrame, sender: str, size: int = USER_BATCH_SIZE) -> None:
    """Send every record through ``sender`` in batches of at most ``size``."""
    df.sparkSession.dataSource.register(RecordBatches)
    (
        df.write.format("record_batches")
        .options(sender=sender, batchSize=size)
        .mode("append")
        .save()
    )


# The outbox


@dataclass
class Staged(WriterCommitMessage):
    """What one attempt of a task has staged: (file, batch number, records) of each batch."""

    files: list[tuple[str, int, int]]


class OutboxWriter(DataSourceArrowWriter):
    """Stages a file for each batch number; the job's commit makes them count.

    Rows must arrive sorted by their number, and all of one number in one task. Every
    attempt writes files of its own, so what a lost one leaves behind is never named.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, arrow: Iterator[pa.RecordBatch]) -> Staged:
        files, root = file_system(self.folder)
        files.create_dir(f"{root}/batches", recursive=True)
        attempt, made = uuid.uuid4().hex, []
        for number, rows in _by_number(arrow):
            name = f"{number}-{attempt}.parquet"
            pq.write_table(rows.drop_columns([NUMBER]), f"{root}/batches/{name}", filesystem=files)
            made.append((name, number, rows.num_rows))
        return Staged(made)

    def commit(self, messages: list[Staged | None]) -> None:
        """One file names all batches; it appears whole, by a rename, or not at all."""
        made = [one for message in messages if message for one in message.files]
        if len({number for _, number, _ in made}) != len(made):
            raise RuntimeError("rows of one batch number came from several tasks")
        files, root = file_system(self.folder)
        names, numbers, records = zip(*made) if made else ((), (), ())
        table = pa.table(
            {
                "file": pa.array(names, pa.string()),
                "number": pa.array(numbers, pa.int64()),
                "records": pa.array(records, pa.int64()),
            }
        )
        files.create_dir(f"{root}/manifest", recursive=True)
        pq.write_table(table, f"{root}/_manifest", filesystem=files)
        files.move(f"{root}/_manifest", f"{root}/manifest/batches.parquet")

    def abort(self, messages: list[Staged | None]) -> None:
        files, root = file_system(self.folder)
        for name, _, _ in (one for message in messages if message for one in message.files):
            files.delete_file(f"{root}/batches/{name}")


def _by_number(arrow: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Runs of rows with one batch number."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in arrow:
        numbers = batch.column(NUMBER).to_pylist()
        starts = [i for i, n in enumerate(numbers) if i == 0 or n != numbers[i - 1]]
        for low, high in zip(starts, [*starts[1:], len(numbers)]):
            if held and numbers[low] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = numbers[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield last, pa.Table.from_batches(held)


@dataclass
class BatchFile(InputPartition):
    path: str
    number: int


class OutboxReader(DataSourceReader):
    """One task for each batch that the commit names."""

    def __init__(self, folder: str, columns: Sequence[str]):
        self.folder, self.columns = folder, list(columns)

    def partitions(self) -> list[BatchFile]:
        files, root = file_system(self.folder)
        named = pq.read_table(f"{root}/manifest/batches.parquet", filesystem=files).to_pylist()
        return [BatchFile(f"{root}/batches/{r['file']}", r["number"]) for r in named]

    def read(self, partition: BatchFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no batches
            return
        files, _ = file_system(self.folder)
        rows = pq.read_table(partition.path, filesystem=files)
        rows = rows.append_column(NUMBER, pa.array([partition.number] * len(rows), pa.int64()))
        yield from rows.select(self.columns).to_batches()


class Outbox(DataSource):
    """Data source ``outbox``, at ``path``: numbered batches, written once and read back."""

    @classmethod
    def name(cls) -> str:
        return "outbox"

    def writer(self, schema: StructType, overwrite: bool) -> OutboxWriter:
        return OutboxWriter(self.options["path"])

    def reader(self, schema: StructType) -> OutboxReader:
        return OutboxReader(self.options["path"], schema.names)


def is_staged(spark: SparkSession, folder: str) -> bool:
    """Whether an outbox has been committed."""
    files, root = file_system(folder)
    return files.get_file_info(f"{root}/manifest/batches.parquet").type is pafs.FileType.File


def stage_batches(df: DataFrame, folder: str) -> bool:
    """Write numbered records to an outbox; their column ``batch`` is the number.

    An outbox is written once: if the folder has one, it stays as it is, nothing is
    computed and the answer is False. So after a failure the same batches are delivered,
    whatever the input has become since.
    """
    spark = df.sparkSession
    if is_staged(spark, folder):
        return False
    spark.dataSource.register(Outbox)
    numbered = df.repartitionByRange(F.col(NUMBER)).sortWithinPartitions(NUMBER)
    numbered.write.format("outbox").option("path", folder).mode("append").save()
    return True


def read_batches(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The records of an outbox with the numbers of their batches."""
    spark.dataSource.register(Outbox)
    return spark.read.format("outbox").schema(schema).option("path", folder).load()


_LEDGER = "number bigint, records bigint"


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """``number, records`` of the batches of an outbox that were delivered."""
    files, root = file_system(folder)
    files.create_dir(f"{root}/ledger", recursive=True)
    return spark.read.schema(_LEDGER).parquet(f"{folder}/ledger")


def deliver(spark: SparkSession, folder: str, sender: str, target: str, senders: int = 8) -> dict[str, int]:
    """Send the batches of an outbox that are not in its ledger yet, over ``senders`` tasks.

    ``sender`` is a ``module:function`` that gets the target, the number of a batch and its
    records. A batch is entered in the ledger when it has returned. A task that is lost
    between the two sends that one batch again under the same number, by which the
    store must know it; no other batch is sent twice. Returns the batches and records of
    this delivery.
    """
    named = spark.read.schema(f"file string, {_LEDGER}").parquet(f"{folder}/manifest")
    missing = named.join(delivered(spark, folder).select("number"), "number", "left_anti")
    missing = missing.select("file", "number", "records")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = _function(sender)
        files, root = file_system(folder)
        for part in parts:
            for row in part.to_pylist():
                entry = f"{root}/ledger/{row['number']}.parquet"
                done = pa.table({k: pa.array([row[k]], pa.int64()) for k in ("number", "records")})
                # an earlier attempt of this task may have come that far
                if files.get_file_info(entry).type is not pafs.FileType.File:
                    path = f"{root}/batches/{row['file']}"
                    send(target, row["number"], pq.read_table(path, filesystem=files).to_pylist())
                    name = f"{root}/_{row['number']}-{uuid.uuid4().hex}"
                    pq.write_table(done, name, filesystem=files)
                    files.move(name, entry)
                yield from done.to_batches()

    sent = missing.repartition(senders, "number").mapInArrow(run, _LEDGER)
    found = sent.agg(F.count("number"), F.coalesce(F.sum("records"), F.lit(0))).first()
    return {"batches": found[0], "records": found[1]}


def save_as_json(target: str, number: int, records: list[dict]) -> None:
    """A sender into a folder: one file of JSON lines for each batch, which replaces itself."""
    files, root = file_system(target)
    files.create_dir(root, recursive=True)
    name = f"{root}/_{number}-{uuid.uuid4().hex}"
    with files.open_output_stream(name) as out:
        out.write("".join(json.dumps(r) + "\n" for r in records).encode())
    files.move(name, f"{root}/{number}.json")
